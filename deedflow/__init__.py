"""deedflow: data quality and market metrics for property listing and sale tables.

Every operator takes and returns Spark DataFrames.
"""

__version__ = "0.1.0"
