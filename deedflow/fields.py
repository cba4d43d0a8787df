"""Field lists, rules and output schemas shared by the operators.

Everything here is a default: each operator takes its columns and rules as
arguments.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Names, bounds and tokens that results depend on.
# ---------------------------------------------------------------------------

# Text read as missing.
NA_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a",
    "nan", "null",
)

DATE_FIELDS = (
    "CloseDate", "PurchaseContractDate", "ListingContractDate",
    "ContractStatusChangeDate",
)

NUMERIC_FIELDS = (
    "ClosePrice", "ListPrice", "OriginalListPrice", "LivingArea",
    "DaysOnMarket", "BedroomsTotal", "BathroomsTotalInteger", "Latitude",
    "Longitude", "rate_30yr_fixed",
)

EXPLORED_FIELDS = (
    "ClosePrice", "ListPrice", "OriginalListPrice", "LivingArea",
    "LotSizeAcres", "BedroomsTotal", "BathroomsTotalInteger", "DaysOnMarket",
    "YearBuilt",
)

# Latitude and longitude box, bounds included.
LATITUDE_RANGE = (32.0, 42.1)
LONGITUDE_RANGE = (-124.5, -114.0)

FILLED_INDICATORS = ("latfilled", "lonfilled")

METRICS = (
    "PriceRatio", "CloseToOriginalListRatio", "PricePerSqFt", "DaysOnMarket",
    "Year", "Month", "YrMo", "ListingToContractDays", "ContractToCloseDays",
)

SEGMENTS = (
    "PropertyType", "PropertySubType", "CountyOrParish", "MLSAreaMajor",
    "ListOfficeName", "BuyerOfficeName",
)

SAMPLE_IDENTIFIERS = (
    "ListingKey", "UnparsedAddress", "CountyOrParish", "PropertySubType",
    "CloseDate", "OriginalListPrice", "ClosePrice", "LivingArea",
    "PurchaseContractDate", "ListingContractDate",
)

OUTLIER_FLAGS = {
    "ClosePrice": "close_price_iqr_outlier_flag",
    "LivingArea": "living_area_iqr_outlier_flag",
    "DaysOnMarket": "days_on_market_iqr_outlier_flag",
}
ANY_OUTLIER_FLAG = "any_iqr_outlier_flag"
BUSINESS_RULE_FLAG = "week7_business_rule_invalid_flag"
EXCLUSION_FLAG = "week7_exclusion_flag"
IQR_FACTOR = 1.5

NEW_LISTING = "New Listing"
CLOSED_SALE = "Closed Sale"
EVENT_FLOOR = "2024-01-01"
RATIO_BOUNDS = (0.5, 1.5)
SOLD_MEASURES = (
    "ClosePrice", "DaysOnMarket", "CloseToOriginalListRatio", "PricePerSqFt",
)
EVENT_DIMENSIONS = (
    "ListingKey", "City", "CountyOrParish", "PostalCode", "PropertySubType",
)
EVENT_OPTIONAL = (
    "PropertyType", "MLSAreaMajor", "Latitude", "Longitude", "ListPrice",
    "OriginalListPrice", "rate_30yr_fixed",
)
COVERAGE_FIELDS = (
    "City", "CountyOrParish", "PostalCode", "PropertySubType", "ClosePrice",
    "DaysOnMarket", "CloseToOriginalListRatio",
)
EVENT_SCHEMA = T.StructType([
    T.StructField("EventType", T.StringType()),
    T.StructField("EventDate", T.DateType()),
    T.StructField("EventMonth", T.DateType()),
    T.StructField("Year", T.IntegerType()),
    T.StructField("Month", T.IntegerType()),
    T.StructField("YrMo", T.StringType()),
    T.StructField("EventCount", T.IntegerType()),
    T.StructField("ListingKey", T.StringType()),
    T.StructField("City", T.StringType()),
    T.StructField("CountyOrParish", T.StringType()),
    T.StructField("PostalCode", T.StringType()),
    T.StructField("PropertyType", T.StringType()),
    T.StructField("PropertySubType", T.StringType()),
    T.StructField("MLSAreaMajor", T.StringType()),
    T.StructField("Latitude", T.DoubleType()),
    T.StructField("Longitude", T.DoubleType()),
    T.StructField("ListPrice", T.DoubleType()),
    T.StructField("OriginalListPrice", T.DoubleType()),
    T.StructField("ClosePrice", T.DoubleType()),
    T.StructField("DaysOnMarket", T.DoubleType()),
    T.StructField("CloseToOriginalListRatio", T.DoubleType()),
    T.StructField("PricePerSqFt", T.DoubleType()),
    T.StructField("rate_30yr_fixed", T.DoubleType()),
])


@dataclass(frozen=True)
class Rule:
    """A numeric field and the SQL comparison that makes a value invalid."""

    field: str
    flag: str
    invalid: str


INVALID_RULES = (
    Rule("ClosePrice", "invalid_close_price_flag", "<= 0"),
    Rule("LivingArea", "invalid_living_area_flag", "<= 0"),
    Rule("DaysOnMarket", "invalid_days_on_market_flag", "< 0"),
    Rule("BedroomsTotal", "invalid_bedrooms_flag", "< 0"),
    Rule("BathroomsTotalInteger", "invalid_bathrooms_flag", "< 0"),
)
ANY_INVALID_FLAG = "any_invalid_numeric_flag"
BUSINESS_RULES = INVALID_RULES[:3]

TIMELINE_FLAGS = ("listing_after_close_flag", "purchase_after_close_flag", "negative_timeline_flag")
# Dates in their order, with the flag for the wrong one.
DATE_ORDER = (
    ("ListingContractDate", "CloseDate", "listing_after_close_flag"),
    ("PurchaseContractDate", "CloseDate", "purchase_after_close_flag"),
    ("ListingContractDate", "PurchaseContractDate", ""),
)
GEO_FLAGS = (
    "missing_coordinate_flag", "zero_coordinate_flag", "positive_longitude_flag",
    "outside_california_bounds_flag", "invalid_coordinate_flag",
)
FILLED_FLAG = "coordinate_filled_flag"

# ---------------------------------------------------------------------------
# End of fixed values.
# ---------------------------------------------------------------------------
