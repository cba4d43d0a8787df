"""Listing and sale tables derived from the generic test tables.

The test tables have no missing values and no dirty text, so these views put
them in by fixed rules. Each text runs on Spark SQL and on DuckDB; table names
stand in braces.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

SOLD = """
SELECT CAST(l.l_orderkey AS STRING) || '-' || CAST(l.l_linenumber AS STRING) AS ListingKey,
  CASE WHEN l.l_orderkey % 11 = 0 THEN 'Land' ELSE 'Residential' END AS PropertyType,
  CASE WHEN l.l_orderkey % 97 = 0 THEN NULL ELSE p.p_type END AS PropertySubType,
  CASE WHEN l.l_orderkey % 89 = 0 THEN '  ' ELSE '  ' || n.n_name || ' ' END AS City,
  r.r_name AS CountyOrParish,
  CASE WHEN l.l_suppkey % 10 = 0 THEN 'N/A'
       WHEN l.l_suppkey % 3 = 0 THEN CAST(90000 + l.l_suppkey AS STRING) || '.0'
       ELSE CAST(90000 + l.l_suppkey AS STRING) || '-1234' END AS PostalCode,
  CASE WHEN l.l_partkey % 53 = 0 THEN NULL WHEN l.l_partkey % 59 = 0 THEN 0.0
       WHEN l.l_partkey % 83 = 0 THEN l.l_extendedprice * 20
       ELSE l.l_extendedprice * (1 - l.l_discount) END AS ClosePrice,
  CASE WHEN l.l_partkey % 61 = 0 THEN 0.0 WHEN l.l_partkey % 67 = 0 THEN 1.0
       ELSE l.l_extendedprice END AS OriginalListPrice,
  l.l_extendedprice * (1 - l.l_tax) AS ListPrice,
  CASE WHEN l.l_partkey % 71 = 0 THEN -1.0
       WHEN l.l_partkey % 101 = 0 THEN 9000 + l.l_quantity ELSE l.l_quantity * 40 END AS LivingArea,
  CASE WHEN l.l_partkey % 73 = 0 THEN -3
       WHEN l.l_partkey % 79 = 0 THEN 400 + l.l_linenumber
       ELSE l.l_linenumber * l.l_linenumber END AS DaysOnMarket,
  o.o_orderdate AS ListingContractDate,
  CASE WHEN l.l_orderkey % 37 = 0 THEN NULL ELSE o.o_orderdate + INTERVAL 20 DAY END AS PurchaseContractDate,
  l.l_shipdate AS CloseDate
FROM {lineitem} l JOIN {orders} o ON l.l_orderkey = o.o_orderkey
JOIN {supplier} s ON l.l_suppkey = s.s_suppkey JOIN {nation} n ON s.s_nationkey = n.n_nationkey
JOIN {region} r ON n.n_regionkey = r.r_regionkey JOIN {part} p ON l.l_partkey = p.p_partkey
"""

# Sales with segments of many values, rooms, and flags that an earlier step left as text.
RICH = SOLD.replace("  l.l_shipdate AS CloseDate", """  l.l_shipdate AS CloseDate,
  CASE WHEN l.l_orderkey % 83 = 0 THEN NULL ELSE 'area ' || CAST(l.l_partkey AS STRING) END AS MLSAreaMajor,
  'office ' || CAST(l.l_suppkey AS STRING) AS ListOfficeName,
  CASE WHEN l.l_orderkey % 3 = 0 THEN 'one buyer' ELSE 'buyer ' || CAST(o.o_custkey AS STRING) END AS BuyerOfficeName,
  CASE WHEN l.l_partkey % 47 = 0 THEN -1 WHEN l.l_partkey % 43 = 0 THEN NULL ELSE l.l_linenumber END AS BedroomsTotal,
  CASE WHEN l.l_partkey % 41 = 0 THEN -2 ELSE l.l_linenumber END AS BathroomsTotalInteger,
  CASE l.l_partkey % 31 WHEN 0 THEN 'True' WHEN 1 THEN 'no' WHEN 2 THEN '0' ELSE NULL END AS earlier_flag""", 1)

LISTINGS = """
SELECT CAST(o.o_orderkey AS STRING) AS ListingKey,
  CASE WHEN o.o_orderkey % 11 = 0 THEN 'Land' ELSE 'Residential' END AS PropertyType,
  CASE WHEN o.o_orderkey % 43 = 0 THEN NULL ELSE c.c_mktsegment END AS PropertySubType,
  CASE WHEN o.o_orderkey % 89 = 0 THEN '  ' ELSE ' ' || n.n_name || ' ' END AS City,
  r.r_name AS CountyOrParish,
  CASE WHEN o.o_custkey % 10 = 0 THEN 'N/A' ELSE CAST(90000 + o.o_custkey AS STRING) || '.0' END AS PostalCode,
  o.o_totalprice AS ListPrice,
  CASE WHEN o.o_orderkey % 29 = 0 THEN 1.0 ELSE o.o_totalprice * 1.05 END AS OriginalListPrice,
  CASE WHEN o.o_orderkey % 31 = 0 THEN NULL ELSE o.o_orderdate END AS ListingContractDate
FROM {orders} o JOIN {customer} c ON o.o_custkey = c.c_custkey
JOIN {nation} n ON c.c_nationkey = n.n_nationkey JOIN {region} r ON n.n_regionkey = r.r_regionkey
"""

# One observation per week, '.' where it is missing, none in February 1997.
RATES = """
SELECT week AS observation_date,
  CASE WHEN day(week) = 13 THEN '.'
       ELSE CAST(3 + customers % 4 AS STRING) || '.' || CAST(n % 10 AS STRING)
            || CAST(customers % 9 AS STRING) END AS rate_text
FROM (SELECT CAST(date_trunc('week', o_orderdate) AS DATE) AS week,
        CAST(sum(o_custkey) AS BIGINT) AS customers, count(*) AS n
      FROM {orders} GROUP BY 1) weeks
WHERE NOT (year(week) = 1997 AND month(week) = 2)
"""

TWIN = """
SELECT l_orderkey, l_linenumber, l_partkey,
  CASE WHEN l_partkey % 5 = 0 THEN NULL ELSE CAST(l_partkey AS STRING) END AS base_col,
  CASE WHEN l_partkey % 7 = 0 THEN NULL
       WHEN l_partkey % 13 = 0 THEN CAST(l_partkey + 1 AS STRING)
       ELSE CAST(l_partkey AS STRING) || '.0' END AS twin_col
FROM {lineitem}
"""

GEO = """
SELECT c_custkey,
  CASE WHEN c_custkey % 17 = 0 THEN NULL WHEN c_custkey % 19 = 0 THEN CAST(0 AS DOUBLE)
       ELSE 31 + CAST(c_custkey % 121 AS DOUBLE) / 10 END AS Latitude,
  CASE WHEN c_custkey % 23 = 0 THEN NULL WHEN c_custkey % 29 = 0 THEN CAST(118.5 AS DOUBLE)
       ELSE -125 + CAST(c_custkey % 113 AS DOUBLE) / 10 END AS Longitude,
  CASE WHEN c_custkey % 3 = 0 THEN 'True' WHEN c_custkey % 3 = 1 THEN 'no' ELSE NULL END AS latfilled,
  CASE WHEN c_custkey % 4 = 0 THEN '1' ELSE 'False' END AS lonfilled
FROM {customer}
"""

DIRTY = """
SELECT event_id,
  CASE event_id % 8 WHEN 0 THEN CAST(value AS STRING) WHEN 1 THEN ' 12.5 ' WHEN 2 THEN '1,000'
    WHEN 3 THEN 'abc' WHEN 4 THEN NULL WHEN 5 THEN '1d' WHEN 6 THEN 'NaN' ELSE '-3' END AS num_text,
  CASE event_id % 5 WHEN 0 THEN '2024-02-30' WHEN 1 THEN '2024-01' WHEN 2 THEN NULL
    WHEN 3 THEN '01/15/2024' ELSE '2024-01-15' END AS date_text
FROM {events}
"""

# Declared, so that reading a table starts no job to find its schema.
TABLES = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey long, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey long, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey long, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, "
    "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
    "l_shipdate timestamp_ntz",
    "events": "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string",
}
EVENT_START = "1998-01-01"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(TABLES[name]).parquet(f"{sf_dir}/{name}.parquet")


def view(spark: SparkSession, sf_dir: str, text: str) -> DataFrame:
    used = [name for name in TABLES if "{" + name + "}" in text]
    return spark.sql(text, **{name: table(spark, sf_dir, name) for name in used})


def sql_text(text: str) -> str:
    """The view for DuckDB, where tables are known by their plain names."""
    return text.format(**{name: name for name in TABLES}).strip()
