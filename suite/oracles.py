"""The same results in SQL for DuckDB, written apart from the operators."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from suite import proxies
from suite.proxies import EVENT_START, sql_text


def rnd(expression: str, digits: int = 4) -> str:
    """Half-even rounding of the scaled double."""
    return f"(round_even(CAST({expression} AS DOUBLE) * 1e{digits}, 0) / 1e{digits})"


def pct(part: str, whole: str) -> str:
    return f"(CASE WHEN {whole} > 0 THEN CAST({part} AS DOUBLE) / {whole} * 100 ELSE 0.0 END)"


def union(parts: Iterable[str]) -> str:
    return "\nUNION ALL\n".join(parts)


CTE: dict[str, tuple[tuple[str, ...], str]] = {
    "sold": ((), sql_text(proxies.SOLD)),
    "rich": ((), sql_text(proxies.RICH)),
    "listings": ((), sql_text(proxies.LISTINGS)),
    "rates_raw": ((), sql_text(proxies.RATES)),
    "twin": ((), sql_text(proxies.TWIN)),
    "geo": ((), sql_text(proxies.GEO)),
    "dirty": ((), sql_text(proxies.DIRTY)),
    "rates": (("rates_raw",), f"""
SELECT strftime(observation_date, '%Y-%m') AS year_month,
  {rnd('avg(try_cast(rate_text AS DOUBLE))')} AS rate_30yr_fixed
FROM rates_raw WHERE try_cast(rate_text AS DOUBLE) IS NOT NULL GROUP BY 1"""),
    "enriched": (("sold", "rates"), """
SELECT s.*, strftime(s.CloseDate, '%Y-%m') AS year_month, r.rate_30yr_fixed
FROM sold s LEFT JOIN rates r ON r.year_month = strftime(s.CloseDate, '%Y-%m')"""),
    "iqr": (("sold",), union(
        f"""SELECT '{name}' AS field, count({name}) AS non_missing_count,
  count(*) - count({name}) AS missing_count, q[1] AS q1, q[2] AS median, q[3] AS q3,
  q[3] - q[1] AS iqr, q[1] - 1.5 * (q[3] - q[1]) AS lower_bound,
  q[3] + 1.5 * (q[3] - q[1]) AS upper_bound, q[4] AS p01, q[5] AS p05, q[6] AS p95, q[7] AS p99
FROM sold, (SELECT quantile_cont(CAST({name} AS DOUBLE), [0.25, 0.5, 0.75, 0.01, 0.05, 0.95, 0.99]) AS q
            FROM sold) quantiles GROUP BY q"""
        for name in ("ClosePrice", "LivingArea", "DaysOnMarket")
    )),
    "flagged": (("sold", "iqr"), """
SELECT s.*,
  coalesce(ClosePrice < c.lower_bound OR ClosePrice > c.upper_bound, false) AS close_price_iqr_outlier_flag,
  coalesce(LivingArea < a.lower_bound OR LivingArea > a.upper_bound, false) AS living_area_iqr_outlier_flag,
  coalesce(DaysOnMarket < d.lower_bound OR DaysOnMarket > d.upper_bound, false) AS days_on_market_iqr_outlier_flag
FROM sold s, (SELECT * FROM iqr WHERE field = 'ClosePrice') c,
  (SELECT * FROM iqr WHERE field = 'LivingArea') a, (SELECT * FROM iqr WHERE field = 'DaysOnMarket') d"""),
    "excluded": (("flagged",), """
SELECT *, any_iqr_outlier_flag OR week7_business_rule_invalid_flag AS week7_exclusion_flag
FROM (SELECT *,
    close_price_iqr_outlier_flag OR living_area_iqr_outlier_flag OR days_on_market_iqr_outlier_flag
      AS any_iqr_outlier_flag,
    coalesce(ClosePrice <= 0, false) OR coalesce(LivingArea <= 0, false)
      OR coalesce(DaysOnMarket < 0, false) AS week7_business_rule_invalid_flag
  FROM flagged) t"""),
    "features": (("sold",), """
SELECT * REPLACE (CAST(DaysOnMarket AS DOUBLE) AS DaysOnMarket,
    CAST(CloseDate AS DATE) AS CloseDate, CAST(ListingContractDate AS DATE) AS ListingContractDate,
    CAST(PurchaseContractDate AS DATE) AS PurchaseContractDate),
  CASE WHEN OriginalListPrice > 0 THEN ClosePrice / OriginalListPrice END AS PriceRatio,
  CASE WHEN OriginalListPrice > 0 THEN ClosePrice / OriginalListPrice END AS CloseToOriginalListRatio,
  CASE WHEN LivingArea > 0 THEN ClosePrice / LivingArea END AS PricePerSqFt,
  CAST(year(CloseDate) AS INTEGER) AS Year, CAST(month(CloseDate) AS INTEGER) AS Month,
  strftime(CloseDate, '%Y-%m') AS YrMo,
  CASE WHEN to_contract >= 0 THEN to_contract END AS ListingToContractDays,
  CASE WHEN to_close >= 0 THEN to_close END AS ContractToCloseDays,
  coalesce(to_contract < 0, false) AS invalid_listing_to_contract_days_flag,
  coalesce(to_close < 0, false) AS invalid_contract_to_close_days_flag
FROM (SELECT *,
    CAST(date_diff('day', ListingContractDate, PurchaseContractDate) AS INTEGER) AS to_contract,
    CAST(date_diff('day', PurchaseContractDate, CloseDate) AS INTEGER) AS to_close
  FROM sold) t"""),
    "rich_features": (("rich",), """
SELECT * REPLACE (CAST(DaysOnMarket AS DOUBLE) AS DaysOnMarket,
    CAST(CloseDate AS DATE) AS CloseDate, CAST(ListingContractDate AS DATE) AS ListingContractDate,
    CAST(PurchaseContractDate AS DATE) AS PurchaseContractDate),
  CASE WHEN OriginalListPrice > 0 THEN ClosePrice / OriginalListPrice END AS PriceRatio,
  CASE WHEN OriginalListPrice > 0 THEN ClosePrice / OriginalListPrice END AS CloseToOriginalListRatio,
  CASE WHEN LivingArea > 0 THEN ClosePrice / LivingArea END AS PricePerSqFt,
  CAST(year(CloseDate) AS INTEGER) AS Year, CAST(month(CloseDate) AS INTEGER) AS Month,
  strftime(CloseDate, '%Y-%m') AS YrMo,
  CASE WHEN to_contract >= 0 THEN to_contract END AS ListingToContractDays,
  CASE WHEN to_close >= 0 THEN to_close END AS ContractToCloseDays,
  coalesce(to_contract < 0, false) AS invalid_listing_to_contract_days_flag,
  coalesce(to_close < 0, false) AS invalid_contract_to_close_days_flag
FROM (SELECT *,
    CAST(date_diff('day', ListingContractDate, PurchaseContractDate) AS INTEGER) AS to_contract,
    CAST(date_diff('day', PurchaseContractDate, CloseDate) AS INTEGER) AS to_close
  FROM rich) t"""),
}

_STRIPPED = r"nullif(regexp_replace({0}, '^\s+|\s+$', '', 'g'), '')"
_ZIP = r"regexp_replace(" + _STRIPPED.format("PostalCode") + r", '\.0$', '')"
POSTAL = rf"coalesce(nullif(regexp_extract({_ZIP}, '\d{{5}}'), ''), {_ZIP})"


def _event_side(kind: str, date: str, source: str, sold: bool) -> str:
    measures = (
        """ClosePrice, DaysOnMarket,
  CASE WHEN CloseToOriginalListRatio BETWEEN 0.5 AND 1.5 THEN CloseToOriginalListRatio END
    AS CloseToOriginalListRatio,
  CloseToOriginalListRatio AS raw_ratio, PricePerSqFt"""
        if sold
        else """NULL::DOUBLE AS ClosePrice, NULL::DOUBLE AS DaysOnMarket,
  NULL::DOUBLE AS CloseToOriginalListRatio, NULL::DOUBLE AS raw_ratio, NULL::DOUBLE AS PricePerSqFt"""
    )
    texts = ", ".join(
        f"{_STRIPPED.format(name)} AS {name}"
        for name in ("ListingKey", "City", "CountyOrParish", "PropertyType", "PropertySubType")
    )
    return rf"""SELECT '{kind}' AS EventType, CAST({date} AS DATE) AS EventDate,
  CAST(date_trunc('month', {date}) AS DATE) AS EventMonth, CAST(year({date}) AS INTEGER) AS Year,
  CAST(month({date}) AS INTEGER) AS Month, strftime({date}, '%Y-%m') AS YrMo, 1 AS EventCount,
  {texts}, {POSTAL} AS PostalCode, NULL::VARCHAR AS MLSAreaMajor, NULL::DOUBLE AS Latitude,
  NULL::DOUBLE AS Longitude, ListPrice, OriginalListPrice, {measures},
  NULL::DOUBLE AS rate_30yr_fixed
FROM {source} WHERE {date} >= DATE '{EVENT_START}'"""


CTE["market"] = (("listings", "features"), union([
    _event_side("New Listing", "ListingContractDate", "listings", False),
    _event_side("Closed Sale", "CloseDate", "features", True),
]))


def with_cte(names: Sequence[str], body: str) -> str:
    """The query with the named views and those they need in front."""
    ordered: list[str] = []

    def add(name: str) -> None:
        for needed in CTE[name][0]:
            add(needed)
        if name not in ordered:
            ordered.append(name)

    for name in names:
        add(name)
    views = ",\n".join(f"{name} AS ({CTE[name][1]})" for name in ordered)
    return (f"WITH {views}\n" if views else "") + body.strip()


SOLD_COLUMNS = (
    "ListingKey", "PropertyType", "PropertySubType", "City", "CountyOrParish", "PostalCode",
    "ClosePrice", "OriginalListPrice", "ListPrice", "LivingArea", "DaysOnMarket",
    "ListingContractDate", "PurchaseContractDate", "CloseDate",
)
OUTLIER_FIELDS = ("ClosePrice", "LivingArea", "DaysOnMarket")
ORDER_TYPES = (
    ("o_orderkey", "bigint"), ("o_custkey", "bigint"), ("o_orderstatus", "string"),
    ("o_totalprice", "double"), ("o_orderdate", "timestamp_ntz"), ("o_orderpriority", "string"),
)
ORACLES: dict[str, str] = {}

ORACLES["profile"] = union(
    f"SELECT {i} AS ordinal, '{name}' AS \"column\", '{kind}' AS type, count(*) AS row_count FROM orders"
    for i, (name, kind) in enumerate(ORDER_TYPES, start=1)
)
ORACLES["prefer_versions"] = """
SELECT o_custkey, month, o_orderstatus, o_orderkey FROM (
  SELECT *, row_number() OVER (PARTITION BY o_custkey, month
      ORDER BY (o_orderstatus = 'F') DESC, o_orderkey DESC) AS rn
  FROM (SELECT *, strftime(o_orderdate, '%Y-%m') AS month FROM orders) o) ranked
WHERE rn = 1"""
_EVOLVING = """
SELECT o_orderkey, o_orderdate, o_totalprice, 'early' AS source_file FROM orders
WHERE o_orderdate < TIMESTAMP '1998-01-01'
UNION ALL BY NAME
SELECT o_orderkey, o_orderdate, o_totalprice, o_orderpriority, 'late' AS source_file FROM orders
WHERE o_orderdate >= TIMESTAMP '1998-01-01'"""
ORACLES["union_evolving"] = _EVOLVING
ORACLES["union_report"] = f"""
SELECT source_file, count(*) AS row_count, false AS is_total FROM ({_EVOLVING}) u GROUP BY 1
UNION ALL SELECT NULL, count(*), true FROM ({_EVOLVING}) u"""
ORACLES["filter_counts"] = with_cte(["sold"], """
SELECT 'sold' AS dataset, count(*) AS rows_before,
  count_if(PropertyType = 'Residential')::BIGINT AS rows_after,
  (count(*) - count_if(PropertyType = 'Residential'))::BIGINT AS rows_removed FROM sold""")
ORACLES["filter_equal"] = with_cte(
    ["listings"], "SELECT * FROM listings WHERE PropertyType = 'Residential'"
)

_MISSING = union(
    f"""SELECT '{name}' AS "column", {i} AS ordinal, count(*) - count({name}) AS missing_count,
  {rnd(pct(f'(count(*) - count({name}))', 'count(*)'), 2)} AS missing_percent,
  count({name}) AS non_missing_count FROM sold"""
    for i, name in enumerate(SOLD_COLUMNS)
)
ORACLES["missingness"] = with_cte(["sold"], f"""
SELECT "column", missing_count, missing_percent, non_missing_count,
  missing_percent > 90 AS above_90_percent_missing FROM ({_MISSING}) m
ORDER BY missing_percent DESC, missing_count DESC, ordinal""")
ORACLES["most_missing"] = with_cte(["sold"], f"""
SELECT "column", missing_count, missing_percent, non_missing_count,
  missing_percent > 90 AS above_90_percent_missing FROM ({_MISSING}) m
ORDER BY missing_percent DESC, missing_count DESC, "column" LIMIT 3""")
ORACLES["prune_sparse"] = with_cte(["sold"], "SELECT * FROM sold")
ORACLES["category_counts"] = with_cte(["sold"], """
SELECT PropertySubType AS value, count(*) AS count,
  CAST(count(*) AS DOUBLE) / (SELECT count(*) FROM sold) * 100 AS percent FROM sold GROUP BY 1""")

_SUMMARY_QUANTILES = (
    ("p01", 0.01), ("p05", 0.05), ("p25", 0.25), ("median_p50", 0.5), ("p75", 0.75), ("p95", 0.95),
    ("p99", 0.99),
)
ORACLES["numeric_summary"] = with_cte(["sold"], union(
    f"""SELECT '{name}' AS field, count({name}) AS non_missing_count,
  count(*) - count({name}) AS missing_count, {rnd(f'min({name})', 2)} AS min,
  {', '.join(rnd(f'quantile_cont(CAST({name} AS DOUBLE), {p})', 2) + f' AS {q}' for q, p in _SUMMARY_QUANTILES)},
  {rnd(f'avg({name})', 2)} AS mean, {rnd(f'max({name})', 2)} AS max,
  {rnd(f'stddev_samp({name})', 2)} AS standard_deviation FROM sold"""
    for name in ("ClosePrice", "OriginalListPrice", "LivingArea", "DaysOnMarket")
))


def _counts(name: str) -> str:
    return f"""SELECT i.*, (SELECT count(*) FROM sold WHERE {name} < i.lower_bound) AS below_lower_bound,
  (SELECT count(*) FROM sold WHERE {name} > i.upper_bound) AS above_upper_bound
FROM iqr i WHERE field = '{name}'"""


_COUNTED = union(_counts(name) for name in OUTLIER_FIELDS)
_SHARE = pct("(below_lower_bound + above_upper_bound)", "non_missing_count")
ORACLES["iqr_summary"] = with_cte(["iqr"], f"""
SELECT field, {rnd('lower_bound', 2)} AS iqr_lower_bound, {rnd('upper_bound', 2)} AS iqr_upper_bound,
  below_lower_bound, above_upper_bound,
  below_lower_bound + above_upper_bound AS total_potential_outliers,
  {rnd(_SHARE, 2)} AS potential_outlier_percent FROM ({_COUNTED}) c""")
ORACLES["iqr_thresholds"] = with_cte(["iqr"], f"""
SELECT field, non_missing_count, missing_count,
  {', '.join(f'{rnd(q)} AS {q}' for q in ('q1', 'median', 'q3', 'iqr', 'lower_bound', 'upper_bound', 'p01', 'p05', 'p95', 'p99'))},
  below_lower_bound, above_upper_bound, below_lower_bound + above_upper_bound AS total_iqr_outliers,
  {rnd(_SHARE)} AS iqr_outlier_percent_of_non_missing FROM ({_COUNTED}) c""")
ORACLES["iqr_flags"] = with_cte(["excluded"], """
SELECT ListingKey, PostalCode, CloseDate, close_price_iqr_outlier_flag, living_area_iqr_outlier_flag,
  days_on_market_iqr_outlier_flag, any_iqr_outlier_flag FROM excluded""")
ORACLES["exclusion_filter"] = with_cte(["excluded"], """
SELECT ListingKey, ClosePrice, LivingArea, CAST(DaysOnMarket AS DOUBLE) AS DaysOnMarket,
  any_iqr_outlier_flag, week7_business_rule_invalid_flag, week7_exclusion_flag
FROM excluded WHERE NOT week7_exclusion_flag""")
_MEDIANS = ", ".join(
    f"{rnd(f'median(CAST({name} AS DOUBLE))', 2)} AS {alias}"
    for name, alias in (
        ("ClosePrice", "median_close_price"), ("LivingArea", "median_living_area"),
        ("DaysOnMarket", "median_days_on_market"),
    )
)
ORACLES["before_after"] = with_cte(["excluded"], f"""
SELECT 'full_flagged' AS dataset, count(*) AS row_count, CAST(0 AS BIGINT) AS rows_removed_from_full,
  CAST(0 AS DOUBLE) AS percent_removed_from_full, {_MEDIANS} FROM excluded
UNION ALL
SELECT 'filtered_analysis', count(*), (SELECT count(*) FROM excluded) - count(*),
  {rnd('((SELECT count(*) FROM excluded) - count(*)) / CAST((SELECT count(*) FROM excluded) AS DOUBLE) * 100', 2)},
  {_MEDIANS} FROM excluded WHERE NOT week7_exclusion_flag""")
ORACLES["price_vs_list"] = with_cte(["sold"], f"""
SELECT count(*) AS compared_rows,
  {rnd('avg(CASE WHEN ClosePrice > ListPrice THEN 1.0 ELSE 0.0 END) * 100')} AS above_percent,
  {rnd('avg(CASE WHEN ClosePrice = ListPrice THEN 1.0 ELSE 0.0 END) * 100')} AS at_percent,
  {rnd('avg(CASE WHEN ClosePrice < ListPrice THEN 1.0 ELSE 0.0 END) * 100')} AS below_percent
FROM sold WHERE ClosePrice IS NOT NULL AND ListPrice > 0""")
ORACLES["field_center"] = with_cte(["sold"], f"""
SELECT 'DaysOnMarket' AS field, {rnd('avg(DaysOnMarket)')} AS mean,
  {rnd('median(CAST(DaysOnMarket AS DOUBLE))')} AS median,
  {rnd('quantile_cont(CAST(DaysOnMarket AS DOUBLE), 0.95)')} AS p95 FROM sold""")
ORACLES["close_before_listing"] = with_cte(["sold"], """
SELECT count(*) AS rows FROM sold WHERE CloseDate < ListingContractDate""")
ORACLES["top_groups"] = with_cte(["sold"], f"""
SELECT City, transaction_count, {rnd('m')} AS median FROM (
  SELECT City, count(ClosePrice) AS transaction_count, median(ClosePrice) AS m FROM sold
  GROUP BY City HAVING count(ClosePrice) >= 10 ORDER BY m DESC, City LIMIT 10) t""")
ORACLES["histogram"] = with_cte(["sold"], f"""
, ext AS (SELECT min(ClosePrice) AS a, max(ClosePrice) AS b FROM sold),
edges AS (SELECT i, a + (i - 1) * ((b - a) / 50) AS lo,
    CASE WHEN i = 50 THEN b ELSE a + i * ((b - a) / 50) END AS hi FROM ext, range(1, 51) r(i))
SELECT CAST(i AS INTEGER) AS bin, {rnd('lo')} AS lower, {rnd('hi')} AS upper,
  (SELECT count(*) FROM sold WHERE ClosePrice >= lo AND (ClosePrice < hi OR (i = 50 AND ClosePrice = hi)))
    AS count FROM edges""").replace("\n, ext AS", ", ext AS")
ORACLES["boxplot"] = with_cte(["iqr"], union(
    f"""SELECT field, {rnd('q1')} AS q1, {rnd('median')} AS median, {rnd('q3')} AS q3,
  {rnd(f'least(q1, (SELECT min({name}) FROM sold WHERE {name} >= i.lower_bound))')} AS whisker_low,
  {rnd(f'greatest(q3, (SELECT max({name}) FROM sold WHERE {name} <= i.upper_bound))')} AS whisker_high,
  (SELECT count(*) FROM sold WHERE {name} < i.lower_bound) AS outliers_below,
  (SELECT count(*) FROM sold WHERE {name} > i.upper_bound) AS outliers_above
FROM iqr i WHERE field = '{name}'"""
    for name in OUTLIER_FIELDS
))

ORACLES["monthly_average"] = with_cte(["rates"], "SELECT * FROM rates ORDER BY year_month")
ORACLES["enrich_monthly"] = with_cte(
    ["enriched"], "SELECT ListingKey, CloseDate, year_month, rate_30yr_fixed FROM enriched"
)
ORACLES["join_quality"] = with_cte(["enriched"], """
SELECT 'sold' AS dataset, 'CloseDate' AS date_column, (SELECT count(*) FROM sold) AS row_count_before,
  count(*) AS row_count_after, count(*) - count(CloseDate) AS invalid_or_missing_date_rows,
  count(*) - count(rate_30yr_fixed) AS unmatched_rate_rows,
  count(*) = count(rate_30yr_fixed) AS all_rows_matched,
  min(year_month) AS earliest_year_month, max(year_month) AS latest_year_month FROM enriched""")
ORACLES["unmatched_months"] = with_cte(["enriched"], """
SELECT DISTINCT 'sold' AS dataset, year_month FROM enriched
WHERE rate_30yr_fixed IS NULL AND year_month IS NOT NULL""")

ORACLES["coalesce_columns"] = with_cte(["twin"], """
SELECT l_orderkey, l_linenumber, l_partkey, coalesce(base_col, twin_col) AS X FROM twin""")
ORACLES["redundant_report"] = with_cte(["twin"], """
SELECT 'twin' AS dataset, 'X' AS base_column, 'X.1' AS removed_duplicate_column,
  count_if(base_col IS NULL AND twin_col IS NOT NULL)::BIGINT AS values_filled_from_duplicate,
  count_if(base_col <> twin_col AND abs(try_cast(base_col AS DOUBLE) - try_cast(twin_col AS DOUBLE))
    > 1e-8 + 1e-5 * abs(try_cast(twin_col AS DOUBLE)))::BIGINT AS conflicting_non_missing_values,
  'retained base-column value' AS conflict_action FROM twin""")
_NUMBER = r"""CASE WHEN regexp_matches(num_text, '^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$')
  THEN try_cast(trim(num_text) AS DOUBLE) END"""
_TIME = r"CASE WHEN regexp_matches(date_text, '^\d{4}-\d{2}-\d{2}') THEN try_cast(date_text AS TIMESTAMP) END"
ORACLES["coerce_types"] = with_cte(
    ["dirty"], f"SELECT event_id, {_NUMBER} AS num_text, {_TIME} AS date_text FROM dirty"
)
ORACLES["coercion_report"] = with_cte(["dirty"], f"""
SELECT 'dirty' AS dataset, 'date_text' AS "column", 'timestamp' AS target_type, 'timestamp' AS result_type,
  count(date_text) AS non_missing_before, count(date_text) - count({_TIME}) AS values_coerced_to_missing
FROM dirty
UNION ALL SELECT 'dirty', 'absent_date', 'timestamp', 'COLUMN NOT AVAILABLE', 0, 0
UNION ALL SELECT 'dirty', 'num_text', 'numeric', 'double', count(num_text),
  count(num_text) - count({_NUMBER}) FROM dirty""")
ORACLES["invalid_rules"] = with_cte(["sold"], """
SELECT ListingKey, CASE WHEN ClosePrice > 0 THEN ClosePrice END AS ClosePrice,
  CASE WHEN LivingArea > 0 THEN LivingArea END AS LivingArea,
  CASE WHEN DaysOnMarket >= 0 THEN DaysOnMarket END AS DaysOnMarket,
  coalesce(ClosePrice <= 0, false) AS invalid_close_price_flag,
  coalesce(LivingArea <= 0, false) AS invalid_living_area_flag,
  coalesce(DaysOnMarket < 0, false) AS invalid_days_on_market_flag,
  coalesce(ClosePrice <= 0, false) OR coalesce(LivingArea <= 0, false)
    OR coalesce(DaysOnMarket < 0, false) AS any_invalid_numeric_flag FROM sold""")
ORACLES["invalid_counts"] = with_cte(["sold"], union(
    f"""SELECT 'sold' AS dataset, '{name}' AS field, '{flag}' AS flag_column,
  count_if({name} {invalid})::BIGINT AS invalid_values_found,
  'replaced invalid value with missing; retained row' AS action FROM sold"""
    for name, flag, invalid in (
        ("ClosePrice", "invalid_close_price_flag", "<= 0"),
        ("LivingArea", "invalid_living_area_flag", "<= 0"),
        ("DaysOnMarket", "invalid_days_on_market_flag", "< 0"),
    )
))
_TIMELINE = {
    "listing_after_close_flag": "ListingContractDate > CloseDate",
    "purchase_after_close_flag": "PurchaseContractDate > CloseDate",
    "negative_timeline_flag": "(ListingContractDate > CloseDate OR PurchaseContractDate > CloseDate"
    " OR ListingContractDate > PurchaseContractDate)",
}
ORACLES["timeline_flags"] = with_cte(["sold"], "SELECT ListingKey, " + ", ".join(
    f"coalesce({condition}, false) AS {flag}" for flag, condition in _TIMELINE.items()
) + " FROM sold")
ORACLES["flag_summary"] = with_cte(["sold"], union(
    f"""SELECT 'sold' AS dataset, '{flag}' AS flag, count_if({condition})::BIGINT AS flagged_rows,
  {rnd(pct(f'count_if({condition})', 'count(*)'))} AS flagged_percent FROM sold"""
    for flag, condition in _TIMELINE.items()
))
_OUTSIDE = "NOT (Latitude BETWEEN 32.0 AND 42.1 AND Longitude BETWEEN -124.5 AND -114.0)"
ORACLES["geo_flags"] = with_cte(["geo"], f"""
SELECT *, missing_coordinate_flag OR zero_coordinate_flag OR positive_longitude_flag
  OR outside_california_bounds_flag AS invalid_coordinate_flag
FROM (SELECT c_custkey, Latitude IS NULL OR Longitude IS NULL AS missing_coordinate_flag,
    Latitude IS NOT NULL AND Longitude IS NOT NULL AND (Latitude = 0 OR Longitude = 0)
      AS zero_coordinate_flag,
    coalesce(Longitude > 0, false) AS positive_longitude_flag,
    Latitude IS NOT NULL AND Longitude IS NOT NULL AND {_OUTSIDE} AS outside_california_bounds_flag,
    coalesce(latfilled = 'True', false) OR lonfilled = '1' AS coordinate_filled_flag
  FROM geo) g""")
ORACLES["dataset_summary"] = """
SELECT 'twin' AS dataset, count(*) AS rows_before, count(*) AS rows_after, CAST(0 AS BIGINT) AS rows_removed,
  5 AS columns_before, 4 AS columns_after, 1 AS redundant_columns_removed FROM lineitem"""
ORACLES["parse_flags"] = with_cte(["geo"], """
SELECT c_custkey, coalesce(latfilled = 'True', false) AS latfilled, lonfilled = '1' AS lonfilled FROM geo""")
ORACLES["clean_text"] = with_cte(["sold"], f"SELECT ListingKey, {_STRIPPED.format('City')} AS City FROM sold")
ORACLES["clean_postal"] = with_cte(["sold"], f"SELECT ListingKey, {POSTAL} AS PostalCode FROM sold")

_ROUNDED_RATIOS = ", ".join(
    f"{rnd(name)} AS {name}" for name in ("PriceRatio", "CloseToOriginalListRatio", "PricePerSqFt")
)
ORACLES["engineer_features"] = with_cte(["features"], f"""
SELECT ListingKey, {_ROUNDED_RATIOS}, DaysOnMarket, Year, Month, YrMo, ListingToContractDays,
  ContractToCloseDays, invalid_listing_to_contract_days_flag, invalid_contract_to_close_days_flag
FROM features""")
ORACLES["feature_summary"] = with_cte(["features"], union(
    f"""SELECT '{name}' AS metric, count({name}) AS populated_rows,
  count(*) - count({name}) AS missing_rows,
  {rnd(pct(f'count({name})', 'count(*)'), 2)} AS populated_percent,
  """ + (
        "NULL::DOUBLE AS minimum, NULL::DOUBLE AS median, NULL::DOUBLE AS mean, NULL::DOUBLE AS maximum"
        if name == "YrMo"
        else f"""{rnd(f'min({name})', 2)} AS minimum,
  {rnd(f'median(CAST({name} AS DOUBLE))', 2)} AS median, {rnd(f'avg({name})', 2)} AS mean,
  {rnd(f'max({name})', 2)} AS maximum"""
    ) + " FROM features"
    for name in (
        "PriceRatio", "CloseToOriginalListRatio", "PricePerSqFt", "DaysOnMarket", "Year", "Month", "YrMo",
        "ListingToContractDays", "ContractToCloseDays",
    )
))


def _segment(prefix: str, segment: str, source: str = "features") -> str:
    def centre(name: str, label: str) -> str:
        return (f"{rnd(f'avg({name})', 2)} AS average_{label}, "
                f"{rnd(f'median(CAST({name} AS DOUBLE))', 2)} AS median_{label}")

    return f"""SELECT {prefix}, count(*) AS record_count, count(ClosePrice) AS closed_sales_count,
  {rnd('coalesce(sum(ClosePrice), 0)', 2)} AS total_sales_volume, {centre('ClosePrice', 'close_price')},
  {centre('PricePerSqFt', 'price_per_sq_ft')}, {centre('DaysOnMarket', 'days_on_market')},
  {centre('CloseToOriginalListRatio', 'close_to_original_list_ratio')},
  {rnd('median(CAST(ListingToContractDays AS DOUBLE))', 2)} AS median_listing_to_contract_days,
  {rnd('median(CAST(ContractToCloseDays AS DOUBLE))', 2)} AS median_contract_to_close_days
FROM {source} WHERE {segment} IS NOT NULL GROUP BY {segment}"""


ORACLES["segment_summary"] = with_cte(["features"], _segment("CountyOrParish", "CountyOrParish"))
ORACLES["segments_all"] = with_cte(["features"], union(
    _segment(f"'{name}' AS segment_field, {name} AS segment_value", name)
    for name in ("PropertyType", "PropertySubType", "CountyOrParish")
))
_SAMPLE = (
    "CloseDate", "ListingKey", "CountyOrParish", "PropertySubType", "OriginalListPrice", "ClosePrice",
    "LivingArea", "PurchaseContractDate", "ListingContractDate", "PriceRatio",
    "CloseToOriginalListRatio", "PricePerSqFt", "DaysOnMarket", "Year", "Month", "YrMo",
    "ListingToContractDays", "ContractToCloseDays",
)
ORACLES["sample_rows"] = with_cte(["features"], f"""
SELECT * REPLACE ({_ROUNDED_RATIOS}) FROM (
  SELECT {', '.join(_SAMPLE)} FROM features
  WHERE PriceRatio IS NOT NULL AND PricePerSqFt IS NOT NULL AND DaysOnMarket IS NOT NULL
    AND CloseDate IS NOT NULL AND ListingToContractDays IS NOT NULL AND ContractToCloseDays IS NOT NULL
  ORDER BY {', '.join(f'{name} NULLS FIRST' for name in _SAMPLE)} LIMIT 10) t""")

ORACLES["market_events"] = with_cte(["market"], f"""
SELECT * EXCLUDE (raw_ratio) REPLACE ({rnd('CloseToOriginalListRatio')} AS CloseToOriginalListRatio,
  {rnd('PricePerSqFt')} AS PricePerSqFt) FROM market""")
ORACLES["sorted_events"] = with_cte(["market"], """
SELECT EventDate, EventType, ListingKey, ListPrice FROM market ORDER BY ALL NULLS LAST""")
ORACLES["ratio_cleaning"] = with_cte(["market"], f"""
SELECT 'CloseToOriginalListRatio' AS field, CAST(0.5 AS DOUBLE) AS lower_bound_inclusive,
  CAST(1.5 AS DOUBLE) AS upper_bound_inclusive, count(*) AS sold_event_rows,
  count(raw_ratio) AS non_missing_before_cleaning,
  count(*) - count(raw_ratio) AS missing_before_cleaning,
  count_if(raw_ratio < 0.5)::BIGINT AS excluded_below_lower_bound,
  count_if(raw_ratio > 1.5)::BIGINT AS excluded_above_upper_bound,
  count_if(raw_ratio < 0.5 OR raw_ratio > 1.5)::BIGINT AS total_excluded_as_implausible,
  count(CloseToOriginalListRatio) AS valid_rows_after_cleaning,
  count(*) - count(CloseToOriginalListRatio) AS missing_after_cleaning,
  {rnd(pct('count(CloseToOriginalListRatio)', 'count(*)'), 2)} AS valid_percent_after_cleaning
FROM market WHERE EventType = 'Closed Sale'""")


def _prepared(dataset: str, source: str, condition: str) -> str:
    return f"""SELECT '{dataset}' AS dataset, CAST({source} AS BIGINT) AS source_rows,
  count(*) AS output_rows,
  CAST({source} - count(*) AS BIGINT) AS rows_excluded_before_start_or_missing_date,
  min(EventDate) AS earliest_event_date, max(EventDate) AS latest_event_date,
  count(DISTINCT ListingKey) AS distinct_listing_keys,
  count(*) - count(ListingKey) AS missing_listing_keys,
  (SELECT CAST(coalesce(sum(n), 0) AS BIGINT) FROM (SELECT count(*) AS n FROM market
    WHERE {condition} AND ListingKey IS NOT NULL GROUP BY EventType, ListingKey HAVING count(*) > 1) d)
    AS duplicate_event_identity_rows
FROM market WHERE {condition}"""


_NEW, _CLOSED = "(SELECT count(*) FROM listings)", "(SELECT count(*) FROM sold)"
ORACLES["preparation_summary"] = with_cte(["market"], union([
    _prepared("new_listing_events", _NEW, "EventType = 'New Listing'"),
    _prepared("closed_sale_events", _CLOSED, "EventType = 'Closed Sale'"),
    _prepared("combined_events", f"({_NEW} + {_CLOSED})", "true"),
]))
ORACLES["duplicate_identity"] = with_cte(["market"], """
SELECT EventType, ListingKey, EventDate, copies FROM (
  SELECT *, count(*) OVER (PARTITION BY EventType, ListingKey) AS copies FROM market
  WHERE ListingKey IS NOT NULL) m WHERE copies > 1""")
ORACLES["field_coverage"] = with_cte(["market"], union(
    f"""SELECT EventType AS event_type, '{name}' AS field, count(*) AS row_count,
  count({name}) AS populated_rows, count(*) - count({name}) AS missing_rows,
  {rnd(pct(f'count({name})', 'count(*)'), 2)} AS populated_percent FROM market GROUP BY EventType"""
    for name in (
        "City", "CountyOrParish", "PostalCode", "PropertySubType", "ClosePrice", "DaysOnMarket",
        "CloseToOriginalListRatio",
    )
))


def _monthly(condition: str) -> str:
    return with_cte(["market"], f"""
SELECT EventMonth, count_if(EventType = 'New Listing')::BIGINT AS new_listings,
  count_if(EventType = 'Closed Sale')::BIGINT AS closed_sales,
  {rnd('median(ClosePrice)', 10)} AS median_close_price,
  {rnd('avg(DaysOnMarket)', 10)} AS average_days_on_market,
  {rnd('avg(CloseToOriginalListRatio)', 10)} AS average_close_to_original_list_ratio
FROM market WHERE {condition} GROUP BY EventMonth""")


ORACLES["monthly_market"] = _monthly("true")
ORACLES["monthly_market_filtered"] = _monthly("CountyOrParish IN ('ASIA', 'EUROPE')")


def _checks(names: Sequence[str], source: str, counts: dict[str, str]) -> str:
    return with_cte(names, union(
        f"""SELECT '{name}' AS "check", CAST(n AS BIGINT) AS violations, n = 0 AS passed
FROM (SELECT {count} AS n FROM {source}) c"""
        for name, count in counts.items()
    ))


ORACLES["event_contracts"] = _checks(["market"], "market", {
    "new_listings_not_empty": "CASE WHEN count_if(EventType = 'New Listing') > 0 THEN 0 ELSE 1 END",
    "closed_sales_not_empty": "CASE WHEN count_if(EventType = 'Closed Sale') > 0 THEN 0 ELSE 1 END",
    "row_count_reconciles": f"""abs(count(*)
      - (SELECT count(*) FROM listings WHERE ListingContractDate >= DATE '{EVENT_START}')
      - (SELECT count(*) FROM sold WHERE CloseDate >= DATE '{EVENT_START}'))""",
    "event_date_present": "count(*) - count(EventDate)",
    "event_date_from_start": f"count_if(EventDate < DATE '{EVENT_START}')",
    "event_types_expected": "count_if(NOT coalesce(EventType IN ('New Listing', 'Closed Sale'), false))",
    "no_sold_measures_on_listings": """count_if(EventType = 'New Listing' AND (ClosePrice IS NOT NULL
      OR DaysOnMarket IS NOT NULL OR CloseToOriginalListRatio IS NOT NULL OR PricePerSqFt IS NOT NULL))""",
    "event_count_is_one": "count_if(EventCount IS DISTINCT FROM 1)",
})
ORACLES["feature_contracts"] = _checks(["features"], "features", {
    "row_count_unchanged": "abs(count(*) - (SELECT count(*) FROM lineitem))",
    "ratios_identical": "count_if(PriceRatio IS DISTINCT FROM CloseToOriginalListRatio)",
    "listing_to_contract_not_negative": "count_if(ListingToContractDays < 0)",
    "contract_to_close_not_negative": "count_if(ContractToCloseDays < 0)",
    "price_ratio_finite": "count_if(NOT isfinite(PriceRatio))",
    "price_per_sq_ft_finite": "count_if(NOT isfinite(PricePerSqFt))",
    "year_month_format": r"count_if(NOT regexp_full_match(YrMo, '\d{4}-\d{2}'))",
})
ORACLES["outlier_contracts"] = _checks(["excluded"], "excluded", {
    "row_count_unchanged": "abs(count(*) - (SELECT count(*) FROM lineitem))",
    "flags_present": "count_if(week7_exclusion_flag IS NULL)",
    "any_flag_combines_fields": """count_if(any_iqr_outlier_flag <> (close_price_iqr_outlier_flag
      OR living_area_iqr_outlier_flag OR days_on_market_iqr_outlier_flag))""",
    "exclusion_combines_flags": """count_if(week7_exclusion_flag <> (any_iqr_outlier_flag
      OR week7_business_rule_invalid_flag))""",
    "kept_rows_not_empty": "CASE WHEN count_if(NOT week7_exclusion_flag) > 0 THEN 0 ELSE 1 END",
})
ORACLES["rate_contracts"] = _checks(["enriched"], "enriched", {
    "row_count_unchanged": "abs(count(*) - (SELECT count(*) FROM lineitem))",
    "rate_matched": "count(*) - count(rate_30yr_fixed)",
})

ORACLES["segments_many"] = with_cte(["rich_features"], """
SELECT segment_field, segment_value, record_count, closed_sales_count, median_days_on_market,
  median_listing_to_contract_days, median_contract_to_close_days FROM (""" + union(
    _segment(f"'{name}' AS segment_field, {name} AS segment_value", name, "rich_features")
    for name in ("PropertyType", "PropertySubType", "CountyOrParish", "MLSAreaMajor", "ListOfficeName", "BuyerOfficeName")
) + ") t")
ORACLES["invalid_rules_all"] = with_cte(["rich"], """
SELECT *, invalid_close_price_flag OR invalid_living_area_flag OR invalid_days_on_market_flag
    OR invalid_bedrooms_flag OR invalid_bathrooms_flag AS any_invalid_numeric_flag
FROM (SELECT ListingKey, CASE WHEN BedroomsTotal >= 0 THEN BedroomsTotal END AS BedroomsTotal,
    CASE WHEN BathroomsTotalInteger >= 0 THEN BathroomsTotalInteger END AS BathroomsTotalInteger,
    coalesce(ClosePrice <= 0, false) AS invalid_close_price_flag,
    coalesce(LivingArea <= 0, false) AS invalid_living_area_flag,
    coalesce(DaysOnMarket < 0, false) AS invalid_days_on_market_flag,
    coalesce(BedroomsTotal < 0, false) AS invalid_bedrooms_flag,
    coalesce(BathroomsTotalInteger < 0, false) AS invalid_bathrooms_flag
  FROM rich) t""")
CTE["rich_flagged"] = (("rich", "iqr"), CTE["flagged"][1].replace("FROM sold s", "FROM rich s"))
ORACLES["exclusion_earlier_flags"] = with_cte(["rich_flagged"], """
SELECT ListingKey, any_iqr_outlier_flag, broken AS week7_business_rule_invalid_flag,
  any_iqr_outlier_flag OR broken AS week7_exclusion_flag
FROM (SELECT ListingKey,
    close_price_iqr_outlier_flag OR living_area_iqr_outlier_flag OR days_on_market_iqr_outlier_flag
      AS any_iqr_outlier_flag,
    coalesce(earlier_flag = 'True', false) OR coalesce(ClosePrice <= 0, false)
      OR coalesce(LivingArea <= 0, false) OR coalesce(DaysOnMarket < 0, false) AS broken
  FROM rich_flagged) t
WHERE NOT (any_iqr_outlier_flag OR broken)""")
ORACLES["coerce_date_formats"] = with_cte(["dirty"], f"""
SELECT event_id, {_NUMBER} AS num_text,
  coalesce({_TIME}, CAST(try_strptime(date_text, '%m/%d/%Y') AS TIMESTAMP)) AS date_text FROM dirty""")
ORACLES["enrich_date_formats"] = with_cte(["enriched"], """
SELECT ListingKey, strftime(CloseDate, '%m/%d/%Y') AS CloseDate, year_month, rate_30yr_fixed FROM enriched""")
ORACLES["date_format_votes"] = union(
    f"""SELECT '{name}' AS "column", '{fmt}[ H:mm[:ss]]' AS format, count(try_strptime({text}, '{parse}')) AS "values"
FROM lineitem"""
    for name, text in (
        ("month_first", "strftime(l_shipdate, '%m/%d/%Y')"), ("day_first", "strftime(l_shipdate, '%-d/%-m/%Y')"),
        ("packed", "strftime(l_shipdate, '%Y%m%d')"))
    for fmt, parse in (
        ("M/d/yyyy", "%m/%d/%Y"), ("d/M/yyyy", "%d/%m/%Y"), ("yyyy/M/d", "%Y/%m/%d"), ("M-d-yyyy", "%m-%d-%Y"),
        ("d-M-yyyy", "%d-%m-%Y"), ("d.M.yyyy", "%d.%m.%Y"), ("yyyyMMdd", "%Y%m%d"), ("d-MMM-yyyy", "%d-%b-%Y"),
        ("MMM d, yyyy", "%b %d, %Y"))
)
ORACLES["repeated_months"] = with_cte(["rates_raw"], """
SELECT strftime(observation_date, '%Y-%m') AS year_month, count(*) AS copies
FROM rates_raw WHERE try_cast(rate_text AS DOUBLE) IS NOT NULL GROUP BY 1 HAVING count(*) > 1""")
ORACLES["fields_without_numbers"] = with_cte(["sold"], """
SELECT 'Nothing' AS field, count(*) AS missing_count FROM sold""")
ORACLES["dropped_columns"] = with_cte(["sold"], """
SELECT 'sold' AS dataset, 'Rare' AS "column", 'More than 90% missing values' AS reason
FROM sold HAVING count(*) FILTER (WHERE DaysOnMarket = -3) < 0.1 * count(*)""")
ORACLES["unexpected_flags"] = union(
    f"""SELECT * FROM (SELECT DISTINCT '{name}' AS field, lower({name}) AS value FROM orders
  WHERE lower({name}) NOT IN ('true', '1', 'yes', 'false', '0', 'no') ORDER BY value LIMIT 5) t"""
    for name in ("o_orderstatus", "o_orderpriority")
)
ORACLES["reports_of_both"] = with_cte(["sold", "listings"], union(
    ORACLES["filter_counts"].rsplit(")\n", 1)[-1].replace("'sold'", f"'{name}'").replace("FROM sold", f"FROM {name}")
    for name in ("sold", "listings")
))
