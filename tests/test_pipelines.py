"""The whole way from monthly CSV files to monthly measures."""

import pytest

from deedflow import fields as f
from deedflow.operators.checks import ContractError
from deedflow.plans import pipelines
from deedflow.sources import files

SOLD_HEADER = (
    "ListingKey,PropertyType,PropertySubType,City,CountyOrParish,PostalCode,ClosePrice,ListPrice,"
    "OriginalListPrice,LivingArea,DaysOnMarket,Latitude,Longitude,ListingContractDate,"
    "PurchaseContractDate,CloseDate,ClosePrice,Sparse"
)
LISTING_HEADER = (
    "PropertyType,ListingKey,PropertySubType,City,CountyOrParish,PostalCode,ListPrice,OriginalListPrice,"
    "Latitude,Longitude,ListingContractDate"
)


def sold_line(i: int, month: int, kind: str = "Residential") -> str:
    price = 500_000 + 1_000 * i
    if i == 13:
        price = 90_000_000
    area = 0 if i == 7 else 1_500 + 10 * i
    sparse = "x" if i == 1 and month == 1 else ""
    return (
        f'k{month}-{i},{kind},SFR, Napa ,Napa,94558.0,{price},{price + 500},{price + 1000},{area},{i},38.3,-122.3,'
        f"2024-0{month}-01,2024-0{month}-05,2024-0{month}-{20 + i % 8},{price}.0,{sparse}"
    )


@pytest.fixture(scope="module")
def feed(tmp_path_factory):
    folder = tmp_path_factory.mktemp("feed")
    for month in (1, 2):
        lines = [sold_line(i, month) for i in range(1, 31)] + [sold_line(40, month, "Land")]
        (folder / f"Sold20240{month}.csv").write_text("\n".join([SOLD_HEADER, *lines]) + "\n")
        listed = [
            f"Residential,l{month}-{i},SFR,Napa,Napa,94558,{i}000,{i}100,38.3,-122.3,2024-0{month}-0{1 + i % 9}"
            for i in range(20)
        ]
        (folder / f"Listing20240{month}.csv").write_text("\n".join([LISTING_HEADER, *listed]) + "\n")
    filled = [sold_line(i, 2) for i in range(1, 30)]
    (folder / "Sold202402_filled.csv").write_text("\n".join([SOLD_HEADER, *filled]) + "\n")
    (folder / "rates.csv").write_text(
        "observation_date,MORTGAGE30US\n2024-01-04,6.62\n2024-01-11,6.66\n2024-02-01,.\n2024-02-08,6.64\n"
    )
    return folder


@pytest.fixture(scope="module")
def steps(spark, feed, tmp_path_factory):
    work = str(tmp_path_factory.mktemp("work"))
    out = {}
    monthly = pipelines.rates.monthly_average(files.read_rates(spark, f"{feed}/rates.csv"))
    for dataset, date in (("listings", "ListingContractDate"), ("sold", "CloseDate")):
        pattern = f"{feed}/{'Listing' if dataset == 'listings' else 'Sold'}*.csv"
        suffix = "_filled" if dataset == "sold" else None
        ingested = pipelines.ingest(spark, pattern, dataset, work, suffix)
        audited = pipelines.audit_and_prune(ingested["table"], dataset)
        enriched = pipelines.enrich(audited["table"], monthly, date, dataset)
        cleaned = pipelines.clean(enriched["table"], dataset, work)
        out[dataset] = {"ingest": ingested, "audit": audited, "enrich": enriched, "clean": cleaned}
    out["explore"] = pipelines.explore_sold(out["sold"]["audit"]["table"])
    out["engineer"] = pipelines.engineer(out["sold"]["clean"]["table"])
    out["outliers"] = pipelines.remove_outliers(out["engineer"]["table"], work)
    out["events"] = pipelines.build_events(out["listings"]["clean"]["table"], out["outliers"]["table"], work)
    return out


def test_ingest(steps):
    ingested = steps["sold"]["ingest"]
    assert ingested["table"].count() == 59
    assert tuple(ingested["filter"].first()) == ("sold", 60, 59, 1)
    rows = {r["source_file"]: r["row_count"] for r in ingested["files"].collect()}
    assert rows == {"Sold202401.csv": 31, "Sold202402_filled.csv": 29, None: 60}
    assert files.unions_reconcile(ingested["files"])


def test_audit(steps):
    audited = steps["sold"]["audit"]
    assert "Sparse" not in audited["table"].columns
    assert [r["column"] for r in audited["dropped"].collect()] == ["Sparse"]
    assert audited["missingness"].first()["column"] == "Sparse"
    assert audited["property_types"].first()["percent"] == 100.0


def test_enrich(steps):
    row = steps["sold"]["enrich"]["quality"].first()
    assert (row["row_count_before"], row["row_count_after"], row["all_rows_matched"]) == (59, 59, True)
    assert steps["sold"]["enrich"]["table"].filter("year_month = '2024-02'").first()["rate_30yr_fixed"] == 6.64


def test_unmatched_rates_stop_the_pipeline(spark, steps, tmp_path):
    monthly = spark.createDataFrame([("2024-01", 6.6)], "year_month string, rate_30yr_fixed double")
    with pytest.raises(ContractError, match="rate_matched"):
        pipelines.enrich(steps["sold"]["audit"]["table"], monthly, "CloseDate", "sold", str(tmp_path))


def test_clean(steps):
    cleaned = steps["sold"]["clean"]
    assert "ClosePrice.1" not in cleaned["table"].columns
    assert cleaned["redundant"].first()["conflicting_non_missing_values"] == 0
    assert cleaned["dataset"].first()["redundant_columns_removed"] == 1
    found = {r["field"]: r["invalid_values_found"] for r in cleaned["numeric"].collect()}
    assert found == {"ClosePrice": 0, "LivingArea": 2, "DaysOnMarket": 0}
    assert {r["values_coerced_to_missing"] for r in cleaned["types"].collect()} == {0}
    assert {r["flagged_rows"] for r in cleaned["geographic"].collect()} == {0}


def test_explore(steps):
    tables = steps["explore"]
    assert {r["field"] for r in tables["numeric_summary"].collect()} >= {"ClosePrice", "LivingArea"}
    assert tables["histogram_ClosePrice"].agg({"count": "sum"}).first()[0] == 59
    assert tables["top_counties"].first()["transaction_count"] == 59
    assert tables["close_before_listing"].first()["rows"] == 0


def test_engineer(steps):
    tables = steps["engineer"]
    assert tables["table"].count() == 59
    assert all(r["passed"] for r in tables["checks"].collect())
    segments = {r["segment_field"] for r in tables["segments"].collect()}
    assert segments == {"PropertyType", "PropertySubType", "CountyOrParish"}
    assert tables["sample"].count() == 10


def test_outliers(steps, tmp_path):
    tables = steps["outliers"]
    full, kept = tables["comparison"].collect()
    assert full["row_count"] == 59
    assert kept["row_count"] == tables["table"].count() == 55
    assert tables["table"].filter("ClosePrice > 1000000").isEmpty()
    with pytest.raises(ContractError, match="row_count"):
        pipelines.remove_outliers(steps["engineer"]["table"], str(tmp_path), expected_rows=60)


def test_events(steps):
    tables = steps["events"]
    assert tables["table"].columns == f.EVENT_SCHEMA.names
    assert tables["table"].count() == 40 + 55
    assert [r["new_listings"] for r in tables["monthly"].collect()] == [20, 20]
    assert {r["dataset"]: r["output_rows"] for r in tables["preparation"].collect()} == {
        "new_listing_events": 40, "closed_sale_events": 55, "combined_events": 95
    }


def test_reports_are_written(spark, steps, tmp_path):
    reports = {name: steps["events"][name] for name in ("preparation", "coverage", "ratio_cleaning")}
    pipelines.write_reports(reports, str(tmp_path))
    back = files.read_table(spark, f"{tmp_path}/coverage", "csv")
    assert back.count() == 14


@pytest.mark.parametrize("formats", [["MM/dd/yyyy"], None])
def test_dates_in_another_format(spark, feed, tmp_path, formats):
    """All steps on dates like 01/20/2024, as they come and before any cleaning, with formats given or inferred."""
    import re

    def american(match):
        year, month, day = match.groups()
        # Some days after the twelfth in every column tell months from days.
        return f"{month}/{day if formats or day > '12' else int(day) + 12}/{year}"

    for name in ("Sold202401.csv", "Listing202401.csv", "rates.csv"):
        text = (feed / name).read_text()
        (tmp_path / name).write_text(re.sub(r"(\d{4})-(\d\d)-(\d\d)", american, text))
    work = str(tmp_path / "work")
    monthly = pipelines.rates.monthly_average(files.read_rates(spark, f"{tmp_path}/rates.csv", formats=formats))
    cleaned = {}
    for dataset, date in (("Listing", "ListingContractDate"), ("Sold", "CloseDate")):
        table = pipelines.ingest(spark, f"{tmp_path}/{dataset}2*.csv", dataset, work)["table"]
        explored = pipelines.explore_sold(table, formats=formats) if dataset == "Sold" else {}
        if explored:
            assert explored["close_before_listing"].first()[0] == 0
        enriched = pipelines.enrich(table, monthly, date, dataset, formats=formats)["table"]
        assert enriched.filter("year_month IS NULL").count() == 0
        cleaned[dataset] = pipelines.clean(enriched, dataset, formats=formats)["table"]
    sold = pipelines.engineer(cleaned["Sold"], formats=formats)["table"]
    kept = pipelines.remove_outliers(sold)["table"]
    built = pipelines.build_events(cleaned["Listing"], kept, work, ordered=True)
    assert built["table"].filter("EventType = 'New Listing'").count() == 20
    assert built["table"].filter("EventMonth IS NULL").count() == 0
    direct = pipelines.events.listing_events(
        spark.read.option("header", True).csv(f"{tmp_path}/Listing202401.csv"), formats=formats or ["MM/dd/yyyy"])
    assert direct.count() == 20


def test_ambiguous_dates_stop_a_step(spark):
    df = spark.createDataFrame([("01/02/2024",), ("03/04/2024",)], "CloseDate string")
    monthly = spark.createDataFrame([("2024-01", 6.6), ("2024-03", 6.6)], "year_month string, rate_30yr_fixed double")
    with pytest.raises(ContractError, match="CloseDate"):
        pipelines.enrich(df, monthly, "CloseDate", "sold")
    assert pipelines.enrich(df, monthly, "CloseDate", "sold", formats=["MM/dd/yyyy"])["table"].count() == 2


def _jobs(spark, name, run):
    spark.sparkContext.setJobGroup(name, name)
    result = run()
    jobs = spark.sparkContext.statusTracker().getJobIdsForGroup(name)
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    return result, len(jobs)


def test_staged_steps_are_verified_by_their_own_write(spark, steps, monkeypatch, tmp_path):
    """No scan counts rows: neither the source nor the staged table is aggregated for the checks."""
    monkeypatch.setattr(pipelines, "_rows", lambda df: pytest.fail("rows are counted by a scan"))
    monkeypatch.setattr(pipelines.checks, "check", lambda *_: pytest.fail("checks are counted by a scan"))
    work, monthly = str(tmp_path), spark.createDataFrame([("2024-01", 6.6), ("2024-02", 6.7)], "year_month string, rate_30yr_fixed double")
    table = steps["sold"]["audit"]["table"]
    enriched, jobs = _jobs(spark, "enrich", lambda: pipelines.enrich(table, monthly, "CloseDate", "sold", work, formats=()))
    assert {r["check"]: r["violations"] for r in enriched["checks"].collect()} == {"row_count_unchanged": 0, "rate_matched": 0}
    # Jobs that check the rates, broadcast them, write the table and its line in the manifest, and read schemas.
    assert jobs <= 8
    cleaned, jobs = _jobs(spark, "clean", lambda: pipelines.clean(enriched["table"], "sold", work, formats=()))
    assert jobs <= 5 and cleaned["checks"].first()["passed"]
    built, jobs = _jobs(spark, "events", lambda: pipelines.build_events(
        steps["listings"]["clean"]["table"], steps["outliers"]["table"], work))
    assert all(r["passed"] for r in built["checks"].collect()) and built["table"].count() == 95


def test_a_lost_row_is_found_by_the_write(spark, steps, monkeypatch, tmp_path):
    monkeypatch.setattr(pipelines.quality, "clean", lambda df, formats=(): df.filter("DaysOnMarket <> '7'"))
    with pytest.raises(ContractError, match="row_count_unchanged"):
        pipelines.clean(steps["sold"]["enrich"]["table"], "sold", str(tmp_path))


REPORTS = ("redundant", "types", "numeric", "dates", "geographic")


def _reports(tables):
    return {name: (tables[name].schema.simpleString(), sorted(map(str, tables[name].collect()))) for name in REPORTS}


def test_clean_reports_come_from_the_write_or_from_two_scans(spark, steps, monkeypatch, tmp_path):
    """The same numbers as the reports computed one by one, in a write, and lazily."""
    from deedflow.operators import quality

    source = steps["sold"]["enrich"]["table"]
    source.write.parquet(str(tmp_path / "source"))
    source = spark.read.parquet(str(tmp_path / "source"))
    built = quality.clean(source)
    separate = {
        "redundant": quality.redundant_report(source, "sold"),
        "types": quality.coercion_report(quality.coalesce_redundant(source), "sold"),
        "numeric": quality.invalid_report(built, "sold"),
        "dates": quality.flag_summary(built, f.TIMELINE_FLAGS, "sold"),
        "geographic": quality.flag_summary(built, (*f.GEO_FLAGS, f.FILLED_FLAG), "sold"),
    }
    expected = _reports(separate)
    assert sum(len(rows) for _, rows in expected.values()) > 10
    summary = quality.dataset_summary(source, built, "sold").collect()
    lazy, jobs = _jobs(spark, "lazy-clean", lambda: pipelines.clean(source, "sold", formats=()))
    # Two aggregations, each of a job that scans and one that finishes, and one job that looks at the checks.
    assert jobs <= 5 and _reports(lazy) == expected and lazy["dataset"].collect() == summary
    monkeypatch.setattr(pipelines, "measures", _once_per_side(pipelines.measures))
    staged = pipelines.clean(source, "sold", str(tmp_path / "work"), formats=())
    assert _reports(staged) == expected and staged["dataset"].collect() == summary
    # Nothing is left to scan: the reports are rows of the plan.
    for name in REPORTS:
        assert "FileScan" not in staged[name]._jdf.queryExecution().toString()


def _once_per_side(measures):
    calls = []

    def counted(reports):
        calls.append(reports)
        assert len(calls) <= 2
        return measures(reports)
    return counted


def test_clean_recounts_what_a_repeated_task_may_have_counted_twice(spark, steps, monkeypatch, tmp_path):
    source = steps["sold"]["enrich"]["table"]
    stage_observed = pipelines.sinks.stage_observed

    def doubled(*args, **kwargs):
        table, seen = stage_observed(*args, **kwargs)
        return table, seen | {"rows_after": 2 * seen["rows_after"], "numeric": []}

    monkeypatch.setattr(pipelines.sinks, "stage_observed", doubled)
    tables = pipelines.clean(source, "sold", str(tmp_path), formats=())
    assert tables["checks"].first()["passed"] and tables["numeric"].count() == 3


def test_a_row_that_was_observed_twice_is_counted_again(spark, steps):
    table = steps["sold"]["clean"]["table"]
    rows = table.count()
    report = pipelines._enforced(
        table, {"row_count_unchanged": 1}, lambda: {"row_count_unchanged": pipelines.checks.rows_differ_from(rows)})
    assert report.first()["passed"]


def test_steps_on_an_empty_table(spark, steps, tmp_path):
    table = steps["sold"]["audit"]["table"].limit(0)
    cleaned = pipelines.clean(table, "sold", str(tmp_path))
    assert cleaned["table"].count() == 0 and cleaned["checks"].first()["passed"]


def test_a_second_run_leaves_the_tables_of_the_first(spark, steps, tmp_path):
    source = steps["sold"]["enrich"]["table"]
    first = pipelines.clean(source, "sold", str(tmp_path))["table"]
    rows = first.count()
    second = pipelines.clean(source.filter("ListingKey <> 'k1-1'"), "sold", str(tmp_path))["table"]
    assert second.count() == rows - 1 and first.count() == rows and first.filter("ListingKey = 'k1-1'").count() == 1
