"""Formats of text dates found from all values."""

import datetime

import pytest
from pyspark.sql import functions as F

from deedflow.functions import scalars as s
from deedflow.operators import date_formats as d
from deedflow.operators.checks import ContractError


def dates(spark, **columns):
    rows = list(zip(*columns.values()))
    return spark.createDataFrame(rows, ", ".join(f"`{name}` string" for name in columns)).repartition(3)


def read(df, name, formats):
    return {row[0] for row in df.select(s.to_date(df, name, formats)).collect()}


@pytest.mark.parametrize("fmt", ["%m/%d/%Y", "%d/%m/%Y", "%Y/%m/%d", "%m-%d-%Y", "%d-%m-%Y", "%d.%m.%Y", "%Y%m%d", "%d-%b-%Y", "%b %d, %Y"])
def test_every_candidate_is_found(spark, fmt):
    days = [datetime.date(2024, 1, 1) + datetime.timedelta(k) for k in range(0, 200, 3)]
    df = dates(spark, x=[day.strftime(fmt) for day in days])
    assert read(df, "x", d.infer_formats(df, ["x"])) == set(days)


def test_one_value_decides_among_many_that_fit_both_orders(spark):
    df = dates(spark, **{"a.b": ["01/02/2024"] * 500 + ["31/01/2024"]})
    formats = d.infer_formats(df, ["a.b"])
    assert read(df, "a.b", formats) == {datetime.date(2024, 2, 1), datetime.date(2024, 1, 31)}


def test_ambiguous_dates_raise_and_name_their_column(spark):
    df = dates(spark, x=["01/02/2024", None, "03/04/2024"], y=["2024-01-02", "", "x"])
    with pytest.raises(ContractError, match="x .*M/d/yyyy.*d/M/yyyy"):
        d.infer_formats(df, ["x", "y"])
    assert d.formats_of(df, ["x", "y"], ["M/d/yyyy"]) == ["M/d/yyyy"]


def test_a_tie_without_disagreement_is_no_ambiguity(spark):
    df = dates(spark, x=["01/01/2024", "5/5/2024 7:30"])
    formats = d.infer_formats(df, ["x"])
    assert read(df, "x", formats) == {datetime.date(2024, 1, 1), datetime.date(2024, 5, 5)}
    assert df.select(F.max(s.to_timestamp(df, "x", formats))).first()[0] == datetime.datetime(2024, 5, 5, 7, 30)


def test_iso_and_unreadable_and_other_types_need_no_format(spark):
    df = dates(spark, iso=["2024-01-02", "2024-01-02 10:00:00"], odd=["soon", "13/13/2024"], none=["", None])
    df = df.withColumn("typed", F.lit(datetime.date(2024, 1, 1)))
    assert d.infer_formats(df, ["iso", "odd", "none", "typed", "absent"]) == {}
    assert d.infer_formats(df.limit(0), ["iso"]) == {}


def test_iso_and_another_format_mix(spark):
    df = dates(spark, x=["2024-03-04", "12/25/2024", "garbage"])
    assert read(df, "x", d.infer_formats(df, ["x"])) == {datetime.date(2024, 3, 4), datetime.date(2024, 12, 25), None}


def test_formats_are_kept_by_column(spark):
    df = dates(spark, us=["12/25/2024"], eu=["25/12/2024"])
    formats = d.infer_formats(df, ["us", "eu"])
    day = {datetime.date(2024, 12, 25)}
    assert read(df, "us", formats) == read(df, "eu", formats) == day


def test_votes_take_one_pass(spark, tmp_path):
    dates(spark, us=["12/25/2024"], eu=["25/12/2024"], more=["x"]).write.parquet(str(tmp_path / "t"))
    votes = d.format_votes(spark.read.parquet(str(tmp_path / "t")), ["us", "eu"])
    physical = votes._jdf.queryExecution().toString().split("== Physical Plan ==")[1]
    assert physical.count("FileScan") == 1 and "more" not in physical
