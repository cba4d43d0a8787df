import math

import numpy as np
import pandas as pd
import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from deedflow.operators.distribution import (
    cell_counts, count_values, distribution, group_medians, merge_cells, value_cell, values_of_cells, values_of_groups,
    wanted_cells,
)

QUANTILES = {"p01": 0.01, "p25": 0.25, "median": 0.5, "p95": 0.95}


def close(a, b, tolerance=1e-9):
    if a is None or b is None or (isinstance(b, float) and math.isnan(b)):
        return a is None and (b is None or math.isnan(b))
    return a == pytest.approx(b, rel=tolerance, abs=tolerance)


def assert_matches_pandas(row, values: pd.Series):
    present = values.dropna()
    assert row["row_count"] == len(values)
    assert row["non_missing_count"] == len(present)
    assert row["missing_count"] == len(values) - len(present)
    assert close(row["total"], float(present.sum()))
    assert close(row["mean"], present.mean())
    # Both sides round the mean, which shows where large values lie close together.
    assert close(row["std"], present.std(), 1e-6)
    assert close(row["min"], present.min())
    assert close(row["max"], present.max())
    for name, p in QUANTILES.items():
        assert close(row[name], present.quantile(p)), name


numbers = st.one_of(
    st.none(),
    st.floats(-1e7, 1e7, allow_nan=False).map(lambda x: round(x, 2)),
    st.sampled_from([0.0, 1.0, -3.0, 825000.0, 825000.01]),
)


@settings(max_examples=8, derandomize=True, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(numbers, st.sampled_from(["a", "b", None])), max_size=60))
def test_whole_and_grouped_match_pandas(spark, rows):
    df = spark.createDataFrame(rows, "x double, g string").repartition(3)
    frame = pd.DataFrame(rows, columns=["x", "g"]).astype({"x": float})
    (whole,) = distribution(df, ["x"], QUANTILES).collect()
    assert_matches_pandas(whole, frame["x"])
    grouped = distribution(df, ["x"], QUANTILES, by=["g"]).collect()
    assert len(grouped) == frame["g"].nunique(dropna=False)
    for row in grouped:
        member = frame["g"].isna() if row["g"] is None else frame["g"] == row["g"]
        assert_matches_pandas(row, frame.loc[member, "x"])


def test_cells_are_ordered_like_values(spark):
    rng = np.random.default_rng(0)
    values = np.concatenate([
        rng.normal(0, 1, 300), 10.0 ** rng.uniform(-300, 300, 300), -(10.0 ** rng.uniform(-300, 300, 300)),
        [0.0, -0.0, 5e-324, -5e-324, 1.7976931348623157e308, float("inf"), float("-inf")],
    ])
    df = spark.createDataFrame([(float(v),) for v in values], "x double")
    cells = {row[0]: row[1] for row in df.select("x", value_cell("x")).collect()}
    ordered = [cells[v] for v in sorted(cells)]
    assert ordered == sorted(ordered)


def test_hot_value_and_hot_group(spark):
    df = spark.range(0, 30_000, 1, 8).select(
        F.when(F.col("id") % 3 == 0, F.lit(0.0)).otherwise(F.col("id") * 1.37).alias("x"),
        F.when(F.col("id") % 10 < 7, "hot").otherwise(F.col("id").cast("string")).alias("g"),
    )
    frame = df.toPandas()
    (row,) = distribution(df, ["x"], QUANTILES).collect()
    assert_matches_pandas(row, frame["x"])
    grouped = distribution(df, ["x"], QUANTILES, by=["g"])
    (hot,) = grouped.filter("g = 'hot'").collect()
    assert_matches_pandas(hot, frame.loc[frame["g"] == "hot", "x"])
    assert grouped.count() == frame["g"].nunique()


def test_a_million_values_in_one_cell(spark):
    # All within 0.01 % of each other, the extremes of the cell among them.
    df = spark.range(0, 1_000_000, 1, 8).select((F.col("id") * 7919 % 1_000_003 * 1e-10 + 1.0001).alias("x"))
    frame = df.toPandas()
    assert df.select(value_cell("x")).distinct().count() == 1
    (row,) = distribution(df, ["x"], QUANTILES).collect()
    assert_matches_pandas(row, frame["x"])
    (row,) = distribution(df.withColumn("g", F.lit("g")), ["x"], QUANTILES, by=["g"]).collect()
    assert_matches_pandas(row, frame["x"])


def test_building_the_plan_starts_no_job(spark):
    df = spark.range(100).select(F.col("id").cast("double").alias("x"), (F.col("id") % 7).alias("g"))
    tracker = spark.sparkContext.statusTracker()
    before = len(tracker.getJobIdsForGroup(None))
    distribution(df, ["x"], QUANTILES, by=["g"])
    assert len(tracker.getJobIdsForGroup(None)) == before


def test_fields_with_moments_only(spark):
    df = spark.createDataFrame([(1.0, 2.0, "a"), (3.0, None, "a"), (None, None, "b")], "x double, y double, g string")
    for by in ([], ["g"]):
        full = {(r["field"], *(r[n] for n in by)): r for r in distribution(df, ["x", "y"], QUANTILES, by=by).collect()}
        part = distribution(df, ["x", "y"], QUANTILES, by=by, moments=["y"]).collect()
        assert len(part) == len(full)
        for row in part:
            other = full[(row["field"], *(row[n] for n in by))].asDict()
            for name in ("row_count", "non_missing_count", "total", "mean", "std", "min", "max"):
                assert row[name] == other[name]
            for name in QUANTILES:
                assert row[name] == (None if row["field"] == "y" else other[name])


def test_infinite_values_keep_their_place(spark):
    values = [float("-inf"), -1.7e308, 0.0, 1.7e308, float("inf"), float("inf"), 1.7976931348623157e308]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    (row,) = distribution(df, {"x": F.col("x")}, {"r3": 0.5}).collect()
    assert row["r3"] == sorted(values)[3]


def test_empty_and_all_missing(spark):
    empty = spark.createDataFrame([], "x double, y double")
    rows = distribution(empty, ["x", "y"]).collect()
    assert [(r["field"], r["row_count"], r["total"], r["median"]) for r in rows] == [
        ("x", 0, 0.0, None), ("y", 0, 0.0, None)
    ]
    missing = spark.createDataFrame([(None,), (None,)], "x double")
    (row,) = distribution(missing, ["x"]).collect()
    assert (row["row_count"], row["missing_count"], row["mean"], row["median"]) == (2, 2, None, None)


def test_single_value_has_no_deviation(spark):
    (row,) = distribution(spark.createDataFrame([(0.1,)], "x double"), ["x"]).collect()
    assert (row["std"], row["median"]) == (None, 0.1)
    (row,) = distribution(spark.createDataFrame([(0.1,)] * 7, "x double"), ["x"]).collect()
    assert row["std"] == pytest.approx(0.0, abs=1e-12)


def test_partitioning_does_not_matter(spark):
    df = spark.range(1000).select((F.col("id") * 7919 % 1009 / 3).alias("x"))
    one = distribution(df.repartition(1), ["x"], QUANTILES).collect()[0].asDict()
    many = distribution(df.repartition(8), ["x"], QUANTILES).collect()[0].asDict()
    for name, value in one.items():
        assert many[name] == value or many[name] == pytest.approx(value, rel=1e-12)


def test_approximate_quantiles_are_near(spark):
    df = spark.range(10_000).select(F.col("id").cast("double").alias("x"))
    (row,) = distribution(df, ["x"], QUANTILES, method="approx").collect()
    assert row["median"] == pytest.approx(5000, abs=5)
    with pytest.raises(ValueError):
        distribution(df, ["x"], method="guess")


def test_column_names_with_dots(spark):
    df = spark.createDataFrame([(1.0, "k"), (3.0, "k")], "`X.1` double, `g.1` string")
    (row,) = distribution(df, ["X.1"], by=["g.1"]).collect()
    assert (row["g.1"], row["field"], row["median"]) == ("k", "X.1", 2.0)


def test_group_names_must_not_hide_results(spark):
    with pytest.raises(ValueError, match="mean"):
        distribution(spark.range(1).withColumnRenamed("id", "mean"), {"x": F.lit(1.0)}, by=["mean"])


def test_nan_of_an_expression_is_missing(spark):
    df = spark.createDataFrame([(1.0,), (float("nan"),), (3.0,)], "x double")
    (row,) = distribution(df, {"y": F.col("x") * 2}).collect()
    assert (row["non_missing_count"], row["missing_count"], row["median"], row["max"]) == (2, 1, 4.0, 6.0)


def test_deviation_of_near_values_does_not_cancel(spark):
    values = [825000.0, 825000.01, 825000.01]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    (row,) = distribution(df, ["x"]).collect()
    assert row["std"] == pytest.approx(pd.Series(values).std(), rel=1e-6)


def test_cells_add_up_and_serve_many_reports(spark):
    rng = np.random.default_rng(3)
    frame = pd.DataFrame({
        "x": np.round(rng.lognormal(10, 1, 600), 2), "y": rng.integers(-5, 5, 600).astype(float),
        "g": rng.choice(["a", "b", "c"], 600)})
    frame.loc[::7, "x"] = np.nan
    df = spark.createDataFrame(frame).repartition(4)
    merged = merge_cells(cell_counts(df, ["x", "y"], by=["g"]))
    counted = count_values(df, ["x", "y"], wanted_cells(merged, QUANTILES), F.col("g"), F.col("x"))
    opened = values_of_cells(counted)
    for options in ({"cells": merged}, {"cells": merged, "counted": opened}, {"one_scan": True}):
        rows = distribution(df, ["x", "y"], QUANTILES, **options).collect()
        assert [row["field"] for row in sorted(rows, key=lambda row: row["field"])] == ["x", "y"]
        for row in rows:
            assert_matches_pandas(row, frame[row["field"]])
    grouped = distribution(df, ["x"], QUANTILES, by=["g"], counted=values_of_groups(counted, "g")).collect()
    assert len(grouped) == 3
    for row in grouped:
        assert_matches_pandas(row, frame.loc[frame["g"] == row["g"], "x"].dropna())


def test_described_fields_of_groups(spark):
    df = spark.createDataFrame([("a", 1.0, 2.0), ("a", 3.0, None), ("b", None, None)], "g string, x double, y double")
    rows = {(row["g"], row["field"]): row for row in distribution(df, ["x", "y"], by=["g"], moments=["x"]).collect()}
    assert len(rows) == 4
    assert (rows["a", "x"]["mean"], rows["a", "x"]["median"], rows["a", "y"]["median"]) == (2.0, None, 2.0)
    assert (rows["b", "x"]["non_missing_count"], rows["b", "x"]["missing_count"], rows["b", "y"]["row_count"]) == (0, 1, 1)


@pytest.mark.parametrize("large", [200, 1 << 17])
def test_medians_of_large_and_small_groups(spark, large):
    rng = np.random.default_rng(5)
    size = 4000
    frame = pd.DataFrame({
        "x": np.round(rng.lognormal(3, 2, size), 2) * rng.choice([-1, 1], size), "y": rng.integers(-3, 4, size) * 1.0,
        "z": np.nan, "g": np.where(rng.random(size) < 0.5, "hot", rng.integers(0, 700, size).astype(str)).astype(object)})
    frame.loc[::9, "x"] = np.nan
    frame.loc[frame["g"] == "3", "y"] = np.nan
    frame.loc[::5, "g"] = None
    df = spark.createDataFrame(list(frame.itertuples(index=False)), "x double, y double, z double, g string").repartition(3)
    rows = group_medians(df, {name: F.col(name) for name in "xyz"}, ["g"], large).collect()
    assert len(rows) == frame["g"].nunique(dropna=False)
    for row in rows:
        part = frame[frame["g"].isna() if row["g"] is None else frame["g"] == row["g"]]
        assert row["row_count"] == len(part)
        for i, name in enumerate("xyz"):
            present = part[name].dropna()
            assert row[f"_count{i}"] == len(present)
            assert close(row[f"_total{i}"], present.sum())
            assert close(row[f"_mean{i}"], present.mean())
            assert close(row[f"_median{i}"], present.median())


def test_few_groups_equal_groups(spark):
    df = spark.range(0, 20_000, 1, 8).select(
        F.when(F.col("id") % 11 != 0, (F.col("id") * 7919 % 10_007 - 300) / 7).alias("x"), F.lit(None).cast("double").alias("y"),
        F.when(F.col("id") % 3 != 0, F.col("id") % 3).alias("g"))
    for fields, options in ((["x", "y"], {}), (["x", "y"], {"moments": ["x"]})):
        one, two = (
            sorted(distribution(df, fields, QUANTILES, by=["g"], few_groups=few, **options).collect(), key=str)
            for few in (False, True))
        assert len(one) == len(two) == 6
        for a, b in zip(one, two):
            assert (a["g"], a["field"]) == (b["g"], b["field"])
            assert all(close(a[name], b[name]) for name in a.asDict() if name not in ("g", "field")), (a, b)
