import random

import pytest
from pyspark.sql import functions as F

from deedflow.operators.checks import ContractError
from deedflow.sources import files, records, sinks, staging


def write(folder, name, text):
    path = folder / name
    path.write_text(text, encoding="utf-8")
    return str(path)


def test_listing_and_versions(spark, tmp_path):
    for name in ("S202401.csv", "S202401_filled.csv", "S202402.csv", "S202403_filled.csv", "L202401.csv"):
        write(tmp_path, name, "A\n1\n")
    found = files.list_files(spark, f"{tmp_path}/S*.csv")
    assert [p.rsplit("/", 1)[-1] for p in files.file_paths(found)] == [
        "S202401.csv", "S202401_filled.csv", "S202402.csv", "S202403_filled.csv"
    ]
    chosen = [p.rsplit("/", 1)[-1] for p in files.file_paths(files.prefer_versions(found))]
    assert chosen == ["S202401_filled.csv", "S202402.csv", "S202403_filled.csv"]


def test_union_aligns_by_name(spark, tmp_path):
    paths = [
        write(tmp_path, "a 1.csv", "A,B\n1,2\n"),
        write(tmp_path, "b+2.csv", "B,A,C\n3,4,5\n"),
        write(tmp_path, "c.csv", "A,B\n"),
    ]
    df = files.read_union(spark, paths)
    assert df.columns == ["A", "B", "C", "source_file"]
    assert sorted(tuple(r) for r in df.collect()) == [
        ("1", "2", None, "a 1.csv"), ("4", "3", "5", "b+2.csv")
    ]
    report = files.file_report(df, files.read_headers(spark, paths))
    got = {r["source_file"]: (r["column_count"], r["row_count"], r["is_total"]) for r in report.collect()}
    assert got == {
        "a 1.csv": (2, 1, False), "b+2.csv": (3, 1, False), "c.csv": (2, 0, False), None: (3, 2, True)
    }
    assert files.unions_reconcile(report)
    assert not files.unions_reconcile(report.filter("source_file IS NULL OR source_file <> 'b+2.csv'"))


def test_equal_names_in_two_folders(spark, tmp_path):
    for folder, text in (("y", "A\n1\n2\n"), ("z", "A,B\n3,4\n")):
        (tmp_path / folder).mkdir()
        write(tmp_path / folder, "S202401.csv", text)
    found = files.prefer_versions(files.list_files(spark, f"{tmp_path}/*/S*.csv"))
    paths = files.file_paths(found)
    assert len(paths) == 2
    headers = files.read_headers(spark, paths)
    df = files.read_union(spark, paths, headers=headers)
    report = files.file_report(df, headers)
    got = {r["source_file"]: (r["column_count"], r["row_count"]) for r in report.collect()}
    assert got == {"y/S202401.csv": (1, 2), "z/S202401.csv": (2, 1), None: (2, 3)}
    assert files.unions_reconcile(report, 3)
    # The staged copy lost a row.
    assert not files.unions_reconcile(report, 4)


def test_headers_take_one_job(spark, tmp_path):
    paths = [write(tmp_path, f"f{k}.csv", f"A,B{k}\n1,2\n") for k in range(12)]
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("headers", "headers")
    headers = files.read_headers(spark, paths)
    jobs = tracker.getJobIdsForGroup("headers")
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert headers == {path: ("A", f"B{k}") for k, path in enumerate(paths)}
    assert len(jobs) <= 2


def test_repeated_header_names(spark, tmp_path):
    path = write(tmp_path, "a.csv", "A,B,A,,A.1\n1,2,3,4,5\n")
    df = files.read_union(spark, [path])
    assert df.columns == ["A", "B", "A.2", "Unnamed: 3", "A.1", "source_file"]
    assert tuple(df.first())[:5] == ("1", "2", "3", "4", "5")
    assert files.unique_names(["A", "B", "A"]) == ["A", "B", "A.1"]


def test_names_that_differ_in_case(spark, tmp_path):
    paths = [write(tmp_path, "a.csv", "A\n1\n"), write(tmp_path, "b.csv", "a\n1\n")]
    with pytest.raises(ContractError, match="case"):
        files.read_union(spark, paths)
    with pytest.raises(ContractError):
        files.read_union(spark, [])


def test_dialect(spark, tmp_path):
    path = write(tmp_path, "a.csv", 'A,B\n1,"line1\nline2"\n2,"say ""hi"""\n3,NA\n4,""\n5,n/a\n6," NA"\n')
    rows = files.read_union(spark, [path]).orderBy("A").collect()
    assert [r["B"] for r in rows] == ["line1\nline2", 'say "hi"', None, None, None, " NA"]


def test_files_with_line_breaks_are_found(spark, tmp_path):
    paths = [
        write(tmp_path, "broken 1.csv", 'A,B\n1,"x\ny"\n'),
        write(tmp_path, "plain.csv", 'A,B\n1,"x, ""y"""\n2,z\n'),
    ]
    assert files.files_with_line_breaks(spark, paths) == {paths[0]}
    for multi_line in (None, True):
        rows = files.read_union(spark, paths, multi_line).orderBy("source_file", "A").collect()
        assert [r["B"] for r in rows] == ["x\ny", 'x, "y"', "z"]


def _field(rng, line_end):
    return rng.choice([
        f'"a{line_end}b ""c"" ,d{line_end}{line_end} e"', '"x, ""y"""', '5" pipe', "", '"' + line_end.join("l" * rng.randrange(60)) + '"',
        f"v{rng.randrange(1000)}", '"other\nend"', ' "late', '""', "NA",
    ])


@pytest.fixture
def small_splits(spark):
    for key, value in (("maxPartitionBytes", "4096"), ("openCostInBytes", "0")):
        spark.conf.set(f"spark.sql.files.{key}", value)
    yield
    for key in ("maxPartitionBytes", "openCostInBytes"):
        spark.conf.unset(f"spark.sql.files.{key}")


@pytest.mark.parametrize("line_end", ["\n", "\r\n"])
def test_a_large_file_with_breaks_is_read_by_many_tasks(spark, tmp_path, small_splits, line_end):
    rng = random.Random(len(line_end))
    lines = ['A,"B', '1",C'] + [f"{k},{_field(rng, line_end)},{_field(rng, line_end)}" for k in range(1500)]
    # A record longer than a split, an empty line, and no line end at the end of the file.
    lines[700:700] = ["x," + '"' + (line_end.join(["long"] * 2000)) + '",y', ""]
    path = tmp_path / "big.csv"
    path.write_bytes(line_end.join(lines).encode())
    (tmp_path / "plain.csv").write_text("A,C\n1,2\n")
    paths = [str(path), str(tmp_path / "plain.csv")]
    found = files.read_union(spark, paths)
    lines = files._lines(spark, [str(path)])
    assert lines.select("block").distinct().count() > 10 and lines.rdd.getNumPartitions() > 10
    whole = files.read_union(spark, paths, multi_line=True)
    assert found.columns == whole.columns
    assert sorted(map(str, found.collect())) == sorted(map(str, whole.collect()))
    assert found.count() == 1502
    table = files.read_table(spark, str(path), "csv")
    assert sorted(map(str, table.collect())) == sorted(map(str, whole.filter("source_file = 'big.csv'").drop("source_file").collect()))


def test_a_file_that_ends_inside_a_field_is_read_in_one_piece(spark, tmp_path, small_splits):
    text = "A,B\n" + "".join(f"{k},plain\n" for k in range(50)) + '51,"never closed\n' + "more\n" * 40
    path = write(tmp_path, "open.csv", text)
    assert files.unclosed_files(spark, [path]) == {path} and files.unclosed_files(spark, []) == set()
    found = files.read_union(spark, [path])
    assert sorted(map(str, found.collect())) == sorted(map(str, files.read_union(spark, [path], multi_line=True).collect()))


@pytest.mark.parametrize("line,outside,inside", [
    ("a,b", False, True), ('a,"b', True, False), ('a",b', False, False), ('"a","b', True, True), ('5" x,y', False, False),
    ('x"",y', False, True), ('""', False, True), ('"",', False, True), ('","', False, True), ("", False, True), ('"""', True, False),
])
def test_states_of_a_line(spark, line, outside, inside):
    row = spark.createDataFrame([(line,)], "value string").select(
        records.ends_inside(F.col("value"), False), records.ends_inside(F.col("value"), True)).first()
    assert tuple(row) == (outside, inside)


def test_writes_are_observed(spark, tmp_path):
    df = spark.range(100).withColumn("month", (F.col("id") % 3).cast("int"))
    staged, seen = sinks.stage_observed(
        df, str(tmp_path), "t", {"rows": F.count(F.lit(1)), "odd": F.count_if(F.col("id") % 2 == 1)}, ["month"])
    assert staged.count() == 100 and seen == {"rows": 100, "odd": 50}


def test_single_line_mode(spark, tmp_path):
    path = write(tmp_path, "a.csv", 'A,B\n1,"x, y"\n2,z\n')
    rows = files.read_union(spark, [path], multi_line=False).orderBy("A").collect()
    assert [r["B"] for r in rows] == ["x, y", "z"]


def test_selected_columns(spark):
    df = spark.createDataFrame([(1, 2, 3)], "a int, b int, c int")
    assert files.select_available(df, ["c"], ["a", "z"]).columns == ["c", "a"]
    with pytest.raises(ContractError, match="sold.*z"):
        files.select_available(df, ["z"], what="sold")


def test_csv_round_trip(spark, tmp_path):
    df = spark.createDataFrame([("x", 'a "b"'), (None, "l1\nl2")], "k string, t string").withColumn(
        "d", F.to_date(F.lit("2024-05-06"))
    )
    sinks.write_dataset(df, f"{tmp_path}/out", "csv")
    back = files.read_table(spark, f"{tmp_path}/out", "csv").orderBy(F.col("k").desc_nulls_last())
    assert [tuple(r) for r in back.collect()] == [("x", 'a "b"', "2024-05-06"), (None, "l1\nl2", "2024-05-06")]


def test_partitioned_stage(spark, tmp_path):
    df = spark.range(100).withColumn("month", (F.col("id") % 3).cast("int"))
    staged = sinks.stage(df, str(tmp_path), "t", partition_by=["month"])
    assert staged.count() == 100
    assert sorted(p.name for p in (tmp_path / "t").glob("data/*/month=*")) == ["month=0", "month=1", "month=2"]


def test_versions_leave_readers_of_earlier_ones_intact(spark, tmp_path):
    path = f"{tmp_path}/table"
    sinks.publish(spark.range(10), path)
    first = sinks.read_published(spark, path)
    # A run that dies midway: some of its tasks are done, the others raise.
    broken = spark.range(0, 100, 1, 4).select(
        F.when(F.col("id") < 90, F.col("id")).otherwise(F.raise_error(F.lit("lost")).cast("long")).alias("id"))
    with pytest.raises(Exception, match="lost"):
        sinks.publish(broken, path)
    assert sinks.read_published(spark, path).count() == first.count() == 10
    # A run that reads the table it replaces.
    second = sinks.stage(first.filter("id > 3").unionByName(spark.range(100, 103)), str(tmp_path), "table")
    assert sinks.read_published(spark, path).count() == second.count() == 9
    assert first.count() == 10 and first.agg(F.max("id")).first()[0] == 9


def test_a_version_without_its_line_in_the_manifest_is_not_read(spark, tmp_path):
    path = f"{tmp_path}/table"
    kept = sinks.publish(spark.range(5), path)
    sinks.write_dataset(spark.range(50), f"{path}/data/99990101T000000000000-late")
    assert sinks.current_version(spark, path) == kept and sinks.read_published(spark, path).count() == 5
    with pytest.raises(Exception):
        sinks.current_version(spark, f"{tmp_path}/nothing")


def test_rates_file(spark, tmp_path):
    path = write(tmp_path, "r.csv", "observation_date,MORTGAGE30US\n2024-01-04,6.62\n2024-01-11,.\n")
    assert [r["rate_30yr_fixed"] for r in files.read_rates(spark, path).collect()] == [6.62]


def test_work_folder(spark):
    assert staging.work_folder(spark, "/x/") == "/x"
    assert staging.work_folder(spark) == spark.conf.get("spark.checkpoint.dir")
