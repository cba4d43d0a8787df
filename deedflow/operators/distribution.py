"""Exact distribution of numeric fields, for whole tables and for groups.

Spark's `percentile` keeps every distinct value of a group in the memory of
one task. The plan here has no such limit:

1. Values fall into cells of a fixed logarithmic scale, about 0.07 % wide.
   A cell is a monotone function of the value, so cell counts give the exact
   rank range of each cell. They are pre-aggregated before the shuffle, and a
   group has at most a few thousand of them however many rows it holds.
2. Only the cells that hold a wanted rank are opened: their values are counted
   once each, and each cell is cut into `PARTS` equal parts between its least and its
   largest value. Parts are counted, and only those that hold a wanted rank are ranked
   value by value. A cell holds 2 ** 42 different doubles, so a window sees some 2 ** 21
   parts or values at most, however many rows share a cell.

A whole table is scanned twice, and only cell counts and opened cells are shuffled.
Its wanted cells are broadcast, as fields and quantiles bound their number. The cells can be
computed once (`cell_counts`), staged, merged over groups such as months (`merge_cells`)
and handed to any number of reports, which then only open what they want.

Groups, and whole tables on request (`one_scan`), are scanned once: the distinct values of each
group are counted by one shuffle, which both the cells and the opened values read. Wanted cells
are joined without a hint, on exchanges that adaptive execution can split or turn into a broadcast.
Building the plan starts no job.

Fields in `moments` get no quantiles and none of their values is opened.

Where groups of any size meet, small ones by the million beside some of many rows, `group_medians` shuffles each row
once for all its fields, to be sorted with its group; the rows of large groups stay, and are read twice as those of a
whole table are (`few_groups`). Their cells are wider, so that a window sees some 2 ** 21 parts, or 2 ** 25 values at most.
"""

from __future__ import annotations

from collections.abc import Collection, Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from deedflow.functions.scalars import ref, to_double

CELLS_PER_OCTAVE = 1024
# Of large groups, which have cells of their own in every task: about 1 % wide.
WIDE_CELLS = 64
# Groups are told large from small by the present values of their bucket, a hash of their key.
BUCKETS = 1 << 17
LARGE = 1 << 17
BUCKET = "_bucket"
# Parts that a wanted cell is cut into.
PARTS = 1 << 21
PART = "_part"
# Octaves that lift the logarithm of the smallest double above zero.
OFFSET_OCTAVES = 1100
CELL_OFFSET = OFFSET_OCTAVES * CELLS_PER_OCTAVE
LARGEST_DOUBLE = 1.7976931348623157e308
MEDIAN = {"median": 0.5}

FIELD, VALUE, CELL, WEIGHT, GROUP = "_field", "_value", "_cell", "_weight", "_group"
# Cell of missing values, below all others.
MISSING_CELL = -(1 << 62)
SUMMARY = ("row_count", "non_missing_count", "total", "mean", "std", "min", "max")


def value_cell(value: str, per_octave: int = CELLS_PER_OCTAVE) -> Column:
    """Cell of a value: ordered like the values, 0 for zero."""
    step = (
        f"floor(log2(least(abs({value}), {LARGEST_DOUBLE}D)) * {per_octave}) + {OFFSET_OCTAVES * per_octave}"
    )
    return F.expr(
        f"coalesce(CASE WHEN {value} > 0 THEN {step} WHEN {value} < 0 THEN -({step})"
        f" WHEN {value} = 0 THEN 0 END, {MISSING_CELL})"
    )


def _quoted(names: Sequence[str]) -> list[str]:
    return ["`" + name.replace("`", "``") + "`" for name in names]


def _long_values(df: DataFrame, fields: Mapping[str, Column], by: Sequence[str]) -> DataFrame:
    """One row per row and field, the field as its position."""
    pairs = [
        part
        for position, value in enumerate(fields.values())
        for part in (F.lit(position), F.nanvl(value.cast("double"), F.lit(None)))
    ]
    return df.select(
        *[ref(name) for name in by],
        F.stack(F.lit(len(fields)), *pairs).alias(FIELD, VALUE),
    # Never NULL, so that joins add no filter and all uses share one exchange.
    ).withColumn(FIELD, F.expr(f"coalesce({FIELD}, -1)"))


def _rank(probability: float) -> str:
    """Fractional rank of a quantile among the present values, from 0."""
    return f"((non_missing_count - 1) * {float(probability)!r}D)"


def _covers(rank: str) -> str:
    return f"(_start <= {rank} AND {rank} < _start + _n)"


def _celled(
    df: DataFrame, fields: Mapping[str, Column], by: Sequence[str], per_octave: int = CELLS_PER_OCTAVE
) -> DataFrame:
    return _long_values(df, fields, by).withColumn(CELL, value_cell(VALUE, per_octave))


def _numeric(df: DataFrame, fields: Sequence[str] | Mapping[str, Column]) -> Mapping[str, Column]:
    return fields if isinstance(fields, Mapping) else {name: to_double(df, name) for name in fields}


def _cells(values: DataFrame, keys: Sequence[str]) -> DataFrame:
    return values.groupBy(*keys, CELL).agg(
        F.expr("count(1) AS _n"),
        F.expr(f"sum({VALUE}) AS _sum"),
        F.expr(f"var_pop({VALUE}) AS _variance"),
        F.expr(f"min({VALUE}) AS _low"),
        F.expr(f"max({VALUE}) AS _high"),
    ).selectExpr(*keys, CELL, "_n", "_sum", "if(_low < _high, _variance * _n, 0D) AS _inner", "_low", "_high")


def _cells_of_counts(counted: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Cells from values with their counts.

    Deviations are taken from the edge of the cell, so their squares are small. Digits are lost only
    where the values of a cell spread over less than some 1e-8 of their size.
    """
    edge = f"(signum({CELL}) * pow(2D, (abs({CELL}) - {CELL_OFFSET}) / {CELLS_PER_OCTAVE}D))"
    return counted.groupBy(*keys, CELL).agg(
        F.expr(f"sum({WEIGHT}) AS _n"),
        F.expr(f"sum({VALUE} * {WEIGHT}) AS _sum"),
        F.expr(f"sum(({VALUE} - {edge}) * {WEIGHT}) AS _first"),
        F.expr(f"sum(({VALUE} - {edge}) * ({VALUE} - {edge}) * {WEIGHT}) AS _second"),
        F.expr(f"min({VALUE}) AS _low"),
        F.expr(f"max({VALUE}) AS _high"),
    ).selectExpr(
        *keys, CELL, "_n", "_sum",
        "if(_low < _high, greatest(_second - _first * _first / _n, 0D), 0D) AS _inner", "_low", "_high")


def cell_counts(
    df: DataFrame, fields: Sequence[str] | Mapping[str, Column], by: Sequence[str] = ()
) -> DataFrame:
    """Count, sum, squared deviation and extremes of each cell, per group and field.

    A group has at most a few thousand rows per field. Tables of this kind add up: see `merge_cells`.
    Rows carry the position of their field, so `fields` must be the same, in the same order, wherever
    the cells are used.
    """
    return _cells(_celled(df, _numeric(df, fields), by), [*_quoted(by), FIELD])


def merge_cells(cells: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Cells of larger groups, or of the whole table, from those of smaller ones."""
    names = [*_quoted(by), FIELD, CELL]
    whole = f"PARTITION BY {', '.join(names)}"
    # Deviations from the merged mean, without cancellation. The window shares its exchange with the groups.
    return cells.selectExpr(
        *names, "_n", "_sum", "_inner", "_low", "_high",
        f"_sum / _n - sum(_sum) OVER ({whole}) / sum(_n) OVER ({whole}) AS _off",
    ).groupBy(*names).agg(
        F.expr("sum(_n) AS _n"), F.expr("sum(_sum) AS _sum"),
        F.expr("sum(_inner + _n * coalesce(_off * _off, 0D)) AS _inner"),
        F.expr("min(_low) AS _low"), F.expr("max(_high) AS _high"),
    )


def _ranked_cells(cells: DataFrame, keys: Sequence[str]) -> DataFrame:
    """All cells with the rank of their first value and the summary of their field."""
    whole = f"PARTITION BY {', '.join(keys)}"
    present = f"if({CELL} = {MISSING_CELL}, 0, _n)"
    # Deviations within the cells and between them, without cancellation.
    centre = "(_sum / _n - total / nullif(non_missing_count, 0))"
    # The ordered window comes first: its sort serves the others too.
    ranked = cells.selectExpr(
        "*", f"sum({present}) OVER ({whole} ORDER BY {CELL}) - {present} AS _start"
    ).selectExpr(
        "*",
        f"sum(_n) OVER ({whole}) AS row_count",
        f"sum({present}) OVER ({whole}) AS non_missing_count",
        f"sum(_sum) OVER ({whole}) AS total",
        f"min(_low) OVER ({whole}) AS min",
        f"max(_high) OVER ({whole}) AS max",
    ).selectExpr(
        "*", f"sum(_inner + _n * {centre} * {centre}) OVER ({whole}) AS _deviation"
    )
    return ranked.selectExpr(
        *keys, CELL, "_n", "_start", "_low", "_high", "non_missing_count",
        "struct(row_count, non_missing_count, total, min, max,"
        " total / nullif(non_missing_count, 0) AS mean,"
        " sqrt(_deviation / if(non_missing_count > 1, non_missing_count - 1, NULL)) AS std) AS _summary",
    )


def _described(df: DataFrame, fields: Mapping[str, Column], positions: Sequence[int], by: Sequence[str]) -> DataFrame:
    """Counts, moments and extremes alone: one row per group and field from one aggregation."""
    values = df.select(*[ref(name) for name in by], *[
        F.nanvl(value.cast("double"), F.lit(None)).alias(f"_v{i}") for i, value in enumerate(fields.values())])
    rows = ", ".join(
        f"struct({i} AS {FIELD}, count(1) AS row_count, count(_v{i}) AS non_missing_count, sum(_v{i}) AS total,"
        f" avg(_v{i}) AS mean, stddev_samp(_v{i}) AS std, min(_v{i}) AS min, max(_v{i}) AS max)"
        for i in positions)
    grouped = values.groupBy(*_quoted(by)).agg(F.expr(f"array({rows}) AS _rows"))
    return grouped.selectExpr(*_quoted(by), "inline(_rows)")


def wanted_cells(cells: DataFrame, quantiles: Mapping[str, float] = MEDIAN, by: Sequence[str] = ()) -> DataFrame:
    """Keys of the cells in which `distribution` looks for these quantiles; missing values are no cell.

    For a whole table at most two per field and quantile.
    """
    keys = [*_quoted(by), FIELD]
    ranked = _ranked_cells(cells, keys)
    return ranked.filter(f"{CELL} <> {MISSING_CELL} AND ({_wanted(list(quantiles.values()))})").select(*keys, CELL)


def count_values(
    df: DataFrame, fields: Sequence[str] | Mapping[str, Column], wanted: DataFrame,
    group: Column | None = None, grouped: Column | None = None,
) -> DataFrame:
    """Distinct values of the wanted cells with their counts, and those of groups, all from one scan.

    `wanted` (see `wanted_cells`) must be of a whole table, so that it may be broadcast. Rows of cells have
    no `group`. Those of groups count the values of `grouped` per value of `group`; rows that lack either
    are left out. Hand the parts (`values_of_cells`, `values_of_groups`) to `distribution` as `counted`.
    """
    fields = dict(_numeric(df, fields))
    last = len(fields)
    values = df.withColumn(GROUP, F.lit(None).cast("string") if group is None else group.cast("string"))
    if grouped is not None:
        fields[GROUP] = grouped
    celled = _celled(values, fields, [GROUP]).filter(f"{VALUE} IS NOT NULL")
    if grouped is not None:
        celled = celled.filter(f"{FIELD} < {last} OR {GROUP} IS NOT NULL")
    keyed = wanted.distinct().selectExpr(f"{FIELD} AS _w0", f"{CELL} AS _w1")
    hits = celled.join(F.broadcast(keyed), F.expr(f"{FIELD} = _w0 AND {CELL} = _w1"), "left").filter(
        f"_w0 IS NOT NULL OR {FIELD} = {last}")
    return hits.selectExpr(
        f"if({FIELD} = {last}, {GROUP}, NULL) AS {GROUP}", f"if({FIELD} = {last}, 0, {FIELD}) AS {FIELD}", CELL, VALUE
    ).groupBy(GROUP, FIELD, CELL, VALUE).agg(F.expr(f"count(1) AS {WEIGHT}"))


def values_of_cells(counted: DataFrame) -> DataFrame:
    return counted.filter(f"{GROUP} IS NULL").drop(GROUP)


def values_of_groups(counted: DataFrame, name: str) -> DataFrame:
    return counted.filter(f"{GROUP} IS NOT NULL").withColumnRenamed(GROUP, name)


def _wanted(probabilities: Sequence[float]) -> str:
    return " OR ".join(_covers(f"{side}{_rank(p)}") for p in probabilities for side in ("floor", "ceil"))


def distribution(
    df: DataFrame,
    fields: Sequence[str] | Mapping[str, Column],
    quantiles: Mapping[str, float] = MEDIAN,
    by: Sequence[str] = (),
    method: str = "exact",
    accuracy: int = 10_000,
    moments: Collection[str] = (),
    cells: DataFrame | None = None,
    one_scan: bool = False,
    counted: DataFrame | None = None,
    few_groups: bool = False,
) -> DataFrame:
    """Counts, moments, extremes and quantiles, one row per group and field.

    `fields` are column names, or names with the expressions to describe.
    Quantiles interpolate linearly between the two nearest ranks. Columns: the
    group columns, `field`, `row_count`, `non_missing_count`, `missing_count`,
    `total` (0 where nothing is present), `mean`, `std` (sample), `min`, `max`
    and one column per entry of `quantiles`.

    Fields named in `moments` have NULL quantiles and cost no second pass.
    `cells` are those of the same fields and groups (`cell_counts`); they save counting them.
    `counted` are values with their counts (`count_values`), of all wanted cells if `cells` are given, else
    of all cells; then the table itself is not read.
    `one_scan` reads a whole table once and shuffles the distinct values of its fields, as is
    done for groups: right where the table is dear to compute or its values repeat.
    `few_groups` reads a table of groups twice, as is done for whole tables, and shuffles cells and opened values
    only: right where groups have many rows each. Wanted cells are broadcast, two per group, field and quantile.
    `method="approx"` takes quantiles from a bounded sketch in one scan.
    """
    reserved = {"field", "missing_count", *SUMMARY, *quantiles}
    if reserved & set(by):
        raise ValueError(f"group columns named like results: {sorted(reserved & set(by))}")
    fields = _numeric(df, fields)
    if method == "approx":
        result = _approximate(df, fields, quantiles, by, accuracy)
    elif method == "exact":
        if few_groups and not (cells is None and counted is None):
            raise ValueError("few_groups counts its own cells")
        result = _exact(df, fields, quantiles, by, moments, cells, one_scan, counted, few_groups)
    else:
        raise ValueError(f"unknown method {method!r}")
    names = ", ".join("'" + name.replace("\\", "\\\\").replace("'", "\\'") + "'" for name in fields)
    measures = [
        f"element_at(array({names}), {FIELD} + 1) AS field",
        "coalesce(row_count, 0) AS row_count",
        "coalesce(non_missing_count, 0) AS non_missing_count",
        "coalesce(row_count - non_missing_count, 0) AS missing_count",
        "coalesce(total, 0D) AS total",
        "mean", "std", "min", "max",
        *_quoted(quantiles),
    ]
    if not by:
        # An empty table still yields one row per field.
        every = df.sparkSession.range(0, len(fields), 1, 1).selectExpr(f"CAST(id AS int) AS {FIELD}")
        result = every.join(F.broadcast(result), FIELD, "left")
    return result.selectExpr(*_quoted(by), *measures)


def _part(value: str) -> str:
    """Part of a cell between `_low` and `_high` that a value falls into: ordered like the values."""
    inside = f"least(greatest(({value} - _low) / (_high - _low), 0D), 1D)"
    return (
        f"CASE WHEN {value} = _low THEN 0 WHEN {value} = _high THEN {PARTS}"
        f" ELSE coalesce(1 + CAST(floor({inside} * {PARTS - 2}) AS int), 0) END"
    )


def _same(left: Sequence[str], right: Sequence[str], nullable: int) -> Column:
    """Equality of keys; the first `nullable` of them may be NULL."""
    return F.expr(" AND ".join(
        f"{a} {'<=>' if i < nullable else '='} {b}" for i, (a, b) in enumerate(zip(left, right))
    ))


def _exact(df, fields, quantiles, by, moments, cells, one_scan, counted, few_groups) -> DataFrame:
    keys = [*_quoted(by), FIELD]
    names = [*keys, CELL]
    probabilities = list(quantiles.values())
    whole = [i for i, name in enumerate(fields) if name in moments]
    described = None
    if whole and cells is None and (by or one_scan) and not few_groups:
        described = _described(df, fields, whole, by)
        if len(whole) == len(fields):
            return _without_quantiles(described, keys, quantiles)
    plain = f"{FIELD} IN ({', '.join(map(str, whole))})" if whole else "false"
    if counted is not None:
        opened, weight = counted, WEIGHT
        if cells is None:
            cells = _cells_of_counts(counted, keys)
    elif cells is None and (by or one_scan) and not few_groups:
        ranked = {name: value for i, (name, value) in enumerate(fields.items()) if i not in whole}
        opened = _celled(df, ranked, by)
        if whole:
            positions = ", ".join(str(i) for i in range(len(fields)) if i not in whole)
            opened = opened.withColumn(FIELD, F.expr(f"element_at(array({positions}), {FIELD} + 1)"))
        opened = opened.groupBy(*names, VALUE).agg(F.expr(f"count(1) AS {WEIGHT}"))
        cells = _cells_of_counts(opened, keys)
        weight = WEIGHT
    else:
        opened = _celled(df, fields, by, WIDE_CELLS if few_groups else CELLS_PER_OCTAVE)
        if cells is None:
            # One cell holds all values of a field that is only described.
            folded = opened.withColumn(
                CELL, F.expr(f"if({plain} AND {CELL} <> {MISSING_CELL}, 0, {CELL})")) if whole else opened
            cells = _cells(folded, keys)
        opened = opened.filter(f"NOT ({plain})") if whole else opened
        weight = "1"
        if by and not few_groups:
            opened = opened.groupBy(*names, VALUE).agg(F.expr(f"count(1) AS {WEIGHT}"))
            weight = WEIGHT
    cells = _ranked_cells(cells, keys)
    wanted = cells.filter(
        f"NOT ({plain}) AND if(non_missing_count = 0, true, {CELL} <> {MISSING_CELL} AND ({_wanted(probabilities)}))"
    )
    wanted = wanted.selectExpr(
        *[f"{name} AS _w{i}" for i, name in enumerate(names)], "_start", "_low", "_high", "_summary")
    if few_groups or not by:
        # A row per group, field and wanted rank at most.
        wanted = F.broadcast(wanted)
    keyed = [f"_w{i}" for i in range(len(names))]
    opened = opened.join(wanted, _same(names, keyed, len(by))).groupBy(
        *names, VALUE, "_start", "_low", "_high", "_summary"
    ).agg(F.expr(f"sum({weight}) AS _n"))
    opened = opened.withColumn(PART, F.expr(_part(VALUE)))
    inner = [*names, PART]
    kept = opened.groupBy(*inner).agg(
        F.expr("sum(_n) AS _n"), F.expr("first(_start) AS _start"),
        F.expr("first(_summary.non_missing_count) AS non_missing_count"),
    ).selectExpr(
        *inner, "_n", "non_missing_count",
        f"_start + sum(_n) OVER (PARTITION BY {', '.join(names)} ORDER BY {PART}) - _n AS _start",
    ).filter(f"non_missing_count = 0 OR {_wanted(probabilities)}").selectExpr(
        *[f"{name} AS _k{i}" for i, name in enumerate(inner)], "_start AS _part_start")
    if few_groups or not by:
        # Bounded as the wanted cells are.
        kept = F.broadcast(kept)
    opened = opened.join(kept, _same(inner, [f"_k{i}" for i in range(len(inner))], len(by)))
    names = inner
    before = f"sum(_n) OVER (PARTITION BY {', '.join(names)} ORDER BY {VALUE}) - _n"
    rest = [f"_summary.{name}" for name in SUMMARY]
    ranked = opened.selectExpr(*keys, VALUE, "_n", *rest, f"_part_start + {before} AS _start")
    measures = [f"first({name}) AS {name}" for name in SUMMARY]
    for i, p in enumerate(probabilities):
        for side in ("floor", "ceil"):
            covered = _covers(f"{side}{_rank(p)}")
            measures.append(f"max(if({covered}, {VALUE}, NULL)) AS _{side}{i}")
    result = ranked.groupBy(*keys).agg(*[F.expr(measure) for measure in measures])
    result = result.selectExpr(*keys, *SUMMARY, *[
        f"_floor{i} + (_ceil{i} - _floor{i}) * ({_rank(p)} - floor{_rank(p)}) AS {name}"
        for i, (name, p) in enumerate(zip(_quoted(quantiles), probabilities))
    ])
    if not whole:
        return result
    if described is None:
        described = cells.filter(plain).groupBy(*keys).agg(F.expr("first(_summary) AS _summary")).selectExpr(
            *keys, *rest)
    return result.unionByName(_without_quantiles(described, keys, quantiles))


def _without_quantiles(described: DataFrame, keys: Sequence[str], quantiles: Mapping[str, float]) -> DataFrame:
    return described.selectExpr(
        *keys, *SUMMARY, *[f"CAST(NULL AS double) AS {name}" for name in _quoted(quantiles)])


def _approximate(df, fields, quantiles, by, accuracy) -> DataFrame:
    keys = [*_quoted(by), FIELD]
    wanted = ", ".join(f"{float(p)!r}D" for p in quantiles.values())
    grouped = _long_values(df, fields, by).groupBy(*keys).agg(*[F.expr(measure) for measure in (
        "count(1) AS row_count",
        f"count({VALUE}) AS non_missing_count",
        f"sum({VALUE}) AS total",
        f"avg({VALUE}) AS mean",
        f"stddev_samp({VALUE}) AS std",
        f"min({VALUE}) AS min",
        f"max({VALUE}) AS max",
        f"percentile_approx({VALUE}, array({wanted}), {accuracy}) AS _sketch",
    )])
    return grouped.selectExpr(
        *keys, *SUMMARY, *[f"get(_sketch, {i}) AS {name}" for i, name in enumerate(_quoted(quantiles))]
    )


def _large_buckets(keyed: DataFrame, values: Sequence[str], large: int) -> DataFrame:
    """Buckets with more than `large` present values that also hold four times the mean; at most a quarter of all."""
    load = keyed.groupBy(BUCKET).agg(F.expr(" + ".join(f"count({value})" for value in values)).alias("_n"))
    return load.agg(
        F.expr("sum(_n) AS _total"), F.expr(f"collect_list(if(_n > {large}, struct({BUCKET}, _n), NULL)) AS _loaded")
    ).selectExpr("_total", "inline(_loaded)").filter(f"_n > 4 * _total / {BUCKETS}").select(BUCKET)


def group_medians(
    df: DataFrame, fields: Mapping[str, Column], by: Sequence[str], large: int = LARGE
) -> DataFrame:
    """Rows, present values, totals, means and exact medians of groups of any size, one row per group.

    Columns: the group columns, `row_count`, and `_count<i>`, `_total<i>`, `_mean<i>` and `_median<i>` of the field at
    each position, so that Spark leaves out those that nobody reads. NaN is missing; a total is 0 where nothing is
    present. Hash buckets of at most `large` present values, or of at most four times their mean, are shuffled row by row,
    and the values of a group are sorted in one task. All other groups go through `distribution` with `few_groups`.
    """
    keys = _quoted(by)
    names = [f"_v{i}" for i in range(len(fields))]
    keyed = df.select(
        *[ref(name) for name in by],
        *[F.nanvl(value.cast("double"), F.lit(None)).alias(name) for name, value in zip(names, fields.values())],
    ).withColumn(BUCKET, F.expr(f"pmod(xxhash64({', '.join(keys)}), {BUCKETS})"))
    hot = F.broadcast(_large_buckets(keyed, names, large))

    sorted_values = keyed.join(hot, BUCKET, "left_anti").drop(BUCKET).repartition(*keys).groupBy(*keys).agg(
        F.expr("count(1) AS row_count"),
        *[
            F.expr(text) for i, name in enumerate(names) for text in (
                f"count({name}) AS _count{i}", f"coalesce(sum({name}), 0D) AS _total{i}", f"avg({name}) AS _mean{i}",
                f"sort_array(collect_list({name})) AS _sorted{i}")
        ],
    )

    def at(i: int, side: str) -> str:
        return f"get(_sorted{i}, CAST({side}((_count{i} - 1) * 0.5D) AS int))"

    small = sorted_values.selectExpr(*keys, "row_count", *[
        text for i in range(len(names)) for text in (
            f"_count{i}", f"_total{i}", f"_mean{i}",
            f"{at(i, 'floor')} + ({at(i, 'ceil')} - {at(i, 'floor')}) * 0.5D * pmod(_count{i} - 1, 2) AS _median{i}")
    ])
    large_groups = distribution(
        keyed.join(hot, BUCKET, "left_semi"), {name: F.col(name) for name in names}, by=by, few_groups=True)
    pivoted = large_groups.groupBy(*keys).agg(F.expr("max(row_count) AS row_count"), *[
        F.expr(f"max(if(field = '{name}', {source}, NULL)) AS {measure}{i}")
        for i, name in enumerate(names) for source, measure in (
            ("non_missing_count", "_count"), ("total", "_total"), ("mean", "_mean"), ("median", "_median"))
    ])
    return small.unionByName(pivoted)
