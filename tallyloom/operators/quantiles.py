"""Exact interpolated quantiles that do not gather a group in one task.

``percentile`` keeps every distinct value of a group, with its count, in one
buffer. Three ways keep that buffer small; each group takes the first that fits:

buffered  Groups of up to ``limit`` rows: ``percentile`` as it is.
counted   Groups of up to ``limit`` distinct values: rows are counted per value
          first, in parallel, and ``percentile`` weighs the values.
narrowed  All others. The wanted ranks are narrowed until few values are left:

1. Sketches give, per group, two values (marks) around each wanted rank.
2. One pass counts the rows between those marks and lists, with counts, only
   the values inside a bracket; the rest is folded into one count per slot.
3. The slot totals place each rank exactly. A rank is read off the values of
   its slot; a slot with more than ``limit`` distinct values is cut again at
   further marks until it fits.

The marks only decide how much work is left, never the result: should a rank
fall outside its bracket, the values of that slot are listed as well.

The per-group tables (hot groups, marks, ranks) are written and read back, so
Spark knows their size: it broadcasts those under its threshold and sort-merges
the others, splitting a hot group's partition. No hint overrides that.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyloom.sources.scratch import written

# Entries one group's buffer may hold. A task may have up to 128 of them open before
# Spark turns to sorting.
LIMIT = 50_000
# Buffers that hold no more than this many times the limit together are no risk,
# whatever the size of one.
TOGETHER = 20
# A sketch per task is merged in PIECES reducers per group, each of which passes on
# GRID + 1 evenly spaced quantiles; the rank error of the marks made of them is
# about 1/ACCURACY + 1/GRID.
PIECES = 64
ACCURACY = 1_000
GRID = 500
# How far the brackets reach to each side of a wanted rank.
EDGE = 2 / ACCURACY + 1 / GRID
# Parts a slot is cut into when it lists too many values.
CUTS = 64


def quantile_name(p: float) -> str:
    return f"p{p * 100:g}".replace(".", "_")


def group_key(by: Sequence[str]) -> Column:
    """The group columns as one struct: unlike its fields it is never null, so
    null groups join too."""
    return F.struct(*by).alias("_key")


def exact_quantiles(
    df: DataFrame,
    value: str,
    probs: Sequence[float],
    by: Sequence[str] = (),
    limit: int | None = None,
) -> DataFrame:
    """One row per group: ``by`` columns and one column per quantile (p25, p50, ...).

    Null values are left out; a null group is a group. Which way each group
    takes, and its marks, is found by jobs run right away.
    """
    if by:
        return quantiles_by_key(df, value, probs, by, limit).select(
            "_key.*", *[quantile_name(p) for p in probs]
        )
    limit = LIMIT if limit is None else limit
    rows = _values(df, value, F.struct(F.lit(0).alias("_all")).alias("_key"))
    n, distinct = rows.agg(F.count(F.lit(1)), F.approx_count_distinct("_v")).first()
    if fits(n, limit):
        result = _buffered(rows, probs)
    elif fits(distinct, limit):
        result = _counted(rows, probs)
    else:
        result = _narrowed(rows, probs, limit, grouped=False)
    return result.drop("_key")


def fits(entries: int, limit: int | None = None) -> bool:
    """Whether one buffer may hold so many entries."""
    return entries <= TOGETHER * (LIMIT if limit is None else limit)


def column_quantiles(
    df: DataFrame, columns: Sequence[str], probs: Sequence[float], limit: int | None = None
) -> DataFrame:
    """One row per column: ``column_name`` and one column per quantile.

    One scan finds the size and spread of all columns, one more answers all whose
    values or distinct values fit a buffer; only wide columns are narrowed each on
    its own.
    """
    limit = LIMIT if limit is None else limit
    doubles = {c: F.col(c).cast("double") for c in columns}
    probe = df.agg(
        *[F.struct(F.count(c), F.approx_count_distinct(v)) for c, v in doubles.items()]
    ).first()
    narrow, wide = [], []
    for c, (n, distinct) in zip(columns, probe, strict=True):
        (narrow if fits(n, limit) or fits(distinct, limit) else wide).append(c)
    parts = []
    if narrow:
        values = [F.struct(F.lit(c).alias("column_name"), doubles[c].alias("_v")) for c in narrow]
        rows = df.select(F.inline(F.array(*values))).where("_v IS NOT NULL")
        rows = rows.select(F.struct("column_name").alias("_key"), "_v")
        parts.append(_counted(rows, probs).select("_key.*", *[quantile_name(p) for p in probs]))
    for c in wide:
        rows = _values(df, c, F.struct(F.lit(0).alias("_all")).alias("_key"))
        found = _narrowed(rows, probs, limit, grouped=False).drop("_key")
        parts.append(found.select(F.lit(c).alias("column_name"), "*"))
    return reduce(DataFrame.unionByName, parts)


def quantiles_by_key(
    df: DataFrame, value: str, probs: Sequence[float], by: Sequence[str], limit: int | None = None
) -> DataFrame:
    """As :func:`exact_quantiles`, the group as :func:`group_key`."""
    limit = LIMIT if limit is None else limit
    rows = _values(df, value, group_key(by))

    sizes = rows.groupBy("_key").agg(F.count(F.lit(1)).alias("_n"))
    sizes = written(sizes, "quantile-sizes")
    is_large = F.col("_n") > limit
    n_all, n_large = sizes.agg(F.sum("_n"), F.sum(F.when(is_large, F.col("_n")))).first()
    if not n_large:
        return _buffered(rows, probs)
    large = sizes.where(is_large)
    parts = []
    if n_large < n_all:
        parts.append(_buffered(rows.join(large, "_key", "left_anti"), probs))
        rows = rows.join(large, "_key", "left_semi")

    spread = written(
        rows.groupBy("_key").agg(F.approx_count_distinct("_v").alias("_d")), "quantile-distinct"
    )
    is_wide = F.col("_d") > limit
    total, n_wide, n_groups = spread.agg(
        F.sum("_d"), F.count_if(is_wide), F.count(F.lit(1))
    ).first()
    if total <= TOGETHER * limit or n_wide == 0:
        parts.append(_counted(rows, probs))
    elif n_wide == n_groups:
        parts.append(_narrowed(rows, probs, limit))
    else:
        wide = spread.where(is_wide)
        parts.append(_counted(rows.join(wide, "_key", "left_anti"), probs))
        parts.append(_narrowed(rows.join(wide, "_key", "left_semi"), probs, limit))
    return reduce(DataFrame.unionByName, parts)


def _values(df: DataFrame, value: str, key: Column) -> DataFrame:
    return df.where(F.col(value).isNotNull()).select(key, F.col(value).cast("double").alias("_v"))


def _buffered(rows: DataFrame, probs: Sequence[float]) -> DataFrame:
    return _as_columns(rows.groupBy("_key").agg(_percentiles(probs)), probs)


def _counted(rows: DataFrame, probs: Sequence[float]) -> DataFrame:
    weights = _weighed(rows, ["_key"])
    return _as_columns(weights.groupBy("_key").agg(_percentiles(probs, F.col("_w"))), probs)


def _percentiles(probs: Sequence[float], weight: Column | int = 1) -> Column:
    return F.percentile("_v", [float(p) for p in probs], weight).alias("_q")


def _as_columns(quantiles: DataFrame, probs: Sequence[float]) -> DataFrame:
    return quantiles.select(
        "_key", *[F.col("_q")[i].alias(quantile_name(p)) for i, p in enumerate(probs)]
    )


def _narrowed(
    rows: DataFrame, probs: Sequence[float], limit: int, grouped: bool = True
) -> DataFrame:
    brackets = [(max(p - EDGE, 0.0), min(p + EDGE, 1.0)) for p in probs]
    grid = sorted({mark for bracket in brackets for mark in bracket})
    marks = _marks(rows, ["_key"], grid)

    marked = _with_marks(rows, marks, grouped).withColumn("_slot", _slot_of(len(grid)))
    inside = F.lit(False)
    for low, high in brackets:
        inside |= F.col("_v").between(
            F.col("_marks")[grid.index(low)], F.col("_marks")[grid.index(high)]
        )
    keys = ["_key", "_slot"]
    weights = written(
        _weighed(marked.withColumn("_v", F.when(inside, F.col("_v"))), keys), "quantile-slots"
    )

    located = _locate(_ranks(marks, probs), weights, ["_key"], "_slot")
    missed = located.where("_r >= _listed").select(*keys).distinct()
    if not missed.isEmpty():
        missed = written(missed, "quantile-missed")
        listed = _weighed(marked.join(missed, keys, "left_semi"), keys)
        weights = written(
            weights.join(missed, keys, "left_anti").unionByName(listed), "quantile-slots"
        )
        located = _locate(_ranks(marks, probs), weights, ["_key"], "_slot")

    weights, located, keys = _cut_down(weights, located, keys, limit)

    running = Window.partitionBy(*keys).orderBy("_v")
    ordered = _held(weights, located, keys).withColumn("_upto", F.sum("_w").over(running))
    picked = ordered.join(located, keys).where("_r < _upto and _r >= _upto - _w")
    return _interpolated(picked, probs)


def _marks(rows: DataFrame, keys: list[str], probs: Sequence[float]) -> DataFrame:
    """Size of each group and values near its quantiles ``probs``, written.

    One group's sketches come from every task; merged by one reducer they would
    hold up the job, so they are merged in pieces and the pieces' quantiles,
    weighted by their rows, are put together. The marks depend on how rows fall
    into partitions: written, they are the same for every task that uses them.
    """
    evenly = [i / GRID for i in range(GRID + 1)]
    pieces = (
        rows.withColumn("_piece", F.spark_partition_id() % PIECES)
        .groupBy(*keys, "_piece")
        .agg(
            F.count(F.lit(1)).alias("_n"),
            F.percentile_approx("_v", evenly, ACCURACY).alias("_grid"),
        )
    )
    points = pieces.select(*keys, "_n", F.posexplode("_grid").alias("_i", "_v"))
    return written(
        points.groupBy(*keys).agg(
            F.sum(F.when(F.col("_i") == 0, F.col("_n"))).alias("_n"),
            F.percentile("_v", list(probs), F.col("_n")).alias("_marks"),
        ),
        "quantile-marks",
    )


def _with_marks(rows: DataFrame, marks: DataFrame, grouped: bool) -> DataFrame:
    if not grouped:
        values = marks.first()["_marks"]
        return rows.withColumn("_marks", F.array(*[F.lit(v) for v in values]))
    return rows.join(marks.select("_key", "_marks"), "_key")


def _slot_of(n: int) -> Column:
    """How many marks are at or below the value. Written out, so it stays in codegen."""
    slot = F.lit(0)
    for i in range(n):
        slot += F.when(F.col("_v") >= F.col("_marks")[i], 1).otherwise(0)
    return slot


def _weighed(rows: DataFrame, keys: list[str]) -> DataFrame:
    return rows.groupBy(*keys, "_v").agg(F.count(F.lit(1)).alias("_w"))


def _ranks(marks: DataFrame, probs: Sequence[float]) -> DataFrame:
    """The two 0-based ranks each quantile lies between, and where between them."""
    wanted = []
    for i, p in enumerate(probs):
        position = F.lit(float(p)) * (F.col("_n") - 1)
        for end, rank in ((0, F.floor(position)), (1, F.ceil(position))):
            wanted.append(
                F.struct(
                    F.lit(i).alias("_q"),
                    F.lit(end).alias("_end"),
                    rank.cast("bigint").alias("_r"),
                    (position - F.floor(position)).alias("_part"),
                    (F.ceil(position) - position).alias("_rest"),
                )
            )
    return marks.select("_key", F.inline(F.array(*wanted)))


def _locate(ranks: DataFrame, weights: DataFrame, parents: list[str], slot: str) -> DataFrame:
    """Place each rank of a parent group in one of its slots.

    The window runs over slot totals, a fixed number of rows per parent.
    """
    earlier = Window.partitionBy(*parents).orderBy(slot).rowsBetween(Window.unboundedPreceding, -1)
    totals = (
        weights.groupBy(*parents, slot)
        .agg(
            F.sum("_w").alias("_total"),
            F.sum(F.when(F.col("_v").isNotNull(), F.col("_w")).otherwise(0)).alias("_listed"),
            F.count("_v").alias("_distinct"),
        )
        .withColumn("_before", F.coalesce(F.sum("_total").over(earlier), F.lit(0)))
    )
    return (
        ranks.select(*parents, "_q", "_end", "_r", "_part", "_rest")
        .join(totals, parents)
        .where("_r >= _before and _r < _before + _total")
        .withColumn("_r", F.col("_r") - F.col("_before"))
        .drop("_before", "_total")
    )


def _held(weights: DataFrame, located: DataFrame, keys: list[str]) -> DataFrame:
    """The listed values of the slots that hold a rank. What a slot does not list
    lies above all it lists, and no rank is left there."""
    listed = weights.where(F.col("_v").isNotNull())
    return listed.join(located.select(*keys).distinct(), keys, "left_semi")


def _cut_down(
    weights: DataFrame, located: DataFrame, keys: list[str], limit: int
) -> tuple[DataFrame, DataFrame, list[str]]:
    """Cut the slots that hold a rank until none lists more than ``limit`` values."""
    most = located.agg(F.max("_distinct")).first()[0]
    while most > limit:
        located = written(located, "quantile-ranks")
        held = _held(weights, located, keys)
        cuts = _marks(held, keys, [i / CUTS for i in range(1, CUTS)]).drop("_n")
        cut = f"_cut{len(keys)}"
        at_or_below = F.filter("_marks", lambda mark: mark <= F.col("_v"))
        weights = written(
            held.join(cuts, keys).withColumn(cut, F.size(at_or_below)).drop("_marks"),
            "quantile-cuts",
        )
        located = _locate(located, weights, keys, cut)
        keys = [*keys, cut]
        before, most = most, located.agg(F.max("_distinct")).first()[0]
        if most >= before:
            break
    return weights, located, keys


def _interpolated(picked: DataFrame, probs: Sequence[float]) -> DataFrame:
    def at(i: int, end: int) -> Column:
        return F.max(F.when((F.col("_q") == i) & (F.col("_end") == end), F.col("_v")))

    def share(i: int, name: str) -> Column:
        return F.max(F.when(F.col("_q") == i, F.col(name)))

    def between(i: int) -> Column:
        """What ``percentile`` gives: the value itself where there is one, so that ties
        stay exact and an infinite end is not multiplied by zero."""
        low, high, part = at(i, 0), at(i, 1), share(i, "_part")
        inner = share(i, "_rest") * low + part * high
        return F.when((part == 0) | (low == high), low).otherwise(inner)

    return picked.groupBy("_key").agg(
        *[between(i).alias(quantile_name(p)) for i, p in enumerate(probs)]
    )
