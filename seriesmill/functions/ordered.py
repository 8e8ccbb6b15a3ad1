"""Exact order statistics that never bring a whole group to one task.

A built-in ``percentile`` keeps every distinct value of a group in one buffer and
``row_number`` over a model sorts all its rows in one task. Both grow with the
data when the group is "everything". The two operators here give the same answers
from grouped counts and bounded windows.
"""

from __future__ import annotations

from collections.abc import Sequence
from math import isqrt

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Significant bits of a cell and of the finer cells inside a needed one: a cell holds
# at most some 2^19 of the next finer ones, or of single values, however close they lie.
_CELL_BITS, _FINE_BITS = 16, 34


def _cell(value: Column, bits: int = _CELL_BITS) -> Column:
    """A double rounded to so many significant bits, never reversing an order.

    Splitting by a factor of ``2^s + 1`` rounds to the nearest shorter number, so
    it is a plain arithmetic expression and needs no look at the exponent.
    """
    scaled = value * F.lit(float(2 ** (53 - bits) + 1))
    return scaled - (scaled - value)


def _rows_before(lane: WindowSpec) -> Column:
    ahead = lane.rowsBetween(Window.unboundedPreceding, -1)
    return F.coalesce(F.sum("_c").over(ahead), F.lit(0))


def exact_quantiles(
    df: DataFrame,
    keys: Sequence[str],
    value: str,
    probs: Sequence[float],
    weight: str | None = None,
    groups: DataFrame | None = None,
) -> DataFrame:
    """Linearly interpolated quantiles per key, one column ``q0, q1, ...`` each.

    Values are first counted (``groupBy`` with map-side combine, so a value that
    makes up a third of the rows is one row afterwards). The counts add up to
    cells of nearby values, of which a key has some ten thousand per doubling of
    the value range, however many rows there are. Cumulated cells tell which few
    hold a wanted rank; these are counted by finer cells in the same way, and only the
    values of one finer cell per wanted rank are sorted. ``keys`` may be empty.
    Nulls are ignored. ``weight`` names a column saying how often a row counts.

    ``groups`` holds ``keys`` and other columns, and asks for the quantiles per value of
    those instead: rows belong to every group their keys are listed with. Rows are still
    counted once; what is listed several times are cells. It is broadcast, so it must be small.
    """
    keys = inner = list(keys)
    if groups is not None:
        inner, keys = keys, [c for c in groups.columns if c not in keys]
    # Never-null columns: a null check on one use of the counts would keep Spark
    # from computing them once for both uses.
    counts = (
        df.where(F.col(value).isNotNull())
        .select(
            *inner,
            F.coalesce(F.col(value).cast("double") + F.lit(0.0), F.lit(0.0)).alias("_v"),
            (F.col(weight) if weight else F.lit(1)).cast("long").alias("_c"),
        )
        .groupBy(*inner, "_v")
        .agg(F.coalesce(F.sum("_c"), F.lit(0)).alias("_c"))
        .withColumn("_cell", F.coalesce(_cell(F.col("_v")), F.lit(0.0)))
    )
    whole = Window.partitionBy(*[F.col(k) for k in keys])
    cells = counts.groupBy(*inner, "_cell").agg(F.sum("_c").alias("_c"))
    if groups is not None:
        cells = cells.join(F.broadcast(groups), inner).groupBy(*keys, "_cell").agg(F.sum("_c").alias("_c"))
    cells = (
        cells.withColumn("_before", _rows_before(whole.orderBy("_cell")))
        .withColumn("_n", F.sum("_c").over(whole))
    )
    # Per quantile, the two ranks it lies between.
    spots = [(i, F.floor, p) for i, p in enumerate(probs)] + [(i, F.ceil, p) for i, p in enumerate(probs)]
    ranks = F.array(
        *[
            F.struct(
                F.lit(i).alias("i"),
                F.lit(side is F.ceil).alias("upper"),
                side((F.col("_n") - 1) * F.lit(float(p))).alias("rank"),
            )
            for i, side, p in spots
        ]
    )
    needed = (
        cells.withColumn("_w", F.explode(ranks))
        .where((F.col("_before") <= F.col("_w.rank")) & (F.col("_w.rank") < F.col("_before") + F.col("_c")))
        .select(*keys, "_cell", "_n", F.col("_before").alias("_skip"), "_w.*")
    )
    if groups is not None:
        needed = needed.join(F.broadcast(groups), keys)
    picked = counts.join(needed, inner + ["_cell"]).withColumn("_fine", F.coalesce(_cell(F.col("_v"), _FINE_BITS), F.lit(0.0)))
    rank_of = Window.partitionBy(*keys, "i", "upper")
    fine = (
        picked.groupBy(*keys, "i", "upper", "_fine")
        .agg(F.sum("_c").alias("_c"), F.max("rank").alias("rank"), F.max("_skip").alias("_skip"))
        .withColumn("_before", F.col("_skip") + _rows_before(rank_of.orderBy("_fine")))
        .where((F.col("_before") <= F.col("rank")) & (F.col("rank") < F.col("_before") + F.col("_c")))
        .select(*keys, "i", "upper", "_fine", F.col("_before").alias("_skip"))
    )
    found = (
        picked.drop("_skip").join(fine, keys + ["i", "upper", "_fine"])
        .withColumn("_before", F.col("_skip") + _rows_before(rank_of.orderBy("_v")))
        .where((F.col("_before") <= F.col("rank")) & (F.col("rank") < F.col("_before") + F.col("_c")))
    )
    outs = []
    for i, p in enumerate(probs):
        low = F.max(F.when((F.col("i") == i) & ~F.col("upper"), F.col("_v")))
        high = F.max(F.when((F.col("i") == i) & F.col("upper"), F.col("_v")))
        place = (F.max("_n") - 1) * F.lit(float(p))
        outs.append((low + (high - low) * (place - F.floor(place))).alias(f"q{i}"))
    return found.groupBy(*keys).agg(*outs)


def _ranked(df: DataFrame, name: str, descending: bool) -> list[Column]:
    """Columns that never are null or NaN and ascend in the order asked for."""
    kind, value = df.schema[name].dataType, F.col(name)
    if descending and not isinstance(kind, T.NumericType):
        raise TypeError(f"{name} is {kind.simpleString()}; only numbers can be ranked downwards")
    present = value.isNotNull()
    first = (~present if descending else present).cast("int").alias(f"_p_{name}")
    if isinstance(kind, (T.FloatType, T.DoubleType)):
        odd = F.coalesce(F.isnan(value), F.lit(False))
        plain = F.coalesce(F.nanvl(value, F.lit(0.0).cast(kind)), F.lit(0.0).cast(kind))
        middle = (~odd if descending else odd).cast("int").alias(f"_n_{name}")
        return [first, middle, (-plain if descending else plain).alias(f"_o_{name}")]
    if descending and isinstance(kind, T.IntegralType):
        value = F.bitwise_not(value)  # as -value, without overflow at the smallest number
    elif descending:
        value = -value
    filler = F.lit(0) if isinstance(kind, T.NumericType) else F.lit("") if isinstance(kind, T.StringType) else None
    return [first, (value if filler is None else F.coalesce(value, filler.cast(kind))).alias(f"_o_{name}")]


def ordered_position(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[tuple[str, bool]],
    out: str,
    slices: int | None = None,
) -> DataFrame:
    """``row_number`` per key over groups of any size.

    ``order`` lists ``(column, descending)``; together with ``keys`` it must identify
    a row. Nulls and NaN rank as in ``row_number``: null lowest, NaN highest. Only
    numbers may be descending; other types raise ``TypeError``. A hash-ordered sample of fixed size gives cut
    points, rows are numbered inside the slice between two cuts, and the slice
    totals in front are added. Ties may be any share of the data: the cuts use the
    full order, so they run through tied values too. There are as many slices as
    shuffle partitions (at least 64), so a slice stays the size of a partition.
    """
    keys = list(keys)
    if slices is None:
        slices = max(64, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    parts = [F.col(k) for k in keys]
    for name, descending in order:
        parts += _ranked(df, name, descending)
    place = F.struct(*parts)
    hashed = F.xxhash64(*[F.col(n) for n in keys + [o for o, _ in order]])
    sample = df.select(place.alias("_p"), hashed.alias("_h")).orderBy("_h", "_p").limit(slices * 32)
    # One array of slices - 1 entries, whatever the data size.
    cuts = sample.agg(F.sort_array(F.collect_list("_p")).alias("_all")).select(
        F.transform(
            F.sequence(F.lit(1), F.lit(slices - 1)),
            lambda i: F.get("_all", F.floor(i * F.size("_all") / slices).cast("int")),
        ).alias("_cuts")
    )
    # Two short lookups instead of one long: every stride-th cut, then those after it.
    stride = isqrt(slices)
    marks = F.sequence(F.lit(stride - 1), F.lit(slices + stride - 1), F.lit(stride))
    both = cuts.select(F.struct("_cuts", F.transform(marks, lambda i: F.get("_cuts", i)).alias("marks")))
    below = lambda cut: cut <= F.col("_p")
    sliced = (
        df.withColumn("_at", both.scalar())
        .withColumn("_p", place)
        .withColumn("_whole", F.size(F.filter("_at.marks", below)) * stride)
        .withColumn("_slice", F.col("_whole") + F.size(F.filter(F.slice("_at._cuts", F.col("_whole") + 1, stride), below)))
        .drop("_at", "_p", "_whole")
    )
    totals = sliced.groupBy(*keys, "_slice").agg(F.count(F.lit(1)).alias("_rows"))
    ahead = Window.partitionBy(*keys).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(*keys, "_slice", F.coalesce(F.sum("_rows").over(ahead), F.lit(0)).alias("_ahead"))
    inside = Window.partitionBy(*keys, "_slice").orderBy(*[c for n, d in order for c in _ranked(df, n, d)])
    numbered = sliced.withColumn("_row", F.row_number().over(inside))
    return (
        numbered.join(offsets, keys + ["_slice"])
        .withColumn(out, (F.col("_ahead") + F.col("_row")).cast("long"))
        .drop("_ahead", "_row", "_slice")
    )
