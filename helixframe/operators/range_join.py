"""Joins of intervals as equi-joins of bins, which distribute and adapt like any other join."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from helixframe.functions.intervals import floor_div

BIN_WIDTH = 1 << 14
#: An interval over more bins than this has bins of a higher level, each level STEP times as wide.
MAX_BINS, STEP = 64, 8


def _widths(bin_width: int) -> list[int]:
    return [w for i in range(22) if (w := bin_width * STEP**i) < 1 << 62]


def _level(low: Column, high: Column, widths: Sequence[int]) -> Column:
    """The number of the first width of which the interval touches about MAX_BINS bins at most.

    Rounding may move an interval to the next level; that changes no pair.
    """
    length = high.cast("double") - low.cast("double")
    steps = F.ceil(F.log2(F.greatest(F.lit(1.0), length / float(MAX_BINS * widths[0]))) / math.log2(STEP))
    return F.least(steps, F.lit(len(widths) - 1)).cast("int")


def range_join(left: DataFrame, right: DataFrame, by: Sequence[str], slack: int = 0, bin_width: int = BIN_WIDTH) -> DataFrame:
    """Pairs of rows with equal `by` whose [start, end] overlap, the left one widened by `slack`.

    Both sides have columns start and end. The result has the `by` columns and structs l and r
    of the two rows. Each interval has a level by its length, and two meet in the bins of the
    higher of their levels, so that a very long one is no more rows than a short one. A pair
    meets in every bin that both touch and is kept in the first of them, so nothing has to be
    made distinct. Which levels there are is found by a job over both sides when this is called;
    mostly it's one. Rows with null keys or coordinates, or start > end, meet nothing; repeated
    rows pair each. AQE splits bins that hold too much. Coordinates with `slack` must be longs.
    """
    widths = _widths(bin_width)

    def side(df: DataFrame, name: str, more: int) -> DataFrame:
        low, high = (F.col("start") - more).cast("long"), (F.col("end") + more).cast("long")
        rows = df.where(F.col("start") <= F.col("end")).select(F.struct(*df.columns).alias(name), *[F.col(k).alias(f"{name}_{k}") for k in by], low.alias(f"{name}_lo"), high.alias(f"{name}_hi"))
        return rows.withColumn(f"{name}_lv", _level(F.col(f"{name}_lo"), F.col(f"{name}_hi"), widths))

    a, b = side(left, "l", slack), side(right, "r", 0)
    # At most as many rows as there are widths.
    levels = sorted(r[0] for r in a.select("l_lv").union(b.select("r_lv")).distinct().collect())

    def binned(df: DataFrame, name: str) -> DataFrame:
        def of(level: int) -> Column:
            numbers = F.sequence(*[floor_div(F.col(f"{name}_{x}"), widths[level]) for x in ("lo", "hi")])
            return F.when(F.col(f"{name}_lv") <= level, F.transform(numbers, lambda x: F.struct(F.lit(level).alias("lv"), x.alias("bin")))).otherwise(F.array())

        bins = [of(level) for level in levels]
        at = F.concat(*bins) if len(bins) > 1 else bins[0]
        return df.withColumn(f"{name}_at", F.explode(at))

    if not levels:
        return a.join(b, F.lit(False)).select(*[F.col(f"l_{k}").alias(k) for k in by], "l", "r")
    a, b = binned(a, "l"), binned(b, "r")
    on = a["l_at"] == b["r_at"]
    for k in by:
        on = on & (a[f"l_{k}"] == b[f"r_{k}"])
    start = F.greatest("l_lo", "r_lo")
    first = F.lit(None).cast("long")
    for lv in levels:
        first = F.when(F.col("l_at.lv") == lv, floor_div(start, widths[lv])).otherwise(first)
    meet = (F.col("l_lo") <= F.col("r_hi")) & (F.col("r_lo") <= F.col("l_hi")) & (F.col("l_at.bin") == first)
    higher = F.col("l_at.lv") == F.greatest("l_lv", "r_lv")
    return a.join(b, on).where(meet & higher).select(*[F.col(f"l_{k}").alias(k) for k in by], "l", "r")
