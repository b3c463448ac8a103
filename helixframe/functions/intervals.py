"""Closed, 1-based intervals and strands as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def floor_div(c: Column, width: Column | int) -> Column:
    """`c` by a positive whole number, rounded down; exact for every long."""
    width = width if isinstance(width, Column) else F.lit(width)
    return F.call_function("div", c, width.cast("long")) - F.when((c < 0) & (c % width != 0), 1).otherwise(0)


def overlaps(b1: Column, e1: Column, b2: Column, e2: Column) -> Column:
    return (e1 >= b2) & (b1 <= e2)


def overlap_size(b1: Column, e1: Column, b2: Column, e2: Column) -> Column:
    return F.greatest(F.lit(0), F.least(e1, e2) - F.greatest(b1, b2) + 1)


def intersection(b1: Column, e1: Column, b2: Column, e2: Column) -> Column:
    """The common part as a struct; null if there is none."""
    return F.when(overlaps(b1, e1, b2, e2), F.struct(F.greatest(b1, b2).alias("start"), F.least(e1, e2).alias("end")))


def gap_distance(b1: Column, e1: Column, b2: Column, e2: Column) -> Column:
    """0 if they overlap, 1 if they follow each other directly."""
    return F.greatest(F.lit(0), b1 - e2, b2 - e1)


def strands_agree(s1: Column, s2: Column, mode: int) -> Column:
    """mode 0: any; 1: the same; -1: opposite. Unknown strands agree only with mode 0."""
    if mode == 0:
        return F.lit(True)
    known = s1.isin("+", "-") & s2.isin("+", "-")
    return F.coalesce(known & ((s1 == s2) if mode == 1 else (s1 != s2)), F.lit(False))


def common_part(b1: Column, e1: Column, b2: Column, e2: Column, s1: Column, s2: Column, mode: int = 0) -> Column:
    """The common part as a struct where the strands agree by `mode`; 0 to 0 if there is none."""
    both = overlaps(b1, e1, b2, e2) & strands_agree(s1, s2, mode)
    zero = F.lit(0).cast("long")
    return F.when(both, F.struct(F.greatest(b1, b2).cast("long").alias("start"), F.least(e1, e2).cast("long").alias("end"))).otherwise(F.struct(zero.alias("start"), zero.alias("end")))
