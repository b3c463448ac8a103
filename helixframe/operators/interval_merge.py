"""Continuous blocks, and the gaps between them, of the intervals of each entity.

Two levels, so that no entity is ever one task's work: intervals are clipped to shards of the
axis and merged per (entity, shard); blocks that touch a shard's edge are stitched to their
neighbours, and gaps across edges follow from one row per (entity, shard).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from helixframe.functions.intervals import floor_div

SHARD_WIDTH = 1 << 16
MAX_PIECES = 4096
#: Shards that are stitched at once; where an entity may have more, FAN shards at a time are stitched first.
SEAM_SHARDS, FAN = 1 << 16, 1 << 12
#: So many entities with very long intervals have shards of their own width; their list is broadcast.
OWN_WIDTHS = 512


def _apart(start: str, reach: str) -> Column:
    """Whether a position at least lies between; false where nothing comes after `reach`."""
    return F.coalesce(F.col(start) > F.try_add(reach, F.lit(1)), F.lit(False))


def merge_intervals(df: DataFrame, entity: str, start: str, end: str, shard_width: int = SHARD_WIDTH, max_pieces: int = MAX_PIECES, own_widths: int = OWN_WIDTHS, seam_shards: int = SEAM_SHARDS) -> DataFrame:
    """(entity, kind, seg_start, seg_end): kind is block or gap; intervals are closed.

    Intervals that follow each other directly form one block. Rows with a null entity or
    coordinate, or with start > end, are left out; repeated, nested and equal intervals change
    nothing. Coordinates may be any long. Where an entity's longest interval would fall into more
    than `max_pieces` shards, its shards are widened; of such entities those beyond the
    `own_widths` longest widen the shards of all. Where all intervals together reach over more
    than `seam_shards` shards, shards are stitched in several steps, so that no entity's shards
    are one task's work. Both are found by a job when this is called. An empty table gives no rows.
    """
    rows = df.where(F.col(entity).isNotNull() & (F.col(start) <= F.col(end))).select(
        F.col(entity).alias("entity"), F.col(start).cast("long").alias("s"), F.col(end).cast("long").alias("e")
    )
    # Counted in shards, as end - start can be more than a long holds.
    base, max_pieces = max(2, shard_width), max(4, max_pieces)
    first, last = floor_div(F.col("s"), base), floor_div(F.col("e"), base)
    low, high, most = rows.agg(F.min(first), F.max(last), F.max(last - first)).first()
    common, longest = base, []
    if most is not None and most >= max_pieces:
        # At most own_widths + 1 rows.
        long = rows.where(last - first >= max_pieces).groupBy("entity").agg(F.max(last - first).alias("longest")).orderBy(F.desc("longest"), "entity").limit(own_widths + 1)
        longest = [r.longest for r in long.select("longest").collect()]
        common = base * (longest[own_widths] // max_pieces + 1) if len(longest) > own_widths else base
    rows = rows.withColumn("w", F.lit(common).cast("long"))
    if longest:
        own = long.select("entity", F.greatest(F.lit(common), F.expr(f"{base}L * (longest div {max_pieces}L + 1)")).alias("own"))
        rows = rows.join(F.broadcast(own), "entity", "left").select("entity", "s", "e", F.coalesce("own", "w").alias("w"))
    shards, steps = (0 if low is None else (high - low) * base // common + 1), 0
    while shards > seam_shards:
        shards, steps = shards // FAN, steps + 1
    return _merged(rows, steps)


def _merged(rows: DataFrame, steps: int) -> DataFrame:
    """Blocks and gaps of rows (entity, s, e, w), with shards of `w` positions stitched in `steps` steps besides the last."""
    by, w = ["entity", "shard", "w"], F.col("w")
    # The first and last position of a shard; null where that is beyond all longs.
    shard_low, shard_high = F.try_multiply("shard", w), F.try_subtract(F.try_multiply(F.col("shard") + 1, w), F.lit(1))
    clipped = rows.select("entity", "s", "e", "w", F.explode(F.sequence(floor_div(F.col("s"), w), floor_div(F.col("e"), w))).alias("shard")).select(
        *by, F.greatest("s", shard_low).alias("s"), F.least("e", shard_high).alias("e")
    )
    # At most one start for each position is left in a shard, however many rows it holds.
    starts = clipped.groupBy(*by, "s").agg(F.max("e").alias("e"))
    local = Window.partitionBy(*by).orderBy("s")
    reach = F.max("e").over(local.rowsBetween(Window.unboundedPreceding, -1))
    islands = (
        starts.withColumn("reach", reach)
        .withColumn("new", F.when(F.col("reach").isNull() | _apart("s", "reach"), 1).otherwise(0))
        .withColumn("island", F.sum("new").over(local))
        .groupBy(*by, "island")
        .agg(F.min("s").alias("s"), F.max("e").alias("e"))
    )
    whole = Window.partitionBy(*by)
    seg = lambda kind, a, b: F.struct(F.lit(kind).alias("kind"), a.alias("s"), b.alias("e"))
    s, e, edge = F.col("s"), F.col("e"), F.coalesce(F.col("s") == shard_low, F.lit(False)) | F.coalesce(F.col("e") == shard_high, F.lit(False))
    found = islands.withColumn("next", F.lead("s").over(local)).withColumn("far", F.max("e").over(whole)).withColumn("first", F.min("s").over(whole) == s)
    segments = found.select(
        "entity",
        "shard",
        "w",
        F.explode(
            F.array_compact(
                F.array(
                    F.when(edge, seg("edge", s, e)).otherwise(seg("block", s, e)),
                    F.when(F.col("next").isNotNull(), seg("gap", F.try_add(e, F.lit(1)), F.try_subtract("next", F.lit(1)))),
                    F.when(F.col("first"), seg("shard", s, F.col("far"))),
                )
            )
        ).alias("seg"),
    ).select("entity", "shard", "w", "seg.*")
    if steps:
        # Blocks across shards are those of the edges, gaps across them those between the shards' extents.
        open_ = segments.where(F.col("kind").isin("edge", "shard"))
        wider = F.least(w, F.lit(1 << 50)) * FAN
        above = _merged(open_.select(F.struct("entity", "kind").alias("entity"), "s", "e", wider.alias("w")), steps - 1)
        held = above.where(F.when(F.col("entity.kind") == "edge", "block").otherwise("gap") == F.col("kind"))
        return segments.where(~F.col("kind").isin("edge", "shard")).select("entity", "kind", s.alias("seg_start"), e.alias("seg_end")).unionAll(held.select("entity.entity", "kind", "seg_start", "seg_end"))
    # Finished segments keep their shard as their group; edges, and the shards' extents, meet per entity.
    across = segments.withColumn("group", F.when(F.col("kind").isin("edge", "shard"), F.lit(None)).otherwise(F.col("shard")))
    seam = Window.partitionBy("entity", "group", "kind").orderBy("s")
    joined = (
        across.withColumn("last", F.lag("e").over(seam))
        .withColumn("new", F.when(F.col("last").isNull() | _apart("s", "last"), 1).otherwise(0))
        .withColumn("chain", F.when(F.col("kind") == "edge", F.sum("new").over(seam)).otherwise(s))
        .groupBy("entity", "group", "kind", "chain")
        .agg(F.min("s").alias("s"), F.max("e").alias("e"), F.min("last").alias("last"))
    )
    apart = F.col("kind") == "shard"
    return joined.where(~apart | _apart("s", "last")).select(
        "entity",
        F.when(apart, "gap").when(F.col("kind") == "edge", "block").otherwise(F.col("kind")).alias("kind"),
        F.when(apart, F.try_add("last", F.lit(1))).otherwise(s).alias("seg_start"),
        F.when(apart, F.try_subtract("s", F.lit(1))).otherwise(e).alias("seg_end"),
    )
