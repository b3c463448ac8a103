"""Per-key work when a few keys hold most rows.

Rows are numbered within their key without gathering a key anywhere: the table is cut into
blocks of about equal size along its order, each (block, key) is counted, prefix sums of the
counts give every block the offset of its first row, and the row's number is offset plus its
place in the block. Numbers cut a key into chunks of equal size, and any result that is a fold
over the ordered rows of a key is computed per chunk and merged from the chunks' boundary states.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StructField, StructType

BLOCK_ROWS = 1 << 16
CHUNK_ROWS = 1 << 16
#: At most so many blocks; of larger tables the blocks are larger.
MAX_BLOCKS = 1 << 16
#: Sort keys, a block and besides, from which the blocks' borders are taken. They divide the work
#: and don't touch the result.
SAMPLE_A_BLOCK, SAMPLE_BESIDES = 4, 2000


def block_borders(rows: DataFrame, at: Column, block_rows: int) -> list:
    """The first sort keys of all blocks but the first, ascending; a count and a bounded sample of `at`."""
    n = rows.count()
    blocks = min(MAX_BLOCKS, -(-n // block_rows))
    if blocks < 2:
        return []
    wanted = SAMPLE_A_BLOCK * blocks + SAMPLE_BESIDES
    keys = [r.at for r in rows.select(at.alias("at")).sample(min(1.0, wanted / n), 1).orderBy("at").collect()]
    cuts = [keys[i * len(keys) // blocks] for i in range(1, blocks)] if keys else []
    return [c for i, c in enumerate(cuts) if i == 0 or c != cuts[i - 1]]


def with_block(rows: DataFrame, at: Column, borders: list, name: str) -> DataFrame:
    """`rows` with `name`: how many borders are no greater than `at`, by halving."""
    out = rows.withColumn(name, F.lit(0))
    if not borders:
        return out
    whole = StructType([StructField("b", ArrayType(rows.select(at.alias("at")).schema["at"].dataType))])
    table = rows.sparkSession.createDataFrame([(borders,)], whole).select("b").scalar()
    out = out.withColumn("_at", at).withColumn("_borders", table)
    for step in (1 << i for i in reversed(range(len(borders).bit_length()))):
        there = F.col(name) + step
        passed = (there <= len(borders)) & (F.get("_borders", there - 1) <= F.col("_at"))
        out = out.withColumn(name, F.col(name) + F.when(passed, step).otherwise(0))
    return out.drop("_at", "_borders")


def number_rows(
    df: DataFrame,
    keys: Sequence[str],
    order: str,
    ties: Sequence[str] = (),
    block_rows: int = BLOCK_ROWS,
    name: str = "rank",
) -> DataFrame:
    """`df` with `name`: 1, 2, ... within `keys`, by the column `order`.

    Rows without `order` follow all others. Rows that agree in `order` follow `ties`, then a hash
    of all their columns; only rows that agree in these too are in one block for sure, and take
    any of their numbers. Blocks have about `block_rows` rows, whether `order` is dense, sparse
    or the same in all rows; their borders are found by two jobs when this is called. Null keys
    are a key of their own. `df` has no column whose type can't be hashed.
    """
    cols = df.columns
    n = len(keys)
    at = F.struct(F.col(f"row.{order}").isNull().alias("z"), F.col(f"row.{order}").alias("o"), *[F.col(f"row.{t}").alias(f"t{i}") for i, t in enumerate(ties)], F.xxhash64("row").alias("h"))
    rows = df.select(F.struct(*cols).alias("row"), *[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)])
    rows = with_block(rows, at, block_borders(rows, at, block_rows), "_b")
    ks = [f"_k{i}" for i in range(n)]
    in_block = Window.partitionBy("_b", *ks).orderBy(at)
    placed = rows.withColumn("_i", F.row_number().over(in_block).cast("long"))
    before = Window.partitionBy(*ks).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        rows.groupBy("_b", *ks)
        .agg(F.count("*").alias("_n"))
        .select(F.col("_b").alias("_ob"), *[F.col(k).alias(f"_o{k}") for k in ks], F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"))
    )
    on = placed["_b"] == offsets["_ob"]
    for k in ks:
        on = on & placed[k].eqNullSafe(offsets[f"_o{k}"])
    return placed.join(offsets, on, "left").select("row.*", (F.col("_off") + F.col("_i")).alias(name))


def ordered_key_stats(
    df: DataFrame,
    key: str,
    order: str,
    start: str,
    end: str,
    counted: str,
    chunk_rows: int = CHUNK_ROWS,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """One row per non-null `key`: counts, span, summed length and order of arrival.

    key, n_rows, span_start (least `start`), span_end (greatest `end`), n_counted and
    counted_sum (rows where the boolean `counted` holds, and their `end - start + 1` where
    both are there and in order), n_back (rows whose `start` lies before that of the last
    row, by `order`, that has one).

    Null coordinates are passed over; a key with none has null spans. An empty table gives no
    row. Other columns of `df`, whatever their names, don't matter.
    """
    rows = df.where(F.col(key).isNotNull()).select(
        F.col(key).alias("key"), F.col(order).cast("long").alias("o"), F.col(start).alias("s"), F.col(end).alias("e"), F.coalesce(F.col(counted), F.lit(False)).alias("c")
    )
    ranked = number_rows(rows, ["key"], "o", ["s", "e", "c"], block_rows)
    chunked = ranked.withColumn("chunk", F.floor((F.col("rank") - 1) / F.lit(chunk_rows)).cast("long"))
    upto = Window.partitionBy("key", "chunk").orderBy("rank").rowsBetween(Window.unboundedPreceding, -1)
    back = F.col("s") < F.last("s", ignorenulls=True).over(upto)
    length = F.when(F.col("c") & (F.col("s") <= F.col("e")), F.col("e") - F.col("s") + 1)
    seen = F.when(F.col("s").isNotNull(), F.col("rank"))
    states = (
        chunked.withColumn("back", back)
        .groupBy("key", "chunk")
        .agg(
            F.count("*").alias("n_rows"),
            F.min("s").alias("span_start"),
            F.max("e").alias("span_end"),
            F.count_if("c").alias("n_counted"),
            F.coalesce(F.sum(length), F.lit(0)).alias("counted_sum"),
            F.count_if("back").alias("n_back"),
            F.min_by("s", seen).alias("first_s"),
            F.max_by("s", seen).alias("last_s"),
        )
    )
    earlier = Window.partitionBy("key").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    return (
        states.withColumn("seam", (F.col("first_s") < F.last("last_s", ignorenulls=True).over(earlier)).cast("long"))
        .groupBy("key")
        .agg(
            F.sum("n_rows").alias("n_rows"),
            F.min("span_start").alias("span_start"),
            F.max("span_end").alias("span_end"),
            F.sum("n_counted").alias("n_counted"),
            F.sum("counted_sum").alias("counted_sum"),
            (F.sum("n_back") + F.coalesce(F.sum("seam"), F.lit(0))).alias("n_back"),
        )
    )
