"""References whose record is missing, ended or not yet there.

A Bloom filter of the parents' keys, as large as their number calls for, is built by an
aggregation and joined by word number; a reference without its bits is an orphan for sure. Only
the others meet the records themselves, in a join salted for ids that many rows refer to.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from helixframe.functions.ids import names_something, spelled
from helixframe.operators.interval_merge import merge_intervals
from helixframe.operators.range_join import range_join

#: Four keys share a word of 64 bits, of which each sets four: fewer than 1 of 50 orphans passes.
KEYS_PER_WORD = 4
#: A filter of more words than this (some 50 MB) is joined in partitions instead of being broadcast.
BROADCAST_WORDS = 1 << 20
#: An id is hot if more rows refer to it than this, and than one of PARTS of all references. So
#: there are at most PARTS hot ids, cut into at most 2 * PARTS parts.
HOT_ROWS, PARTS = 20_000, 4096
#: Periods of an id that are held in one array; those of ids with more are joined by time.
FEW_PERIODS = 64


@dataclass(frozen=True)
class Parent:
    """Records valid from `since` (inclusive, null: always) to `until` (exclusive, null: still)."""

    df: DataFrame
    id: str
    since: str
    until: str


@dataclass(frozen=True)
class Referrer:
    """A table whose columns, the keys of `fields`, hold ids of the parents named there."""

    name: str
    df: DataFrame
    row_id: str
    at: str
    fields: dict[str, str] = field(default_factory=dict)


def _slot(key: Column, words: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(words)).cast("int")


def _mask(key: Column) -> Column:
    """Four of the 64 bits of a word."""
    h = F.xxhash64(key, F.lit("bits"))
    bits = [F.call_function("shiftleft", F.lit(1).cast("long"), F.shiftright(h, 6 * i).bitwiseAND(F.lit(63)).cast("int")) for i in range(4)]
    return reduce(lambda a, b: a.bitwiseOR(b), bits)


def words_for(n_keys: int) -> int:
    """A power of two of words, so that at most KEYS_PER_WORD keys share one on average."""
    return 1 << max(0, (max(1, n_keys) - 1) // KEYS_PER_WORD).bit_length()


def bloom_words(keys: DataFrame, key: str, words: int) -> DataFrame:
    """(slot, word): the filter of `key`. Never more than `words` rows, however many keys."""
    return keys.groupBy(_slot(F.col(key), words).alias("slot")).agg(F.bit_or(_mask(F.col(key))).alias("word"))


def probed(refs: DataFrame, keys: DataFrame, key: str, words: int, broadcast_words: int = BROADCAST_WORDS) -> DataFrame:
    """`refs` with maybe: false if `key` is surely none of `keys`.

    Up to `broadcast_words` words the filter is broadcast; beyond it both sides are partitioned
    by word number, and AQE splits partitions that hold too many references.
    """
    words_of = bloom_words(keys, key, words)
    mask = _mask(F.col(key))
    joined = refs.withColumn("slot", _slot(F.col(key), words)).join(F.broadcast(words_of) if words <= broadcast_words else words_of.hint("shuffle_hash"), "slot", "left")
    return joined.withColumn("maybe", F.coalesce(F.col("word").bitwiseAND(mask) == mask, F.lit(False))).drop("slot", "word")


def _micros(at: Column) -> Column:
    """Microseconds since 1970 as the clock shows them, whatever the session's zone."""
    seconds = F.hour(at) * 3600 + F.minute(at) * 60
    return F.date_diff(at.cast("date"), F.lit("1970-01-01").cast("date")).cast("long") * 86_400_000_000 + seconds.cast("long") * 1_000_000 + (F.extract(F.lit("SECOND"), at) * 1_000_000).cast("long")


def _out_of_time(refs: DataFrame, periods: DataFrame) -> DataFrame:
    """The `refs` (with key, ref_at) that none of the `periods` (key, since, until) of their key holds, however many there are."""
    ends = (F.coalesce(_micros(F.col("since")), F.lit(-(1 << 62))), F.coalesce(_micros(F.col("until")) - 1, F.lit(1 << 62)))
    merged = merge_intervals(periods.select("key", ends[0].alias("s"), ends[1].alias("e")), "key", "s", "e").where("kind = 'block'")
    at = _micros(F.col("ref_at"))
    held = range_join(refs.select("key", "ref_at").distinct().select("key", "ref_at", at.alias("start"), at.alias("end")), merged.select(F.col("entity").alias("key"), F.col("seg_start").alias("start"), F.col("seg_end").alias("end")), ["key"])
    return refs.where(F.col("ref_at").isNotNull()).join(held.select("l.key", "l.ref_at"), ["key", "ref_at"], "left_anti")


def orphan_references(referrers: list[Referrer], parents: dict[str, Parent], hot_rows: int = HOT_ROWS, broadcast_words: int = BROADCAST_WORDS, few_periods: int = FEW_PERIODS) -> DataFrame:
    """(tbl, row_id, ref_field, ref_at, kind): each reference without a record valid at its time.

    kind is missing (no record has that id), deleted (some record had ended by then) or late.
    Ids are compared trimmed and in upper case; null, empty and `.` ids are no references. A
    reference without a time is an orphan only if the record is missing. Repeated records
    change nothing; repeated rows are reported each. No parents at all: every reference is missing.

    A job over the parents counts ids and periods when this is called. Ids with more than
    `few_periods` different periods have them merged and joined by id and time, so none is
    ever gathered.
    """
    refs = reduce(
        DataFrame.unionAll,
        [
            r.df.select(
                F.lit(r.name).alias("tbl"),
                F.col(r.row_id).cast("long").alias("row_id"),
                F.col(r.at).cast("timestamp_ntz").alias("ref_at"),
                F.explode(F.array(*[F.struct(F.lit(f).alias("ref_field"), F.lit(p).alias("parent"), spelled(F.col(f)).alias("id")) for f, p in r.fields.items()])).alias("ref"),
            ).select("tbl", "row_id", "ref_at", "ref.*")
            for r in referrers
        ],
    ).where(names_something(F.col("id")))
    refs = refs.withColumn("key", F.concat_ws("\t", "parent", "id")).drop("parent", "id")
    records = reduce(
        DataFrame.unionAll,
        [p.df.select(F.concat_ws("\t", F.lit(n), spelled(F.col(p.id))).alias("key"), F.col(p.since).cast("timestamp_ntz").alias("since"), F.col(p.until).cast("timestamp_ntz").alias("until")) for n, p in parents.items()],
    ).distinct()
    per_id = records.groupBy("key").agg(F.count("*").alias("n"), F.min("until").alias("first_end"))
    n_ids, most = per_id.agg(F.count("*"), F.max("n")).first()
    tested = probed(refs, records, "key", words_for(n_ids), broadcast_words)
    sure = tested.where(~F.col("maybe")).withColumn("kind", F.lit("missing"))

    doubtful = tested.where("maybe")
    uses = doubtful.groupBy("key").agg(F.count("*").alias("n"))
    unit = F.greatest(F.lit(hot_rows), F.ceil(uses.agg(F.sum("n")).scalar() / PARTS))
    hot = uses.where(F.col("n") > unit).select("key", F.ceil(F.col("n") / unit).cast("int").alias("parts"))
    salted = doubtful.join(F.broadcast(hot), "key", "left").withColumn("salt", F.when(F.col("parts").isNotNull(), F.pmod(F.xxhash64("row_id"), F.col("parts"))).otherwise(F.lit(0)).cast("int"))
    known, busy = per_id.select("key", "first_end", F.lit(False).alias("many")), None
    held = records
    if most and most > few_periods:
        known = per_id.select("key", "first_end", (F.col("n") > few_periods).alias("many"))
        busy = records.join(known.where("many").select("key"), "key", "left_semi")
        held = records.join(known.where("many").select("key"), "key", "left_anti")
    arrays = held.groupBy("key").agg(F.collect_list(F.struct("since", "until")).alias("periods"), F.min("until").alias("first_end"), F.lit(False).alias("many"))
    if busy is not None:
        arrays = arrays.unionByName(known.where("many").select("key", F.lit(None).cast(arrays.schema["periods"].dataType).alias("periods"), "first_end", "many"))
    periods = arrays.join(F.broadcast(hot), "key", "left").select("key", "periods", "first_end", "many", F.explode(F.sequence(F.lit(0), F.coalesce(F.col("parts"), F.lit(1)) - 1)).alias("salt"))
    at = F.col("ref_at")
    holds = F.exists("periods", lambda p: (p["since"].isNull() | (p["since"] <= at)) & (p["until"].isNull() | (at < p["until"])))
    kind = F.when(F.coalesce(F.col("first_end") <= at, F.lit(False)), "deleted").otherwise("late")
    met = salted.join(periods, ["key", "salt"], "left")
    verdict = F.when(F.col("many").isNull(), "missing").when(F.col("many") | at.isNull() | F.coalesce(holds, F.lit(False)), None).otherwise(kind)
    cols = ["tbl", "row_id", "ref_field", "ref_at", "kind"]
    found = sure.select(cols).unionAll(met.withColumn("kind", verdict).where(F.col("kind").isNotNull()).select(cols))
    if busy is None:
        return found
    return found.unionAll(_out_of_time(met.where("many"), busy).withColumn("kind", kind).select(cols))


def orphan_report(orphans: DataFrame) -> DataFrame:
    """(tbl, month, ref_field, kind, n): orphans counted per table and month (null: undated)."""
    return orphans.groupBy("tbl", F.date_format("ref_at", "yyyy-MM").alias("month"), "ref_field", "kind").agg(F.count("*").alias("n"))
