"""Features picked by name, type, place, attribute and note, as a feature store does."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from helixframe.functions.intervals import overlaps


def glob_match(c: Column, pattern: str) -> Column:
    """`*` any letters, `?` any one, case ignored; the whole value must match."""
    parts = "".join(".*" if ch == "*" else "." if ch == "?" else rf"\Q{ch}\E" for ch in pattern)
    return c.rlike(f"(?i)^{parts}$")


#: How a feature may lie to the place asked for.
PLACES = {
    "overlaps": lambda s, e, a, z: overlaps(s, e, a, z),
    "contains": lambda s, e, a, z: (s <= a) & (e >= z),
    "contained_in": lambda s, e, a, z: (s >= a) & (e <= z),
}


def find_features(features: DataFrame, name: str | None = None, types: Sequence[str] = (), place: tuple[str, int, int] | None = None, lies: str = "overlaps", attributes: Mapping[str, str] | None = None) -> DataFrame:
    """Features (transcript_id, feat_level, source, chr, start, end, attrs) that meet all conditions.

    `types` are levels or `level:source`, names and attribute values globs; case is ignored. A
    feature without the attribute, or with a null column that is asked for, isn't found.
    """
    out = features
    if name is not None:
        out = out.where(glob_match(F.col("transcript_id"), name))
    if types:
        level = F.lower("feat_level")
        out = out.where(level.isin(*[t.lower() for t in types]) | F.concat_ws(":", level, F.lower("source")).isin(*[t.lower() for t in types]))
    if place is not None:
        chrom, first, last = place
        out = out.where((F.lower("chr") == chrom.lower()) & PLACES[lies](F.col("start"), F.col("end"), F.lit(first), F.lit(last)))
    for key, pattern in (attributes or {}).items():
        out = out.where(glob_match(F.col("attrs")[key], pattern))
    return out


def search_text(df: DataFrame, text: str, words: Sequence[str]) -> DataFrame:
    """`df` with relevance: ten for each place where one of `words` stands in `text`, case ignored; rows with none are left out."""
    pattern = "(?i)" + "|".join(rf"\Q{w}\E" for w in words)
    return df.withColumn("relevance", 10 * F.regexp_count(F.col(text), F.lit(pattern))).where("relevance > 0")


def feature_types(features: DataFrame) -> DataFrame:
    """(feat_level, source, n): the kinds of features there are."""
    return features.groupBy("feat_level", "source").agg(F.count("*").alias("n"))


def attribute_names(features: DataFrame) -> DataFrame:
    """(attr_key, n): the attributes there are, and on how many features."""
    return features.select(F.explode(F.map_keys("attrs")).alias("attr_key")).groupBy("attr_key").agg(F.count("*").alias("n"))
