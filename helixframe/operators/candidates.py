"""First stage: which assembled transcripts stay candidates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from helixframe.functions.intervals import overlap_size
from helixframe.operators.range_join import range_join


def structure_reasons(transcripts: DataFrame, min_size: int = 200, mono_exonic: bool = True, min_exon: int = 25) -> DataFrame:
    """`transcripts` (as rolled up) with drop_reason: size, mono_exonic, bi_exonic, or null.

    Rules apply in this order. A transcript of two exons falls if one is shorter than `min_exon`.
    `mono_exonic`: whether transcripts of one exon are dropped.
    """
    reason = F.when(F.col("size") < min_size, "size")
    if mono_exonic:
        reason = reason.when(F.col("n_exons") == 1, "mono_exonic")
    return transcripts.withColumn("drop_reason", reason.when((F.col("n_exons") == 2) & (F.col("smallest_exon") < min_exon), "bi_exonic"))


def exon_overlaps(exons: DataFrame, others: DataFrame, same_strand: bool = True) -> DataFrame:
    """(transcript_id, other_id, overlap): summed overlap of all pairs of exons, where there is any.

    Pairs count each, so overlapping exons of the other side count twice. With `same_strand`
    both sides must have the same known strand.
    """
    by = ["chr", "strand"] if same_strand else ["chr"]
    known = (lambda d: d.where(F.col("strand").isin("+", "-"))) if same_strand else (lambda d: d)
    cut = lambda d: known(d).select("transcript_id", "chr", "strand", "start", "end")
    pairs = range_join(cut(exons), cut(others), by)
    size = overlap_size(F.col("l.start"), F.col("l.end"), F.col("r.start"), F.col("r.end"))
    return pairs.groupBy(F.col("l.transcript_id").alias("transcript_id"), F.col("r.transcript_id").alias("other_id")).agg(F.sum(size).alias("overlap"))


def overlap_fractions(exons: DataFrame, transcripts: DataFrame, others: DataFrame, above: float = 0.0) -> DataFrame:
    """(transcript_id, other_id, overlap, fraction) of pairs whose overlap is more than `above` of the transcript's size."""
    sized = transcripts.select("transcript_id", "size")
    return exon_overlaps(exons, others).join(sized, "transcript_id").withColumn("fraction", F.col("overlap") / F.col("size")).where(F.col("fraction") > above).drop("size")


def annotated(exons: DataFrame, transcripts: DataFrame, others: DataFrame, above: float = 0.0) -> DataFrame:
    """(transcript_id): candidates that an annotated transcript covers by more than `above`."""
    return overlap_fractions(exons, transcripts, others, above).select("transcript_id").distinct()


def unannotated(exons: DataFrame, transcripts: DataFrame, others: DataFrame, above: float = 0.0) -> DataFrame:
    """The transcripts that no annotated one covers by more than `above`."""
    return transcripts.join(annotated(exons, transcripts, others, above), "transcript_id", "left_anti")


def antisense_mono_exonic(exons: DataFrame, transcripts: DataFrame, others: DataFrame) -> DataFrame:
    """Transcripts of one exon that overlap annotated exons of the opposite strand, and none of their own."""
    mono = transcripts.where("n_exons = 1").select("transcript_id")
    own = exons.join(mono, "transcript_id", "left_semi").where(F.col("strand").isin("+", "-"))
    hits = range_join(own.select("transcript_id", "strand", "chr", "start", "end"), others.where(F.col("strand").isin("+", "-")).select("strand", "chr", "start", "end"), ["chr"])
    sides = hits.groupBy(F.col("l.transcript_id").alias("transcript_id")).agg(F.max(F.col("l.strand") == F.col("r.strand")).alias("sense"))
    return sides.where("not sense").select("transcript_id")


def intergenic_only(transcripts: DataFrame, others: DataFrame, same_strand: bool = True) -> DataFrame:
    """Transcripts whose span no annotated span overlaps, on the same known strand or on any."""
    by = ["chr", "strand"] if same_strand else ["chr"]
    known = (lambda d: d.where(F.col("strand").isin("+", "-"))) if same_strand else (lambda d: d)
    cut = lambda d: known(d).select("transcript_id", "chr", "strand", "start", "end")
    genic = range_join(cut(transcripts), cut(others), by).select(F.col("l.transcript_id").alias("transcript_id")).distinct()
    return transcripts.join(genic, "transcript_id", "left_anti")


def reciprocal_matches(exons_a: DataFrame, sizes_a: DataFrame, exons_b: DataFrame, sizes_b: DataFrame, least: float) -> DataFrame:
    """(a_id, b_id, fraction_a, fraction_b): pairs that cover each other by at least `least`."""
    pairs = exon_overlaps(exons_a, exons_b).select(F.col("transcript_id").alias("a_id"), F.col("other_id").alias("b_id"), "overlap")
    a = sizes_a.select(F.col("transcript_id").alias("a_id"), F.col("size").alias("size_a"))
    b = sizes_b.select(F.col("transcript_id").alias("b_id"), F.col("size").alias("size_b"))
    fractions = pairs.join(a, "a_id").join(b, "b_id").select("a_id", "b_id", (F.col("overlap") / F.col("size_a")).alias("fraction_a"), (F.col("overlap") / F.col("size_b")).alias("fraction_b"))
    return fractions.where((F.col("fraction_a") >= least) & (F.col("fraction_b") >= least))


def compare_sets(matches: DataFrame, transcripts_a: DataFrame, transcripts_b: DataFrame) -> DataFrame:
    """(transcript_id, origin): common (of a, with a partner), only_a or only_b."""
    a, b = transcripts_a.select("transcript_id"), transcripts_b.select("transcript_id")
    in_a, in_b = matches.select(F.col("a_id").alias("transcript_id")).distinct(), matches.select(F.col("b_id").alias("transcript_id")).distinct()
    return (
        in_a.withColumn("origin", F.lit("common"))
        .unionByName(a.join(in_a, "transcript_id", "left_anti").withColumn("origin", F.lit("only_a")))
        .unionByName(b.join(in_b, "transcript_id", "left_anti").withColumn("origin", F.lit("only_b")))
    )


def filter_candidates(exons: DataFrame, transcripts: DataFrame, annotation: DataFrame, min_size: int = 200, mono_exonic: int = 0, min_exon: int = 25, above: float = 0.0) -> DataFrame:
    """`transcripts` with drop_reason over all rules: size, mono_exonic, bi_exonic, overlap or null.

    mono_exonic 0 drops transcripts of one exon, 1 keeps them, -1 keeps those antisense to the
    annotation alone.
    """
    judged = structure_reasons(transcripts, min_size, mono_exonic == 0, min_exon)
    hit = annotated(exons, transcripts, annotation, above).withColumn("overlaps", F.lit(True))
    reason = F.coalesce("drop_reason", F.when(F.col("overlaps"), "overlap"))
    judged = judged.join(hit, "transcript_id", "left")
    if mono_exonic == -1:
        kept = antisense_mono_exonic(exons, transcripts, annotation).withColumn("antisense", F.lit(True))
        judged = judged.join(kept, "transcript_id", "left")
        reason = F.coalesce(reason, F.when((F.col("n_exons") == 1) & F.col("antisense").isNull(), "mono_exonic"))
    return judged.select(*transcripts.columns, reason.alias("drop_reason"))


def on_annotated_chr(transcripts: DataFrame, annotation: DataFrame) -> DataFrame:
    """The transcripts on a chr that the annotation has as well."""
    return transcripts.join(annotation.select("chr").distinct(), "chr", "left_semi").select(*transcripts.columns)


def filter_log(judged: DataFrame) -> DataFrame:
    """(drop_reason, n): transcripts that each rule drops, `kept` for those left."""
    return judged.groupBy(F.coalesce("drop_reason", F.lit("kept")).alias("drop_reason")).agg(F.count("*").alias("n"))
