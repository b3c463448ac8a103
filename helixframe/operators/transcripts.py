"""Transcripts and genes as rollups and windows of features, and selections of them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from helixframe.functions.ids import names_something, spelled
from helixframe.operators.interval_merge import merge_intervals
from helixframe.operators.key_balance import number_rows


def usable_exons(gtf: DataFrame, level: str = "exon") -> DataFrame:
    """(transcript_id, gene_id, chr, strand, biotype, start, end), each exon of a transcript once.

    `gtf` has the columns of the gtf table. Ids are trimmed and in upper case; features without
    a transcript, or with absent or reversed coordinates, are left out. A transcript has the
    gene, chr, strand and biotype of its latest row by row_id, wherever its features lie. Both
    are found by aggregation before they meet, so that a transcript with very many rows is
    never gathered.
    """
    tx = spelled(F.col("transcript_id"))
    kept = F.regexp_extract("attributes", r'transcript_(?:biotype|type) "?([^";]+)', 1)
    rows = gtf.where((F.col("feat_level") == level) & names_something(tx) & (F.col("start_pos") <= F.col("end_pos"))).select(
        tx.alias("transcript_id"),
        F.coalesce(spelled(F.col("gene_id")), F.lit("")).alias("gene_id"),
        F.coalesce(spelled(F.col("chr")), F.lit("")).alias("chr"),
        F.coalesce("strand", F.lit(".")).alias("strand"),
        kept.alias("biotype"),
        F.col("start_pos").alias("start"),
        F.col("end_pos").alias("end"),
        "row_id",
    )
    fields = F.struct("gene_id", "chr", "strand", "biotype")
    latest = rows.groupBy("transcript_id").agg(F.max_by(fields, "row_id").alias("t"))
    return rows.select("transcript_id", "start", "end").distinct().join(latest, "transcript_id").select("transcript_id", "t.*", "start", "end")


def transcript_rollup(exons: DataFrame) -> DataFrame:
    """One row per transcript: span, exon count, summed exon size and smallest exon."""
    size = F.col("end") - F.col("start") + 1
    return exons.groupBy("transcript_id", "gene_id", "chr", "strand", "biotype").agg(
        F.min("start").alias("start"), F.max("end").alias("end"), F.count("*").alias("n_exons"), F.sum(size).alias("size"), F.min(size).alias("smallest_exon")
    )


def with_transcript_rows(features: DataFrame) -> DataFrame:
    """`features` and, for each transcript, a row of feat_level transcript over their span.

    Of the other columns the row has transcript_id, gene_id, chr and strand; the rest is null.
    """
    keys = ["transcript_id", "gene_id", "chr", "strand"]
    spans = features.groupBy(*keys).agg(F.min("start").alias("start"), F.max("end").alias("end")).withColumn("feat_level", F.lit("transcript"))
    return features.unionByName(spans, allowMissingColumns=True)


def gene_rollup(transcripts: DataFrame) -> DataFrame:
    """One row per gene and chr: span and number of transcripts."""
    return transcripts.where("gene_id <> ''").groupBy("gene_id", "chr").agg(F.min("start").alias("start"), F.max("end").alias("end"), F.count("*").alias("n_transcripts"))


def exon_ranks(exons: DataFrame) -> DataFrame:
    """`exons` with their number in the direction of transcription, counted by blocks of positions."""
    cols = exons.columns
    minus = F.coalesce(F.col("strand") == "-", F.lit(False))
    turned = exons.withColumn("_first", F.when(minus, -F.col("end")).otherwise(F.col("start"))).withColumn("_then", F.when(minus, -F.col("start")).otherwise(F.col("end")))
    return number_rows(turned, ["transcript_id"], "_first", ["_then"], name="exon_number").select(*cols, F.col("exon_number").cast("int").alias("exon_number"))


def _merged(exons: DataFrame, kind: str) -> DataFrame:
    whose = F.struct("transcript_id", "chr", "strand")
    parts = merge_intervals(exons.select(whose.alias("whose"), "start", "end"), "whose", "start", "end").where(F.col("kind") == kind)
    return parts.select("entity.transcript_id", "entity.chr", "entity.strand", F.col("seg_start").alias("start"), F.col("seg_end").alias("end"))


def introns(exons: DataFrame) -> DataFrame:
    """The stretches between exons of a transcript that no exon covers."""
    return _merged(exons, "gap").withColumn("size", F.col("end") - F.col("start") + 1)


def merge_small_introns(exons: DataFrame, least: int = 5) -> DataFrame:
    """Exons with those joined between which fewer than `least` (1 or more) positions lie."""
    more = max(1, least) - 1
    return _merged(exons.withColumn("end", F.col("end") + more), "block").withColumn("end", F.col("end") - more)


def promoters(transcripts: DataFrame, width: int = 500) -> DataFrame:
    """`width` positions upstream of each transcript, its first position included."""
    minus = F.col("strand") == "-"
    return transcripts.select("transcript_id", "chr", "strand", F.when(minus, F.col("end")).otherwise(F.greatest(F.lit(1), F.col("start") - width)).alias("start"), F.when(minus, F.col("end") + width).otherwise(F.col("start")).alias("end"))


def longest_per_gene(transcripts: DataFrame) -> DataFrame:
    """The transcript of each gene with the largest summed exon size; the smallest id on ties."""
    best = F.min_by(F.struct("transcript_id", "size"), F.struct(-F.col("size"), "transcript_id"))
    return transcripts.where("gene_id <> ''").groupBy("gene_id").agg(best.alias("b")).select("gene_id", "b.*")


def random_per_gene(transcripts: DataFrame, seed: int = 1) -> DataFrame:
    """One transcript of each gene, chosen by a hash of id and seed alone."""
    dice = F.md5(F.concat_ws("|", "transcript_id", F.lit(str(seed))))
    return transcripts.where("gene_id <> ''").groupBy("gene_id").agg(F.min_by("transcript_id", F.struct(dice, "transcript_id")).alias("transcript_id"))


def size_between(transcripts: DataFrame, least: int = 200, most: int = 100_000) -> DataFrame:
    return transcripts.where(F.col("size").between(least, most))


def exons_between(transcripts: DataFrame, least: int = 1, most: int = 1) -> DataFrame:
    return transcripts.where(F.col("n_exons").between(least, most))


def _structure(features: DataFrame) -> DataFrame:
    """A transcript's parts as count, span and two 64-bit sums, whatever their number and order."""
    part = lambda salt: F.bit_xor(F.xxhash64("start", "end", F.lit(salt)))
    marks = [F.count("*"), F.min("start"), F.max("end"), part("a"), part("b")]
    return features.select("transcript_id", "chr", "strand", "start", "end").distinct().groupBy("transcript_id", "chr", "strand").agg(F.struct(*[m.alias(f"m{i}") for i, m in enumerate(marks)]).alias("parts"))


def same_structure(features: DataFrame) -> DataFrame:
    """(transcript_id, kept_id) of transcripts whose exons (or introns) another one has as well:
    of those with equal chr, strand and parts the one with the smallest id is kept.

    Parts are compared by number, span and 128 bits of hashes, so that neither a transcript
    with very many parts nor a large group of equal ones is gathered. Equal parts of one
    transcript count once.
    """
    marked = _structure(features)
    alike = ["chr", "strand", "parts"]
    kept = marked.groupBy(*alike).agg(F.min("transcript_id").alias("kept_id"))
    return marked.join(kept, alike).where("transcript_id <> kept_id").select("transcript_id", "kept_id")


def sample_transcripts(transcripts: DataFrame, n: int, seed: int = 1) -> DataFrame:
    """`n` transcripts in an order that depends on id and seed alone."""
    return transcripts.orderBy(F.md5(F.concat_ws("|", "transcript_id", F.lit(str(seed)))), "transcript_id").limit(n)
