"""GTF, GFF3 and BED files as typed features, and back."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from helixframe.operators.key_balance import number_rows
from helixframe.operators.row_validation import COLUMNS, attribute_pairs

#: Biotypes that may stand in column 2 and then hold for the transcript.
BIOTYPES = """3prime_overlapping_ncrna ambiguous_orf antisense IG_C_gene IG_C_pseudogene IG_D_gene IG_J_gene
IG_J_pseudogene IG_V_gene IG_V_pseudogene lincRNA miRNA misc_RNA Mt_rRNA Mt_tRNA non_coding nonsense_mediated_decay
non_stop_decay polymorphic_pseudogene processed_pseudogene processed_transcript protein_coding pseudogene
retained_intron rRNA sense_intronic sense_overlapping snoRNA snRNA TEC transcribed_processed_pseudogene
transcribed_unprocessed_pseudogene TR_C_gene TR_D_gene TR_J_gene TR_J_pseudogene TR_V_gene TR_V_pseudogene
unitary_pseudogene unprocessed_pseudogene""".split()
#: Other names of attribute keys.
KEY_NAMES = {"transcript_type": "transcript_biotype", "gene_type": "gene_biotype"}
#: Formats by the ending of a file's name.
SUFFIXES = {"fasta": "fasta", "fa": "fasta", "gff": "gff", "gff3": "gff", "gtf": "gtf", "gff2": "gtf", "bed": "bed"}


def format_of(path: str) -> str:
    return SUFFIXES.get(path.rpartition(".")[2].lower(), "gtf")


def _once(rows: DataFrame, name: str, value: Column) -> DataFrame:
    """`rows` with a column worked out once: later expressions and filters aren't folded into it."""
    return rows.withColumn(name, F.explode(F.array(value)))


def _with_attrs(rows: DataFrame, pairs: Column, cut: str) -> DataFrame:
    """`rows` with attrs: `key value` strings as a map; of repeated keys the last one holds."""
    named = F.create_map(*[F.lit(x) for kv in KEY_NAMES.items() for x in kv])
    key = lambda p: F.regexp_extract(p, rf"^([^{cut}]+)", 1)
    value = lambda p: F.regexp_replace(F.regexp_replace(p, rf"^[^{cut}]+[{cut}]+", ""), r'^"|"$', "")
    rows = _once(rows, "_pairs", F.filter(pairs, lambda p: p.rlike(rf"^[^{cut}]+[{cut}]")))
    rows = _once(rows, "_keys", F.transform("_pairs", lambda p: F.coalesce(F.try_element_at(named, key(p)), key(p))))
    rows = _once(rows, "_back", F.reverse("_keys"))
    rows = _once(rows, "_entries", F.arrays_zip(F.col("_keys").alias("key"), F.transform("_pairs", value).alias("value")))
    last = F.filter("_entries", lambda e, i: F.array_position("_back", e["key"]) == F.size("_back") - i)
    return _once(rows, "attrs", F.map_from_entries(last)).drop("_pairs", "_keys", "_back", "_entries")


#: Lines that are no features.
_SKIPPED = r"^(#|track|browser)"


def _cells(lines: DataFrame) -> DataFrame:
    """(value, c): lines that should be features, and their tab-separated cells."""
    text = lines.select(F.regexp_replace("value", r"\r+$", "").alias("value"))
    return text.where((F.trim("value") != "") & ~F.col("value").rlike(_SKIPPED)).select("value", F.split("value", "\t", -1).alias("c"))


def _number(i: int) -> Column:
    return F.get("c", F.lit(i)).try_cast("long")


def _numbers(i: int) -> Column:
    """The whole numbers of a list with commas; null where one isn't."""
    parts = F.filter(F.split(F.get("c", F.lit(i)), ","), lambda x: F.trim(x) != "")
    return F.transform(parts, lambda x: F.trim(x).try_cast("long"))


def _nine_fault() -> Column:
    """What keeps a GTF or GFF3 line from being a feature; null if nothing does."""
    return F.when(F.size("c") != len(COLUMNS), "columns").when(_number(3).isNull() | _number(4).isNull(), "coordinates")


def _bed_fault() -> Column:
    """What keeps a BED line from being a feature; null if nothing does."""
    sizes, starts = _numbers(10), _numbers(11)
    listed = (F.size(sizes) == F.size(starts)) & (F.size(sizes) > 0) & F.forall(sizes, lambda x: x.isNotNull()) & F.forall(starts, lambda x: x.isNotNull())
    return F.when(F.size("c") < 6, "columns").when(_number(1).isNull() | _number(2).isNull(), "coordinates").when((F.size("c") >= 12) & ~listed, "blocks")


def rejected_lines(lines: DataFrame, kind: str = "gtf") -> DataFrame:
    """(value, reason): the lines that `gtf_features`, `gff3_features` or `bed_features` leave out as unreadable.

    `kind` is gtf, gff or bed. Blank lines, comments and track lines are no features and not
    rejected. reason is columns (not nine; fewer than six for bed), coordinates (no
    whole numbers) or, for bed, blocks (their lists don't fit). Quoting and ids of GTF lines are
    judged by `row_validation.failed_rules`.
    """
    return _cells(lines).withColumn("reason", _bed_fault() if kind == "bed" else _nine_fault()).where(F.col("reason").isNotNull()).select("value", "reason")


def _feature_lines(lines: DataFrame) -> DataFrame:
    cells = _cells(lines).where(_nine_fault().isNull())
    return cells.select(*[F.get("c", F.lit(i)).alias(n) for i, n in enumerate(COLUMNS)]).select(
        "chr", "source", "feat_level", F.col("start_pos").try_cast("long").alias("start"), F.col("end_pos").try_cast("long").alias("end"), "score", "strand", "frame", "attributes"
    )


def gtf_features(lines: DataFrame, levels: Sequence[str] = ("exon",), attributes: Mapping[str, Sequence[str]] | None = None, columns: Mapping[str, Sequence[str]] | None = None) -> DataFrame:
    """Features of GTF lines (column value): the columns, attrs as a map, transcript_id and gene_id.

    Only `levels` are kept, and no patch or test chromosomes. A row falls if an attribute named
    in `attributes` is there with a value outside the list (rows without it stay), or a column
    named in `columns` has another value. A biotype in column 2 stands for the transcript's.
    Lines that can't be read are left out; `rejected_lines` has them.
    """
    rows = _feature_lines(lines).where(F.col("feat_level").isin(*levels) & ~F.col("chr").rlike("(PATCH|TEST)$"))
    rows = _with_attrs(rows, attribute_pairs(F.col("attributes")), r"\s").drop("attributes")
    typed = F.map_filter("attrs", lambda k, v: k != "transcript_biotype")
    rows = _once(rows, "attrs", F.when(F.col("source").isin(*BIOTYPES), F.map_concat(typed, F.create_map(F.lit("transcript_biotype"), F.col("source")))).otherwise(F.col("attrs")))
    for key, allowed in (attributes or {}).items():
        value = F.col("attrs")[key]
        rows = rows.where(value.isNull() | value.isin(*allowed))
    for name, allowed in (columns or {}).items():
        rows = rows.where(F.col(name).isin(*allowed))
    return rows.withColumn("transcript_id", F.col("attrs")["transcript_id"]).withColumn("gene_id", F.col("attrs")["gene_id"])


def read_gtf(spark: SparkSession, path: str, **options: object) -> DataFrame:
    return gtf_features(spark.read.text(path), **options)


def gff3_features(lines: DataFrame) -> DataFrame:
    """Exons of GFF3 lines with the transcript in Parent and its gene from the mRNA rows, the smallest if these differ."""
    rows = _with_attrs(_feature_lines(lines), F.transform(F.split("attributes", ";"), lambda p: F.trim(p)), "=")
    mrna = rows.where("feat_level = 'mRNA'").select(F.col("attrs")["ID"].alias("transcript_id"), F.col("attrs")["Parent"].alias("gene_id")).groupBy("transcript_id").agg(F.min("gene_id").alias("gene_id"))
    exons = rows.where("feat_level = 'exon'").withColumn("transcript_id", F.explode(F.split(F.col("attrs")["Parent"], ",")))
    return exons.join(mrna, "transcript_id", "left").withColumn("gene_id", F.coalesce("gene_id", "transcript_id")).drop("attributes")


def read_gff3(spark: SparkSession, path: str) -> DataFrame:
    return gff3_features(spark.read.text(path))


def bed_features(lines: DataFrame) -> DataFrame:
    """Exons (transcript_id, chr, strand, score, start, end), 1-based and closed, of BED lines of 6 columns or more.

    Lines of a repeated name but the first, by position and then chr, get the suffix _dup2, _dup3, ...
    From 12 columns on the last ones are blocks, else the line is one exon.
    Lines that can't be read are left out; `rejected_lines` has them.
    """
    cells = _cells(lines).where(_bed_fault().isNull())
    cell = lambda i, n: F.get("c", F.lit(i)).alias(n)
    blocks = F.when(F.size("c") >= 12, F.arrays_zip(_numbers(11).alias("off"), _numbers(10).alias("size"))).otherwise(F.array(F.struct(F.lit(0).cast("long").alias("off"), (_number(2) - _number(1)).alias("size"))))
    rows = cells.select(cell(0, "chr"), _number(1).alias("from"), _number(2).alias("to"), cell(3, "name"), cell(4, "score"), cell(5, "strand"), blocks.alias("blocks"))
    again = F.when(F.col("_nth") > 1, F.concat(F.lit("_dup"), "_nth")).otherwise("")
    rows = number_rows(rows, ["name"], "from", ["chr", "to", "strand"], name="_nth").withColumn("transcript_id", F.concat("name", again))
    exons = rows.withColumn("b", F.explode("blocks"))
    return exons.select("transcript_id", "chr", "strand", "score", (F.col("from") + F.col("b.off") + 1).alias("start"), (F.col("from") + F.col("b.off") + F.col("b.size")).alias("end"))


def read_bed(spark: SparkSession, path: str) -> DataFrame:
    return bed_features(spark.read.text(path))


def gtf_line() -> Column:
    """The GTF line of a feature with attrs; gene_id and transcript_id first, others by key.

    Null ids are left out. A value is written between double quotes as it is: one that holds
    an odd number of them can't be read again as it was.
    """
    pair = lambda k, v: F.concat(k, F.lit(' "'), v, F.lit('";'))
    ids = F.array_compact(F.array(*[pair(F.lit(k), F.col(k)) for k in ("gene_id", "transcript_id")]))
    rest = F.filter(F.array_sort(F.map_entries("attrs")), lambda e: ~e["key"].isin("gene_id", "transcript_id"))
    text = F.array_join(F.concat(ids, F.transform(rest, lambda e: pair(e["key"], e["value"]))), " ")
    return F.concat_ws("\t", *[F.coalesce(F.col(c).cast("string"), F.lit(".")) for c in ("chr", "source", "feat_level", "start", "end", "score", "strand", "frame")], text)


def gtf_text(features: DataFrame) -> DataFrame:
    return features.select(gtf_line().alias("value"))


def write_gtf(features: DataFrame, path: str) -> None:
    gtf_text(features).write.mode("error").text(path)


def write_interactions(pairs: DataFrame, path: str) -> None:
    """The classifier's table, tab separated with a header; nulls are NA."""
    named = pairs.select("is_best", "lncrna_gene", "lncrna_transcript", "partnerrna_gene", "partnerrna_transcript", "direction", "rel_type", "distance", "subtype", "rel_location")
    named.toDF("isBest", "lncRNA_gene", "lncRNA_transcript", "partnerRNA_gene", "partnerRNA_transcript", "direction", "type", "distance", "subtype", "location").write.mode("error").csv(path, sep="\t", header=True, nullValue="NA", ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)


def read_interactions(spark: SparkSession, path: str) -> DataFrame:
    schema = "is_best int, lncrna_gene string, lncrna_transcript string, partnerrna_gene string, partnerrna_transcript string, direction string, rel_type string, distance long, subtype string, rel_location string"
    return spark.read.schema(schema).csv(path, sep="\t", header=True, enforceSchema=True, nullValue="NA")


def write_routed(rows: DataFrame, path: str, line: Column | None = None) -> None:
    """One folder of lines for each class, GTF lines or what `line` makes of a row (such as
    `fasta.fasta_record()`); classes without rows have none."""
    rows.select("class", (gtf_line() if line is None else line).alias("value")).write.mode("error").partitionBy("class").text(path)
