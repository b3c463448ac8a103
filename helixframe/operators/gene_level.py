"""From classes of transcripts to classes of genes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: The parts of class codes, and the order of importance of classes.
TYPES = {"intergenic": "linc", "genic": "lncg"}
SUBTYPES = {"containing": "Cont", "convergent": "Conv", "divergent": "Divg", "nested": "Nest", "overlapping": "Ovlp", "same_strand": "SS"}
LOCATIONS = {"downstream": "dw", "exonic": "ex", "intronic": "in", "upstream": "up"}
DIRECTIONS = {"antisense": "AS", "sense": "SS"}
ORDER = [
    "lncgSSexNest", "lncgSSexCont", "lncgSSexOvlp", "lncgSSinNest", "lncgSSinCont", "lncgSSinOvlp",
    "lncgASexNest", "lncgASexCont", "lncgASexOvlp", "lncgASinNest", "lncgASinCont", "lncgASinOvlp",
    "lincDivg", "lincSSup", "lincSSdw", "lincConv", "unclassified",
]


def _code(c: Column, names: dict[str, str]) -> Column:
    out = F.lit("ERROR")
    for k, v in names.items():
        out = F.when(c == k, v).otherwise(out)
    return out


def class_code(rel_type: Column, direction: Column, location: Column, subtype: Column) -> Column:
    """Such as lincSSup or lncgASexNest; unknown parts are ERROR."""
    sub, loc = _code(subtype, SUBTYPES), _code(location, LOCATIONS)
    linc = F.concat(F.lit("linc"), sub, F.when(sub == "SS", loc).otherwise(""))
    return F.when(rel_type == "intergenic", linc).when(rel_type == "genic", F.concat(F.lit("lncg"), _code(direction, DIRECTIONS), loc, sub)).otherwise("ERROR")


def priority(code: Column) -> Column:
    """Place in the order of importance; both lincSS have the same, ERROR and others the last."""
    out = F.lit(len(ORDER) + 1)
    for i, name in reversed(list(enumerate(ORDER, 1))):
        out = F.when(code == name, i - (name == "lincSSdw")).otherwise(out)
    return out


#: How classes are written where their last part is left out.
SHORT = r"^(lncgSSex|lncgSSin|lncgASex|lncgASin|lincDivg|lincConv|lincSS)"


def shortened(code: Column) -> Column:
    """The class without its subtype, lincSSup and lincSSdw as lincSS; others as they are."""
    return F.coalesce(F.nullif(F.regexp_extract(code, SHORT, 1), F.lit("")), code)


def transcript_classes(annotation: DataFrame, best: DataFrame) -> DataFrame:
    """(gene_id, transcript_id, class, partner_gene, distance): each lncRNA of the annotation once.

    `annotation` has gene_id and transcript_id, `best` transcript_id, class, partner_gene and
    distance. A transcript without an interaction, or with an unknown class, has a null class
    and counts as unclassified; of several interactions the most important, nearest one holds.
    """
    rank = F.struct(priority(F.coalesce("class", F.lit("unclassified"))), F.coalesce("distance", F.lit(1 << 62)), F.coalesce("partner_gene", F.lit("~")))
    one = best.where(F.col("transcript_id").isNotNull()).groupBy("transcript_id").agg(F.min_by(F.struct("class", "partner_gene", "distance"), rank).alias("b"))
    return annotation.select("gene_id", "transcript_id").distinct().join(one, "transcript_id", "left").select("gene_id", "transcript_id", "b.class", "b.partner_gene", "b.distance")


def gene_classes(transcripts: DataFrame, compat: bool = False) -> DataFrame:
    """Per gene_id of (gene_id, transcript_id, class, partner_gene, distance): the class of the gene.

    The most important class of its transcripts, the nearest partner among equals, then the
    smallest partner and transcript; class_type says whether transcripts, classes and partner
    genes are one (1) or several (n), or unclassified if no transcript has a partner. Types
    n.n.n and n.1.n are appended to the class. With `compat` distances are compared as text, and
    a gene of type n.n.1 has the shortened class of its first transcript by id. `classes` are the distinct ones; what each
    transcript is stays in its own row, as a gene may have any number of them.
    """
    named = F.coalesce("class", F.lit("unclassified"))
    rows = transcripts.select("gene_id", "transcript_id", named.alias("class"), "partner_gene", "distance")
    near = F.coalesce(F.col("distance").cast("string"), F.lit("NA")) if compat else F.coalesce("distance", F.lit(1 << 62))
    rank = F.struct(priority(F.col("class")), near, F.coalesce("partner_gene", F.lit("~")), "transcript_id")
    genes = rows.groupBy("gene_id").agg(
        F.count("*").alias("n_transcripts"),
        F.min_by(F.struct("class", "partner_gene", "distance"), rank).alias("best"),
        F.count_distinct(F.when(F.col("class") != "unclassified", F.col("class"))).alias("n_classes"),
        F.count_distinct("partner_gene").alias("n_partners"),
        F.min_by("class", "transcript_id").alias("first_class"),
        F.array_join(F.array_sort(F.collect_set("class")), ";").alias("classes"),
    )
    one = lambda c: F.when(F.col(c) == 1, "1").otherwise("n")
    kind = F.when(F.col("n_partners") == 0, "unclassified").otherwise(F.concat_ws(".", one("n_transcripts"), one("n_classes"), one("n_partners")))
    name = F.when((F.col("class_type") == "n.n.1") & F.lit(compat), shortened(F.col("first_class"))).otherwise(F.col("best.class"))
    return genes.withColumn("class_type", kind).select(
        "gene_id",
        "n_transcripts",
        F.concat(name, F.when(F.col("class_type").isin("n.n.n", "n.1.n"), F.concat(F.lit("_"), "class_type")).otherwise("")).alias("class"),
        "class_type",
        F.col("best.partner_gene").alias("partner_gene"),
        F.col("best.distance").alias("distance"),
        "classes",
    )
