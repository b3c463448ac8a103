"""Third stage: what each lncRNA is to the transcripts around it."""

from __future__ import annotations

import operator
from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from helixframe.functions.intervals import gap_distance, overlaps
from helixframe.operators.range_join import range_join
from helixframe.operators.transcripts import introns
from helixframe.session import shared_checkpoint

WINDOW, MAX_WINDOW = 10_000, 100_000
#: What is written where a strand isn't known.
UNKNOWN_DIRECTION, UNKNOWN_FACING = "strand_unknow", "unknow strand(s)"
_SPAN = ["transcript_id", "gene_id", "strand", "start", "end"]


def _chr_lowered(df: DataFrame) -> DataFrame:
    return df.withColumn("chr", F.lower("chr"))


def neighbours(lnc: DataFrame, partners: DataFrame, window: int = WINDOW, max_window: int = MAX_WINDOW) -> DataFrame:
    """(l, r, gap, step): partners in the smallest multiple of `window` around a lncRNA that has any.

    One range join at the widest window replaces the search in growing ones: a partner at
    distance gap is first met at step ceil(gap / window), and only those met at the lncRNA's
    smallest step or within its window are kept.
    """
    reach = max_window // window * window
    if not reach:
        lnc = lnc.limit(0)
    cut = lambda d: _chr_lowered(d).select("chr", *_SPAN)
    pairs = range_join(cut(lnc), cut(partners), ["chr"], slack=reach)
    gap = gap_distance(F.col("l.start"), F.col("l.end"), F.col("r.start"), F.col("r.end"))
    pairs = pairs.withColumn("gap", gap).withColumn("own", F.greatest(F.lit(1), F.ceil(F.col("gap") / window)))
    nearest = F.min("own").over(Window.partitionBy("l.transcript_id"))
    return pairs.withColumn("step", nearest.cast("int")).where(F.col("gap") <= F.col("step") * window).drop("own")


def exon_relations(lnc_exons: DataFrame, partner_exons: DataFrame, partners: DataFrame) -> DataFrame:
    """(l_id, r_id, exon_overlap, rank_overlap, exonic, intronic) of pairs where a lncRNA's exon touches a partner's span.

    exon_overlap is the shared length of all exon pairs; rank_overlap, by which best partners
    are chosen, sums the earlier end less the earlier start. intronic: every exon of the
    lncRNA that touches the partner's span lies within one of its introns. Spans, exons and
    introns of the partners meet the lncRNAs' exons in one join.
    """
    cut = lambda d: _chr_lowered(d).select("chr", "transcript_id", "start", "end")
    parts = [cut(d).withColumn("part", F.lit(n)) for n, d in (("span", partners), ("exon", partner_exons), ("intron", introns(partner_exons)))]
    # Introns are dear to find, and the join reads its sides twice.
    pairs = range_join(cut(lnc_exons), shared_checkpoint(reduce(DataFrame.unionByName, parts)), ["chr"])
    part, low, high = F.col("r.part"), F.least("l.end", "r.end"), F.greatest("l.start", "r.start")
    of = lambda c: F.sum(F.when(part == "exon", c))
    inside = (part == "intron") & (F.col("l.start") >= F.col("r.start")) & (F.col("l.end") <= F.col("r.end"))
    sums = pairs.groupBy(F.col("l.transcript_id").alias("l_id"), F.col("r.transcript_id").alias("r_id")).agg(
        of(low - high + 1).alias("exon_overlap"), of(low - F.least("l.start", "r.start")).alias("rank_overlap"), F.count_if(part == "span").alias("touching"), F.count_if(inside).alias("inside")
    )
    return sums.select("l_id", "r_id", F.coalesce("exon_overlap", F.lit(0)).alias("exon_overlap"), F.coalesce("rank_overlap", F.lit(0)).alias("rank_overlap"), F.col("exon_overlap").isNotNull().alias("exonic"), (F.col("touching") == F.col("inside")).alias("intronic"))


def interactions(lnc: DataFrame, lnc_exons: DataFrame, partners: DataFrame, partner_exons: DataFrame, window: int = WINDOW, max_window: int = MAX_WINDOW) -> DataFrame:
    """Every lncRNA with every neighbour: direction, type, distance, subtype, location, overlaps and is_best.

    The best partner is a genic one with the largest rank_overlap, else the nearest; the
    smallest partner id on ties. Equal spans count as containing. A lncRNA without a partner
    has no row.
    """
    pairs = neighbours(lnc, partners, window, max_window).select(
        F.col("l.transcript_id").alias("l_id"), F.col("r.transcript_id").alias("r_id"), F.col("l.gene_id").alias("l_gene"), F.col("r.gene_id").alias("r_gene"),
        F.col("l.strand").alias("ls"), F.col("r.strand").alias("rs"), F.col("l.start").alias("lb"), F.col("l.end").alias("le"), F.col("r.start").alias("rb"), F.col("r.end").alias("re"), "gap",
    )
    pairs = pairs.join(exon_relations(lnc_exons, partner_exons, partners), ["l_id", "r_id"], "left")
    genic = overlaps(F.col("lb"), F.col("le"), F.col("rb"), F.col("re"))
    unknown = ~(F.col("ls").isin("+", "-") & F.col("rs").isin("+", "-"))
    direction = F.when(unknown, UNKNOWN_DIRECTION).when(F.col("ls") == F.col("rs"), "sense").otherwise("antisense")
    upstream = F.when(F.col("rs") == "+", ~(F.col("lb") > F.col("re"))).when(F.col("rs") == "-", F.col("lb") > F.col("re")).otherwise(False)
    status = F.when((F.col("lb") <= F.col("rb")) & (F.col("le") >= F.col("re")), "containing").when((F.col("rb") <= F.col("lb")) & (F.col("re") >= F.col("le")), "nested").otherwise("overlapping")
    faced = F.when(F.col("direction") == "sense", "same_strand").when(F.col("direction") == UNKNOWN_DIRECTION, UNKNOWN_FACING).when(upstream, "divergent").otherwise("convergent")
    place = F.when(F.col("exonic"), "exonic").when(F.coalesce("intronic", F.lit(True)), "intronic").otherwise("none")
    described = pairs.withColumn("genic", genic).withColumn("direction", direction).select(
        F.col("l_gene").alias("lncrna_gene"),
        F.col("l_id").alias("lncrna_transcript"),
        F.col("r_gene").alias("partnerrna_gene"),
        F.col("r_id").alias("partnerrna_transcript"),
        "direction",
        F.when(F.col("genic"), "genic").otherwise("intergenic").alias("rel_type"),
        F.col("gap").alias("distance"),
        F.when(F.col("genic"), status).otherwise(faced).alias("subtype"),
        F.when(F.col("genic"), place).when(upstream, "upstream").otherwise("downstream").alias("rel_location"),
        F.coalesce("exon_overlap", F.lit(0)).cast("long").alias("exon_overlap"),
        F.coalesce("rank_overlap", F.lit(0)).cast("long").alias("rank_overlap"),
    )
    ranked = Window.partitionBy("lncrna_transcript").orderBy((F.col("rel_type") == "genic").desc(), F.desc("rank_overlap"), "distance", "partnerrna_transcript")
    return described.withColumn("is_best", (F.row_number().over(ranked) == 1).cast("int"))


def best_interactions(pairs: DataFrame) -> DataFrame:
    return pairs.where("is_best = 1")


def unmatched(lnc: DataFrame, pairs: DataFrame) -> DataFrame:
    """(lncrna_transcript): lncRNAs with no partner."""
    return lnc.select(F.col("transcript_id").alias("lncrna_transcript")).join(pairs.select("lncrna_transcript"), "lncrna_transcript", "left_anti")


def classifier_summary(lnc: DataFrame, partners: DataFrame, pairs: DataFrame) -> DataFrame:
    """One row: lncRNAs, partners, interactions and lncRNAs without one. `pairs` is read once."""
    found = pairs.groupBy(F.col("lncrna_transcript").alias("transcript_id")).agg(F.count("*").alias("n"))
    n_partners = partners.agg(F.count("*")).scalar()
    return lnc.select("transcript_id").join(found, "transcript_id", "left").agg(
        F.count("*").alias("n_lncrnas"), F.max(n_partners).alias("n_partners"), F.coalesce(F.sum("n"), F.lit(0)).alias("n_interactions"), F.count_if(F.col("n").isNull()).alias("n_unmatched")
    )


#: How a distance may be compared.
COMPARISONS = {"eq": operator.eq, "lt": operator.lt, "le": operator.le, "gt": operator.gt, "ge": operator.ge}
#: On which side of an interaction an id is looked for.
SIDES = {1: ["lncrna_transcript"], 2: ["partnerrna_transcript"], 3: ["lncrna_transcript", "partnerrna_transcript"]}


def select_interactions(
    pairs: DataFrame, rel_type: str | None = None, direction: str | None = None, subtype: str | None = None, distance: tuple[int, int] | None = None,
    compared: tuple[str, int] | None = None, transcript: str | None = None, side: int = 3, nested: bool | None = None, divergent: bool | None = None, tags: Mapping[str, object] | None = None,
) -> DataFrame:
    """Interactions that meet all of the given conditions.

    distance is a closed range, compared such as ("lt", 400); transcript is looked for on `side`
    1 (lncRNA), 2 (partner) or 3 (either), as spelled there; nested and divergent ask for that
    subtype, or for none of it; tags are columns and the values they must have. A null where a
    condition asks for a value doesn't meet it.
    """
    wanted = {"rel_type": rel_type, "direction": direction, "subtype": subtype, **(tags or {})}
    for name, value in wanted.items():
        if value is not None:
            pairs = pairs.where(F.col(name) == F.lit(value))
    if distance:
        pairs = pairs.where(F.col("distance").between(*distance))
    if compared:
        pairs = pairs.where(COMPARISONS[compared[0]](F.col("distance"), F.lit(compared[1])))
    if transcript is not None:
        pairs = pairs.where(reduce(Column.__or__, [F.coalesce(F.col(c) == transcript, F.lit(False)) for c in SIDES[side]]))
    for name, asked in (("nested", nested), ("divergent", divergent)):
        if asked is not None:
            pairs = pairs.where((F.col("subtype") == name) == F.lit(asked))
    return pairs


def selected_partners(pairs: DataFrame, side: int = 2) -> DataFrame:
    """(transcript_id): the distinct transcripts on side 1 or 2 of the interactions."""
    name = SIDES[side][0]
    return pairs.where(F.col(name).isNotNull()).select(F.col(name).alias("transcript_id")).distinct()
