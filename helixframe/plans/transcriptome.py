"""Named queries over transcripts: rollups, filter, classifier and gene level, each with its SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from helixframe.functions.ids import names_something, spelled
from helixframe.functions.intervals import common_part, intersection
from helixframe.operators import candidates as cand
from helixframe.operators import classify, gene_level
from helixframe.operators import feature_search as search
from helixframe.operators import transcripts as tx
from helixframe.operators.range_join import range_join
from helixframe.session import scratch_path, shared_checkpoint
from helixframe.sources.annotation import BIOTYPES, bed_features, gff3_features, gtf_features, gtf_text, read_interactions, rejected_lines, write_interactions, write_routed

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def _query(sql: str | None = None) -> Callable:
    def add(f: Callable) -> Callable:
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


def _gtf(spark: SparkSession, d: str) -> DataFrame:
    return spark.read.parquet(f"{d}/gtf.parquet")


def _exons(spark: SparkSession, d: str) -> DataFrame:
    return tx.usable_exons(_gtf(spark, d))


def _tx(spark: SparkSession, d: str) -> DataFrame:
    return tx.transcript_rollup(_exons(spark, d))


def _both(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    """(exons, transcripts) for queries that use them several times: gtf is read for them once."""
    exons = shared_checkpoint(_exons(spark, d))
    return exons, shared_checkpoint(tx.transcript_rollup(exons))


def _coding(df: DataFrame) -> DataFrame:
    return df.where("biotype = 'protein_coding'")


def _lnc(df: DataFrame) -> DataFrame:
    return df.where("biotype <> 'protein_coding'")


EXONS = """
raw as (select upper(trim(transcript_id)) transcript_id, start_pos s, end_pos e, row_id,
    {'g': coalesce(upper(trim(gene_id)), ''), 'c': coalesce(upper(trim(chr)), ''), 'd': coalesce(strand, '.'), 'b': regexp_extract(attributes, 'transcript_(?:biotype|type) "?([^";]+)', 1)} t
  from gtf where feat_level = 'exon' and start_pos <= end_pos and upper(trim(transcript_id)) not in ('', '.')),
latest as (select transcript_id, arg_max(t, row_id) t from raw group by 1),
exons as (select distinct transcript_id, t.g gene_id, t.c chr, t.d strand, t.b biotype, s, e from (select transcript_id, s, e from raw) join latest using (transcript_id)),
tx as (select transcript_id, gene_id, chr, strand, biotype, min(s) s, max(e) e, count(*) n_exons, cast(sum(e - s + 1) as bigint) size, min(e - s + 1) smallest_exon from exons group by all),
ce as (select * from exons where biotype <> 'protein_coding'), ae as (select * from exons where biotype = 'protein_coding'),
ct as (select * from tx where biotype <> 'protein_coding'), at_ as (select * from tx where biotype = 'protein_coding'),
reach as (select *, max(e) over (partition by transcript_id order by s, e rows between unbounded preceding and 1 preceding) r from exons),
introns as (select transcript_id, chr, strand, biotype, r + 1 s, s - 1 e from reach where s > r + 1)
"""
OVERLAP = """
ov as (select a.transcript_id, b.transcript_id other_id, cast(sum(least(a.e, b.e) - greatest(a.s, b.s) + 1) as bigint) overlap
  from ce a join ae b on a.chr = b.chr and a.strand = b.strand and a.strand in ('+', '-') and a.s <= b.e and b.s <= a.e group by all)
"""


@_query(f'with {EXONS} select transcript_id, gene_id, chr, strand, biotype, s as "start", e as "end", n_exons, size, smallest_exon from tx')
def tx_rollup(spark: SparkSession, d: str) -> DataFrame:
    return _tx(spark, d)


@_query(f'with {EXONS} select gene_id, chr, min(s) as "start", max(e) as "end", count(*) n_transcripts from tx where gene_id <> \'\' group by all')
def gene_rollup(spark: SparkSession, d: str) -> DataFrame:
    return tx.gene_rollup(_tx(spark, d))


@_query(f"""with {EXONS} select transcript_id, s as "start", e as "end", case when strand = '-' then row_number() over (partition by transcript_id order by e desc, s desc)
  else row_number() over (partition by transcript_id order by s, e) end exon_number from exons""")
def exon_rank(spark: SparkSession, d: str) -> DataFrame:
    return tx.exon_ranks(_exons(spark, d)).select("transcript_id", "start", "end", "exon_number")


@_query(f'with {EXONS} select transcript_id, chr, strand, s as "start", e as "end", e - s + 1 as size from introns')
def introns(spark: SparkSession, d: str) -> DataFrame:
    return tx.introns(_exons(spark, d))


@_query(f"""with {EXONS}, i as (select *, sum(case when r is null or s - r - 1 >= 200 then 1 else 0 end) over (partition by transcript_id order by s, e rows unbounded preceding) g from reach)
  select transcript_id, chr, strand, min(s) as "start", max(e) as "end" from i group by transcript_id, chr, strand, g""")
def merge_small_introns(spark: SparkSession, d: str) -> DataFrame:
    return tx.merge_small_introns(_exons(spark, d), 200)


@_query(f"""with {EXONS} select transcript_id, chr, strand, case when strand = '-' then e else greatest(1, s - 500) end as "start", case when strand = '-' then e + 500 else s end as "end" from tx""")
def promoters(spark: SparkSession, d: str) -> DataFrame:
    return tx.promoters(_tx(spark, d))


@_query(f"with {EXONS} select gene_id, transcript_id, size from tx where gene_id <> '' qualify row_number() over (partition by gene_id order by size desc, transcript_id) = 1")
def longest_tx_per_gene(spark: SparkSession, d: str) -> DataFrame:
    return tx.longest_per_gene(_tx(spark, d))


@_query(f"with {EXONS} select gene_id, arg_min(transcript_id, md5(transcript_id || '|1') || transcript_id) transcript_id from tx where gene_id <> '' group by 1")
def random_tx_per_gene(spark: SparkSession, d: str) -> DataFrame:
    return tx.random_per_gene(_tx(spark, d))


@_query(f"with {EXONS} select transcript_id, size from tx where size between 200 and 100000")
def tx_size_between(spark: SparkSession, d: str) -> DataFrame:
    return tx.size_between(_tx(spark, d)).select("transcript_id", "size")


@_query(f"with {EXONS} select transcript_id, n_exons from tx where n_exons between 2 and 5")
def tx_exon_between(spark: SparkSession, d: str) -> DataFrame:
    return tx.exons_between(_tx(spark, d), 2, 5).select("transcript_id", "n_exons")


@_query(f"with {EXONS} select transcript_id from tx where n_exons = 1")
def mono_exonic(spark: SparkSession, d: str) -> DataFrame:
    return tx.exons_between(_tx(spark, d)).select("transcript_id")


TWINS = """twins as (select transcript_id, chr, strand, s, e from exons union all select transcript_id || '_TWIN', chr, strand, s, e from exons),
itwins as (select transcript_id, chr, strand, s, e from introns union all select transcript_id || '_TWIN', chr, strand, s, e from introns)"""


def _with_twins(exons: DataFrame) -> DataFrame:
    """Every transcript twice, as when an assembly is loaded again under other ids."""
    return exons.unionByName(exons.withColumn("transcript_id", F.concat("transcript_id", F.lit("_TWIN"))))


@_query(f"""with {EXONS}, {TWINS}, p as (select transcript_id, chr, strand, string_agg(s || '-' || e, ',' order by s, e) p from twins group by all),
  k as (select transcript_id, min(transcript_id) over (partition by chr, strand, p) kept_id from p) select * from k where transcript_id <> kept_id""")
def dedup_same_exons(spark: SparkSession, d: str) -> DataFrame:
    return tx.same_structure(_with_twins(_exons(spark, d)))


@_query(f"""with {EXONS}, {TWINS}, p as (select transcript_id, chr, strand, string_agg(s || '-' || e, ',' order by s, e) p from itwins group by all),
  k as (select transcript_id, min(transcript_id) over (partition by chr, strand, p) kept_id from p) select * from k where transcript_id <> kept_id""")
def dedup_same_introns(spark: SparkSession, d: str) -> DataFrame:
    return tx.same_structure(tx.introns(_with_twins(_exons(spark, d))))


@_query(f"""with {EXONS} select transcript_id, case when size < 200 then 'size' when n_exons = 1 then 'mono_exonic' when n_exons = 2 and smallest_exon < 25 then 'bi_exonic' end drop_reason from ct""")
def filter_reasons(spark: SparkSession, d: str) -> DataFrame:
    return cand.structure_reasons(_lnc(_tx(spark, d))).select("transcript_id", "drop_reason")


@_query(f"""with {EXONS}, {OVERLAP} select transcript_id, case when size < 200 then 'size' when n_exons = 1 then 'mono_exonic' when n_exons = 2 and smallest_exon < 25 then 'bi_exonic'
  when transcript_id in (select transcript_id from ov) then 'overlap' end drop_reason from ct""")
def filter_candidates(spark: SparkSession, d: str) -> DataFrame:
    ex, t = _both(spark, d)
    return cand.filter_candidates(_lnc(ex), _lnc(t), _coding(ex)).select("transcript_id", "drop_reason")


@_query(f"with {EXONS}, {OVERLAP} select * from ov")
def overlap_sum(spark: SparkSession, d: str) -> DataFrame:
    ex, _ = _both(spark, d)
    return cand.exon_overlaps(_lnc(ex), _coding(ex))


@_query(f"with {EXONS}, {OVERLAP} select transcript_id, other_id, round(overlap / size, 6) fraction from ov join ct using (transcript_id) where overlap / size > 0.2")
def overlap_fraction(spark: SparkSession, d: str) -> DataFrame:
    ex, t = _both(spark, d)
    return cand.overlap_fractions(_lnc(ex), _lnc(t), _coding(ex), 0.2).select("transcript_id", "other_id", F.round("fraction", 6).alias("fraction"))


@_query(f"with {EXONS}, {OVERLAP} select transcript_id from ct where transcript_id not in (select transcript_id from ov join ct using (transcript_id) where overlap / size > 0.2)")
def overlap_fraction_anti(spark: SparkSession, d: str) -> DataFrame:
    ex, t = _both(spark, d)
    return cand.unannotated(_lnc(ex), _lnc(t), _coding(ex), 0.2).select("transcript_id")


@_query(f"with {EXONS}, {OVERLAP} select distinct transcript_id from ov")
def overlap_semi(spark: SparkSession, d: str) -> DataFrame:
    ex, t = _both(spark, d)
    return cand.annotated(_lnc(ex), _lnc(t), _coding(ex))


@_query(f"""with {EXONS}, h as (select a.transcript_id || '.' || a.s || '.' || a.e transcript_id, bool_or(a.strand = b.strand) sense from ce a
  join ae b on a.chr = b.chr and a.s <= b.e and b.s <= a.e and a.strand in ('+', '-') and b.strand in ('+', '-') group by 1) select transcript_id from h where not sense""")
def antisense_single_exons(spark: SparkSession, d: str) -> DataFrame:
    """The same of every exon of the candidates, as a transcript of its own."""
    ex, _ = _both(spark, d)
    single = _lnc(ex).withColumn("transcript_id", F.concat_ws(".", "transcript_id", "start", "end"))
    return cand.antisense_mono_exonic(single, tx.transcript_rollup(single), _coding(ex))


@_query(f"""with {EXONS}, h as (select a.transcript_id, bool_or(a.strand = b.strand) sense from ce a join ct t on a.transcript_id = t.transcript_id and t.n_exons = 1
  join ae b on a.chr = b.chr and a.s <= b.e and b.s <= a.e and a.strand in ('+', '-') and b.strand in ('+', '-') group by 1) select transcript_id from h where not sense""")
def antisense_monoexonic(spark: SparkSession, d: str) -> DataFrame:
    ex, t = _both(spark, d)
    return cand.antisense_mono_exonic(_lnc(ex), _lnc(t), _coding(ex))


@_query(f"""with {EXONS} select transcript_id from ct a where not exists (select 1 from at_ b where a.chr = b.chr and a.strand = b.strand and a.strand in ('+', '-') and a.s <= b.e and b.s <= a.e)""")
def linconly_span(spark: SparkSession, d: str) -> DataFrame:
    _, t = _both(spark, d)
    return cand.intergenic_only(_lnc(t), _coding(t)).select("transcript_id")


def _matches(ex: DataFrame, t: DataFrame) -> DataFrame:
    return cand.reciprocal_matches(_lnc(ex), _lnc(t), _coding(ex), _coding(t), 0.1)


_MATCHES = f"""{EXONS}, {OVERLAP}, m as (select a.transcript_id a_id, b.transcript_id b_id, overlap / a.size fa, overlap / b.size fb from ov join ct a using (transcript_id) join at_ b on b.transcript_id = other_id
  where overlap / a.size >= 0.1 and overlap / b.size >= 0.1)"""


@_query(f"with {_MATCHES} select a_id, b_id, round(fa, 6) fraction_a, round(fb, 6) fraction_b from m")
def reciprocal_overlap(spark: SparkSession, d: str) -> DataFrame:
    return _matches(*_both(spark, d)).select("a_id", "b_id", F.round("fraction_a", 6).alias("fraction_a"), F.round("fraction_b", 6).alias("fraction_b"))


@_query(f"""with {_MATCHES} select distinct a_id transcript_id, 'common' origin from m union all select transcript_id, 'only_a' from ct where transcript_id not in (select a_id from m)
  union all select transcript_id, 'only_b' from at_ where transcript_id not in (select b_id from m)""")
def compare_sets(spark: SparkSession, d: str) -> DataFrame:
    ex, t = _both(spark, d)
    return cand.compare_sets(_matches(ex, t), _lnc(t), _coding(t))


def _spans(spark: SparkSession, d: str) -> DataFrame:
    t = shared_checkpoint(_tx(spark, d).where("chr <> ''"))
    cut = lambda x: x.select("transcript_id", "chr", "start", "end")
    return range_join(cut(_lnc(t)), cut(_coding(t)), ["chr"])


_PAIR = ["l.transcript_id as transcript_id", "r.transcript_id as other_id"]


@_query(f"with {EXONS} select a.transcript_id, b.transcript_id other_id, greatest(a.s, b.s) as both_start, least(a.e, b.e) as both_end from ct a join at_ b on a.chr = b.chr and a.chr <> '' and a.s <= b.e and b.s <= a.e")
def range_overlaps(spark: SparkSession, d: str) -> DataFrame:
    both = intersection(F.col("l.start"), F.col("l.end"), F.col("r.start"), F.col("r.end"))
    return _spans(spark, d).withColumn("both", both).selectExpr(*_PAIR, "both.start as both_start", "both.end as both_end")


@_query(f"with {EXONS} select a.transcript_id, b.transcript_id other_id from ct a join at_ b on a.chr = b.chr and a.chr <> '' and a.s <= b.s and b.e <= a.e")
def range_contains(spark: SparkSession, d: str) -> DataFrame:
    return _spans(spark, d).where("l.start <= r.start and r.end <= l.end").selectExpr(*_PAIR)


@_query(f"with {EXONS} select a.transcript_id, b.transcript_id other_id from ct a join at_ b on a.chr = b.chr and a.chr <> '' and b.s <= a.s and a.e <= b.e")
def range_contained_in(spark: SparkSession, d: str) -> DataFrame:
    return _spans(spark, d).where("r.start <= l.start and l.end <= r.end").selectExpr(*_PAIR)


@_query(f"with {EXONS} select distinct chr from ct where chr not in (select chr from at_)")
def chr_only_in_candidates(spark: SparkSession, d: str) -> DataFrame:
    t = _tx(spark, d)
    return _lnc(t).select("chr").distinct().join(_coding(t).select("chr").distinct(), "chr", "left_anti")


# Third stage -------------------------------------------------------------------------------

STEPS = f"""{EXONS},
near as (select a.transcript_id l_id, b.transcript_id r_id, a.gene_id lg, b.gene_id rg, a.strand ls, b.strand rs, a.s lb, a.e le, b.s rb, b.e re, greatest(0, b.s - a.e, a.s - b.e) gap
  from ct a join at_ b on lower(a.chr) = lower(b.chr) and a.s - 100000 <= b.e and b.s <= a.e + 100000),
step as (select *, min(greatest(1, cast(ceil(gap / 10000.0) as int))) over (partition by l_id) step from near),
kept as (select * from step where gap <= step * 10000)"""
PAIRS = f"""{STEPS},
sh as (select a.transcript_id l_id, b.transcript_id r_id, sum(least(a.e, b.e) - greatest(a.s, b.s) + 1) exon_overlap, sum(least(a.e, b.e) - least(a.s, b.s)) rank_overlap
  from ce a join ae b on lower(a.chr) = lower(b.chr) and a.s <= b.e and b.s <= a.e group by all),
touch as (select a.transcript_id l_id, b.transcript_id r_id, count(*) n from ce a join at_ b on lower(a.chr) = lower(b.chr) and a.s <= b.e and b.s <= a.e group by all),
ins as (select a.transcript_id l_id, b.transcript_id r_id, count(*) m from ce a join introns b on b.biotype = 'protein_coding' and lower(a.chr) = lower(b.chr) and b.s <= a.s and a.e <= b.e group by all),
geo as (select *, lb <= re and rb <= le genic, case when not (ls in ('+', '-') and rs in ('+', '-')) then 'strand_unknow' when ls = rs then 'sense' else 'antisense' end direction,
  case rs when '+' then lb <= re when '-' then lb > re else false end up from kept left join sh using (l_id, r_id) left join touch using (l_id, r_id) left join ins using (l_id, r_id)),
pairs as (select lg lncrna_gene, l_id lncrna_transcript, rg partnerrna_gene, r_id partnerrna_transcript, direction, case when genic then 'genic' else 'intergenic' end rel_type, gap distance,
  case when genic then case when lb <= rb and le >= re then 'containing' when rb <= lb and re >= le then 'nested' else 'overlapping' end
    when direction = 'sense' then 'same_strand' when direction = 'strand_unknow' then 'unknow strand(s)' when up then 'divergent' else 'convergent' end subtype,
  case when genic then case when exon_overlap is not null then 'exonic' when n is null or n = coalesce(m, 0) then 'intronic' else 'none' end when up then 'upstream' else 'downstream' end rel_location,
  cast(coalesce(exon_overlap, 0) as bigint) exon_overlap, cast(coalesce(rank_overlap, 0) as bigint) rank_overlap from geo),
best as (select *, cast(row_number() over (partition by lncrna_transcript order by rel_type = 'genic' desc, rank_overlap desc, distance, partnerrna_transcript) = 1 as int) is_best from pairs)"""


def _pairs(ex: DataFrame, t: DataFrame) -> DataFrame:
    return classify.interactions(_lnc(t), _lnc(ex), _coding(t), _coding(ex))


@_query(f"with {STEPS} select l_id lncrna_transcript, r_id partnerrna_transcript, gap, step from kept")
def window_expand(spark: SparkSession, d: str) -> DataFrame:
    t = shared_checkpoint(_tx(spark, d))
    return classify.neighbours(_lnc(t), _coding(t)).select(F.col("l.transcript_id").alias("lncrna_transcript"), F.col("r.transcript_id").alias("partnerrna_transcript"), "gap", "step")


@_query(f"with {PAIRS} select * from best")
def classify_interactions(spark: SparkSession, d: str) -> DataFrame:
    return _pairs(*_both(spark, d))


@_query(f"with {PAIRS} select * exclude (is_best) from best where is_best = 1")
def best_partner(spark: SparkSession, d: str) -> DataFrame:
    return classify.best_interactions(_pairs(*_both(spark, d))).drop("is_best")


@_query(f"with {STEPS} select transcript_id lncrna_transcript from ct where transcript_id not in (select l_id from kept)")
def unmatched_lnc(spark: SparkSession, d: str) -> DataFrame:
    ex, t = _both(spark, d)
    return classify.unmatched(_lnc(t), _pairs(ex, t))


@_query(f"""with {STEPS} select (select count(*) from ct) n_lncrnas, (select count(*) from at_) n_partners, (select count(*) from kept) n_interactions,
  (select count(*) from ct where transcript_id not in (select l_id from kept)) n_unmatched""")
def classifier_summary(spark: SparkSession, d: str) -> DataFrame:
    ex, t = _both(spark, d)
    return classify.classifier_summary(_lnc(t), _coding(t), _pairs(ex, t))


# Collections of interactions, over the classifier's own table ---------------------------------

_KEY = "lncrna_transcript, partnerrna_transcript, direction, rel_type, distance, subtype, rel_location"


def _table(spark: SparkSession, d: str) -> DataFrame:
    return spark.read.parquet(f"{d}/interactions.parquet")


def _key(df: DataFrame) -> DataFrame:
    return df.select(*_KEY.split(", "))


@_query("select inter_id, distance from interactions where rel_type = 'intergenic' and direction = 'antisense' and distance between 100 and 5000")
def interactions_selected(spark: SparkSession, d: str) -> DataFrame:
    return classify.select_interactions(_table(spark, d), "intergenic", "antisense", None, (100, 5000)).select("inter_id", "distance")


for _op, _sign in (("eq", "="), ("lt", "<"), ("le", "<="), ("gt", ">"), ("ge", ">=")):
    _limit = 0 if _op == "eq" else 4000

    def _compared(spark: SparkSession, d: str, op: str = _op, limit: int = _limit) -> DataFrame:
        return classify.select_interactions(_table(spark, d), compared=(op, limit)).select("inter_id", "distance")

    _compared.__name__ = f"interactions_{_op}"
    _query(f"select inter_id, distance from interactions where distance {_sign} {_limit}")(_compared)


@_query("select inter_id from interactions where subtype = 'nested' union all select inter_id from interactions where subtype = 'divergent' and direction = 'antisense'")
def interactions_nested_divergent(spark: SparkSession, d: str) -> DataFrame:
    t = _table(spark, d)
    return classify.select_interactions(t, nested=True).unionByName(classify.select_interactions(t, direction="antisense", divergent=True)).select("inter_id")


@_query("select inter_id from interactions where rel_location = 'exonic' and isbest = 1 and subtype <> 'nested'")
def interactions_tagged(spark: SparkSession, d: str) -> DataFrame:
    return classify.select_interactions(_table(spark, d), nested=False, tags={"rel_location": "exonic", "isbest": 1}).select("inter_id")


_BUSIEST = "(select {c} from interactions where {c} is not null group by 1 order by count(*) desc, 1 limit 1)"


def _of_busiest(side: int) -> None:
    cols = classify.SIDES[side]
    match = " or ".join(f"coalesce({c} = {_BUSIEST.format(c=cols[0])}, false)" for c in cols)

    def run(spark: SparkSession, d: str) -> DataFrame:
        t = _table(spark, d)
        busiest = t.where(F.col(cols[0]).isNotNull()).groupBy(F.col(cols[0]).alias("id")).count().orderBy(F.desc("count"), "id").first()
        return classify.select_interactions(t, transcript=busiest.id if busiest else "", side=side).select("inter_id")

    run.__name__ = f"interactions_of_side{side}"
    run.__doc__ = "The interactions of the transcript that has most on its side."
    _query(f"select inter_id from interactions where {match}")(run)


for _side in classify.SIDES:
    _of_busiest(_side)


@_query("select distinct partnerrna_transcript transcript_id from interactions where rel_type = 'genic' and partnerrna_transcript is not null")
def genic_partners(spark: SparkSession, d: str) -> DataFrame:
    return classify.selected_partners(classify.select_interactions(_table(spark, d), "genic"))


@_query(f"select {_KEY} from interactions where rel_type = 'genic' union select {_KEY} from interactions where isbest = 1")
def interaction_union(spark: SparkSession, d: str) -> DataFrame:
    t = _table(spark, d)
    return _key(t.where("rel_type = 'genic'")).union(_key(t.where("isbest = 1"))).distinct()


@_query(f"select {_KEY} from interactions where rel_type = 'genic' intersect select {_KEY} from interactions where isbest = 1")
def interaction_intersect(spark: SparkSession, d: str) -> DataFrame:
    t = _table(spark, d)
    return _key(t.where("rel_type = 'genic'")).intersect(_key(t.where("isbest = 1")))


@_query(f"select {_KEY} from interactions where rel_type = 'genic' except select {_KEY} from interactions where isbest = 1")
def interaction_except(spark: SparkSession, d: str) -> DataFrame:
    t = _table(spark, d)
    return _key(t.where("rel_type = 'genic'")).subtract(_key(t.where("isbest = 1")))


@_query("""select upper(trim(partnerrna_transcript)) partner, count(*) n, count(distinct upper(trim(lncrna_transcript))) n_lncrnas, min(distance) nearest from interactions
  where upper(trim(partnerrna_transcript)) not in ('', '.') group by 1""")
def partner_index(spark: SparkSession, d: str) -> DataFrame:
    rows = _table(spark, d).select(spelled(F.col("partnerrna_transcript")).alias("partner"), spelled(F.col("lncrna_transcript")).alias("lnc"), "distance")
    return rows.where(names_something(F.col("partner"))).groupBy("partner").agg(F.count("*").alias("n"), F.count_distinct("lnc").alias("n_lncrnas"), F.min("distance").alias("nearest"))


# Gene level -------------------------------------------------------------------------------

_CODE = """case rel_type when 'intergenic' then 'linc' || sub || case when sub = 'SS' then loc else '' end when 'genic' then 'lncg' || dir || loc || sub else 'ERROR' end"""


def _worded(column: str, words: dict[str, str]) -> str:
    return f"case {column} {' '.join(f'when {k!r} then {v!r}' for k, v in words.items())} else 'ERROR' end"


_CODED = f"""parts as (select *, {_worded("subtype", gene_level.SUBTYPES)} sub, {_worded("rel_location", gene_level.LOCATIONS)} loc, {_worded("direction", gene_level.DIRECTIONS)} dir from interactions where isbest = 1),
coded as (select *, {_CODE} class from parts)"""


def _coded(spark: SparkSession, d: str) -> DataFrame:
    code = gene_level.class_code(F.col("rel_type"), F.col("direction"), F.col("rel_location"), F.col("subtype"))
    return _table(spark, d).where("isbest = 1").withColumn("class", F.when(F.col("rel_type").isNotNull(), code).otherwise("ERROR"))


@_query(f"with {_CODED} select inter_id, class from coded")
def gene_class_code(spark: SparkSession, d: str) -> DataFrame:
    return _coded(spark, d).select("inter_id", "class")


def _best_rows(spark: SparkSession, d: str) -> DataFrame:
    named = F.when(F.col("class") != "ERROR", F.col("class")).alias("class")
    return _coded(spark, d).select(spelled(F.col("lncrna_gene")).alias("gene_id"), spelled(F.col("lncrna_transcript")).alias("transcript_id"), named, spelled(F.col("partnerrna_gene")).alias("partner_gene"), "distance").distinct()


def _registered(spark: SparkSession, d: str) -> DataFrame:
    """The lncRNAs of the registry."""
    rows = spark.read.parquet(f"{d}/transcripts.parquet").where("biotype <> 'protein_coding'")
    ids = rows.select(spelled(F.col("gene_id")).alias("gene_id"), spelled(F.col("transcript_id")).alias("transcript_id"))
    return ids.where(names_something(F.col("gene_id")) & names_something(F.col("transcript_id"))).distinct()


_ORDER = " ".join(f"when '{c}' then {i - (c == 'lincSSdw')}" for i, c in enumerate(gene_level.ORDER, 1))
_RANK = f"case class {_ORDER} else {len(gene_level.ORDER) + 1} end"
_ROWS = f"""{_CODED}, rows as (select distinct upper(trim(lncrna_gene)) gene_id, upper(trim(lncrna_transcript)) transcript_id, coalesce(nullif(class, 'ERROR'), 'unclassified') class, upper(trim(partnerrna_gene)) partner_gene, distance from coded)"""
_ANNOTATED = f"""{_ROWS}, reg as (select distinct upper(trim(gene_id)) gene_id, upper(trim(transcript_id)) transcript_id from transcripts where biotype <> 'protein_coding' and upper(trim(gene_id)) not in ('', '.') and upper(trim(transcript_id)) not in ('', '.')),
one as (select transcript_id, class, partner_gene, distance from rows where transcript_id is not null qualify row_number() over (partition by transcript_id order by {_RANK}, coalesce(distance, 4611686018427387904), coalesce(partner_gene, '~')) = 1),
r as (select gene_id, transcript_id, coalesce(class, 'unclassified') class, partner_gene, distance from reg left join one using (transcript_id))"""


def _genes(rows: str, near: str = "coalesce(distance, 4611686018427387904)", name: str = "b.class") -> str:
    return f"""with {rows},
  a as (select gene_id, count(*) n_transcripts, count(distinct class) filter (class <> 'unclassified') nc, count(distinct partner_gene) np, string_agg(distinct class, ';' order by class) classes, arg_min(class, transcript_id) first_class from r group by 1),
  b as (select * from r qualify row_number() over (partition by gene_id order by {_RANK}, {near}, coalesce(partner_gene, '~'), transcript_id) = 1),
  t as (select *, case when np = 0 then 'unclassified' else case when n_transcripts = 1 then '1' else 'n' end || '.' || case when nc = 1 then '1' else 'n' end || '.' || case when np = 1 then '1' else 'n' end end class_type from a)
  select gene_id, n_transcripts, {name} || case when class_type in ('n.n.n', 'n.1.n') then '_' || class_type else '' end class, class_type, partner_gene, distance, classes from t join b using (gene_id)"""


@_query(_genes(_ANNOTATED))
def gene_class_pick(spark: SparkSession, d: str) -> DataFrame:
    """Every lncRNA gene of the registry; those no transcript of which has a partner are unclassified."""
    return gene_level.gene_classes(gene_level.transcript_classes(_registered(spark, d), _best_rows(spark, d)))


@_query(_genes(_ANNOTATED, "coalesce(cast(distance as varchar), 'NA')", "case when class_type = 'n.n.1' then coalesce(nullif(regexp_extract(first_class, '^(lncgSSex|lncgSSin|lncgASex|lncgASin|lincDivg|lincConv|lincSS)', 1), ''), first_class) else b.class end"))
def gene_class_compat(spark: SparkSession, d: str) -> DataFrame:
    """The same with distances compared as text and shortened classes for n.n.1 genes."""
    return gene_level.gene_classes(gene_level.transcript_classes(_registered(spark, d), _best_rows(spark, d)), compat=True)


@_query(_genes(_ROWS + ", r as (select * from rows)"))
def gene_class_of_interactions(spark: SparkSession, d: str) -> DataFrame:
    """The genes of the interactions alone."""
    return gene_level.gene_classes(_best_rows(spark, d))


# Text formats ---------------------------------------------------------------------------------


def _lines(spark: SparkSession, d: str) -> DataFrame:
    return spark.read.parquet(f"{d}/gtf_lines.parquet").select(F.col("line").alias("value"))


_BIOTYPES = ", ".join(f"'{b}'" for b in BIOTYPES)
_CUT = f"""cells as (select string_split(regexp_replace(line, '\\r+$', ''), chr(9)) c from gtf_lines where trim(regexp_replace(line, '\\r+$', '')) <> '' and not regexp_matches(line, '^(#|track|browser)')),
fault as (select c, case when len(c) <> 9 then 'columns' when not (regexp_full_match(trim(c[4]), '[+-]?[0-9]+') and regexp_full_match(trim(c[5]), '[+-]?[0-9]+')) then 'coordinates' end reason from cells),
feats as (select c[1] chr, c[2] source, c[3] feat_level, cast(trim(c[4]) as bigint) s, cast(trim(c[5]) as bigint) e, c[7] strand,
    list_filter(list_transform(regexp_extract_all(c[9], '(?:"[^"]*(?:"|$)|[^;"])+'), lambda x: regexp_replace(x, '^\\s+|\\s+$', '', 'g')), lambda x: regexp_matches(x, '^\\S+\\s')) p
  from fault where reason is null and not regexp_matches(c[1], '(PATCH|TEST)$'))"""


def _attr(key: str) -> str:
    """SQL for the last value under `key`, a pattern."""
    return f"regexp_replace(regexp_replace(list_filter(p, lambda x: regexp_matches(x, '^({key})\\s'))[-1], '^\\S+\\s+', ''), '^\"|\"$', '', 'g')"


@_query(f"""with {_CUT}, f as (select *, case when source in ({_BIOTYPES}) then source else {_attr('transcript_biotype|transcript_type')} end biotype from feats)
  select chr, source, feat_level, s as "start", e as "end", strand, {_attr('transcript_id')} transcript_id, {_attr('gene_id')} gene_id, biotype
  from f where feat_level in ('exon', 'CDS') and strand in ('+', '-') and (biotype is null or biotype in ('protein_coding', 'lincRNA'))""")
def gtf_features_parsed(spark: SparkSession, d: str) -> DataFrame:
    rows = gtf_features(_lines(spark, d), ("exon", "CDS"), {"transcript_biotype": ["protein_coding", "lincRNA"]}, {"strand": ["+", "-"]})
    return rows.select("chr", "source", "feat_level", "start", "end", "strand", "transcript_id", "gene_id", F.col("attrs")["transcript_biotype"].alias("biotype"))


@_query(f"with {_CUT} select reason, count(*) n from fault where reason is not null group by 1")
def gtf_rejected(spark: SparkSession, d: str) -> DataFrame:
    """How many lines no feature can be read from, by reason."""
    return rejected_lines(_lines(spark, d)).groupBy("reason").agg(F.count("*").alias("n"))


def _tabbed(*cells: object) -> Column:
    return F.concat_ws("\t", *[c if isinstance(c, Column) else F.lit(c) for c in cells]).alias("value")


@_query(f'with {EXONS} select transcript_id, gene_id, chr, strand, s as "start", e as "end" from exons')
def gff3_exons(spark: SparkSession, d: str) -> DataFrame:
    """All exons, written as GFF3 lines with their mRNAs and read again."""
    ex, t = _both(spark, d)
    col = F.col
    line = lambda level, about: _tabbed(col("chr"), ".", level, col("start"), col("end"), ".", col("strand"), ".", about)
    lines = t.select(line("mRNA", F.concat(F.lit("ID="), "transcript_id", F.lit(";Parent="), "gene_id"))).unionByName(ex.select(line("exon", F.concat(F.lit("Parent="), "transcript_id"))))
    return gff3_features(lines).select("transcript_id", "gene_id", "chr", "strand", "start", "end")


@_query(f"""with {EXONS}, n as (select *, row_number() over (partition by transcript_id order by s, e) i from exons)
  select transcript_id || case when i > 1 then '_dup' || i else '' end transcript_id, chr, strand, s as "start", e as "end" from n""")
def bed_exons(spark: SparkSession, d: str) -> DataFrame:
    """All exons, written as BED lines named by their transcript and read again."""
    col = F.col
    lines = _exons(spark, d).select(_tabbed(col("chr"), col("start") - 1, col("end"), col("transcript_id"), 0, col("strand")))
    return bed_features(lines).select("transcript_id", "chr", "strand", "start", "end")


@_query(f"""with {EXONS} select transcript_id, s as "start", s as "end" from tx where e > s union all select transcript_id, e, e from tx where e > s""")
def bed_blocks(spark: SparkSession, d: str) -> DataFrame:
    """The ends of all transcripts, as two blocks of a BED line each."""
    col = F.col
    t = _tx(spark, d).where("end > start")
    lines = t.select(_tabbed(col("chr"), col("start") - 1, col("end"), col("transcript_id"), 0, col("strand"), col("start") - 1, col("end"), 0, 2, "1,1,", F.concat(F.lit("0,"), col("end") - col("start"))))
    return bed_features(lines).select("transcript_id", "start", "end")


_TABLE = "isbest, lncrna_gene, lncrna_transcript, partnerrna_gene, partnerrna_transcript, direction, rel_type, distance, subtype, rel_location"


@_query(f"select {_TABLE} from interactions")
def interactions_file(spark: SparkSession, d: str) -> DataFrame:
    """The classifier's table, written as text and read again."""
    path = scratch_path(spark)
    write_interactions(_table(spark, d).withColumnRenamed("isbest", "is_best"), path)
    return read_interactions(spark, path).withColumnRenamed("is_best", "isbest")


@_query(f"with {EXONS} select case when biotype = 'protein_coding' then 'mRNA' else 'lncRNA' end class, count(*) n_lines, count(distinct transcript_id) n_transcripts from exons group by 1")
def routed_files(spark: SparkSession, d: str) -> DataFrame:
    """Exons written into a folder of GTF lines for each class, and what these hold."""
    rows = _exons(spark, d).withColumn("class", F.when(F.col("biotype") == "protein_coding", "mRNA").otherwise("lncRNA"))
    full = rows.select("class", "chr", F.lit("x").alias("source"), F.lit("exon").alias("feat_level"), "start", "end", F.lit(".").alias("score"), "strand", F.lit(".").alias("frame"), "gene_id", "transcript_id", F.create_map(F.lit("transcript_biotype"), "biotype").alias("attrs"))
    path = scratch_path(spark)
    write_routed(full, path)
    lines = spark.read.text(path)
    counted = lines.withColumn("transcript_id", F.regexp_extract("value", 'transcript_id "([^"]*)"', 1))
    return counted.groupBy("class").agg(F.count("*").alias("n_lines"), F.count_distinct("transcript_id").alias("n_transcripts"))


@_query()
def gtf_roundtrip(spark: SparkSession, d: str) -> DataFrame:
    """All features, and how many of them differ once written as lines and read again.

    Lines have no way to write a double quote within a value, so values with one may come back
    changed; such features are counted, not left out.
    """
    levels = ("exon", "CDS", "transcript")
    flat = lambda f: f.select("chr", "source", "feat_level", "start", "end", "score", "strand", "frame", "transcript_id", "gene_id", F.array_sort(F.map_entries("attrs")).cast("string").alias("attrs"))
    kept = gtf_features(_lines(spark, d), levels)
    changed = flat(kept).exceptAll(flat(gtf_features(gtf_text(kept), levels)))
    return kept.agg(F.count("*").alias("n_features"), F.max(changed.agg(F.count("*")).scalar()).alias("n_changed"))


@_query(f"""with {EXONS} select transcript_id, 'transcript' feat_level, s as "start", e as "end" from tx union all select transcript_id, 'exon', s, e from exons""")
def transcript_lines(spark: SparkSession, d: str) -> DataFrame:
    return tx.with_transcript_rows(_exons(spark, d).withColumn("feat_level", F.lit("exon"))).select("transcript_id", "feat_level", "start", "end")


# Search in the feature table -------------------------------------------------------------------


@_query("""select row_id, 10 * len(regexp_extract_all(lower(note), 'low|spliced')) relevance from (select row_id, regexp_extract(attributes, 'note "([^"]*)"', 1) note from gtf)
  where regexp_matches(lower(note), 'low|spliced')""")
def note_search(spark: SparkSession, d: str) -> DataFrame:
    notes = _gtf(spark, d).select("row_id", F.regexp_extract("attributes", 'note "([^"]*)"', 1).alias("note"))
    return search.search_text(notes, "note", ["low", "spliced"]).select("row_id", "relevance")


@_query("select feat_level, source, count(*) n from gtf group by all")
def feature_types(spark: SparkSession, d: str) -> DataFrame:
    return search.feature_types(_gtf(spark, d))


@_query("""select row_id from gtf where lower(feat_level) in ('exon', 'cds') and lower(chr) = 'chr28' and start_pos <= 9000000 and end_pos >= 1000000 and regexp_matches(lower(transcript_id), '^mtr.*7$')""")
def features_found(spark: SparkSession, d: str) -> DataFrame:
    rows = _gtf(spark, d).withColumnsRenamed({"start_pos": "start", "end_pos": "end"})
    return search.find_features(rows, "mtr*7", ["exon", "CDS"], ("chr28", 1_000_000, 9_000_000)).select("row_id")


@_query(f"""with {_CUT}, k as (select unnest(list_distinct(list_concat(list_transform(p, lambda x: case regexp_extract(x, '^\\S+') when 'transcript_type' then 'transcript_biotype' when 'gene_type' then 'gene_biotype' else regexp_extract(x, '^\\S+') end),
  case when source in ({_BIOTYPES}) then ['transcript_biotype'] else [] end))) attr_key from feats where feat_level in ('exon', 'CDS', 'transcript', 'gene')) select attr_key, count(*) n from k group by 1""")
def attribute_names(spark: SparkSession, d: str) -> DataFrame:
    return search.attribute_names(gtf_features(_lines(spark, d), ("exon", "CDS", "transcript", "gene")))


@_query(f"""with {_CUT}, f as (select *, {_attr('gene_id')} g from feats where feat_level in ('exon', 'CDS', 'transcript', 'gene')) select chr, s as "start", e as "end", g gene_id from f where regexp_matches(lower(g), '^.*1$') and lower(feat_level) = 'exon'""")
def features_by_attribute(spark: SparkSession, d: str) -> DataFrame:
    """Exons whose gene's id ends in 1."""
    rows = gtf_features(_lines(spark, d), ("exon", "CDS", "transcript", "gene"))
    return search.find_features(rows, types=["exon"], attributes={"gene_id": "*1"}).select("chr", "start", "end", "gene_id")


# Strands and samples ---------------------------------------------------------------------------


@_query(f"""with {EXONS}, m as (select unnest([0, 1, -1]) mode), j as (select a.transcript_id, b.transcript_id other_id, a.strand ls, b.strand rs, greatest(a.s, b.s) x, least(a.e, b.e) y from ct a join at_ b on a.chr = b.chr and a.chr <> '' and a.s <= b.e and b.s <= a.e),
  o as (select *, mode = 0 or (ls in ('+', '-') and rs in ('+', '-') and ((mode = 1 and ls = rs) or (mode = -1 and ls <> rs))) ok from j, m)
  select transcript_id, other_id, mode, case when ok then x else 0 end as both_start, case when ok then y else 0 end as both_end from o""")
def overlap_by_strand(spark: SparkSession, d: str) -> DataFrame:
    """The common part of overlapping transcripts where strands don't matter, agree or oppose."""
    t = shared_checkpoint(_tx(spark, d).where("chr <> ''"))
    cut = lambda x: x.select("transcript_id", "chr", "strand", "start", "end")
    pairs = range_join(cut(_lnc(t)), cut(_coding(t)), ["chr"])
    args = [F.col(c) for c in ("l.start", "l.end", "r.start", "r.end", "l.strand", "r.strand")]
    modes = F.explode(F.array(*[F.struct(F.lit(m).alias("mode"), common_part(*args, m).alias("both")) for m in (0, 1, -1)]))
    return pairs.select(F.col("l.transcript_id").alias("transcript_id"), F.col("r.transcript_id").alias("other_id"), modes.alias("m")).select("transcript_id", "other_id", "m.mode", F.col("m.both.start").alias("both_start"), F.col("m.both.end").alias("both_end"))


@_query(f"with {EXONS} select transcript_id from tx order by md5(transcript_id || '|1'), transcript_id limit 100")
def transcript_sample(spark: SparkSession, d: str) -> DataFrame:
    return tx.sample_transcripts(_tx(spark, d), 100).select("transcript_id")


@_query(f"with {EXONS} select transcript_id, chr, n_exons from ct where chr in (select chr from at_)")
def candidates_on_annotated_chr(spark: SparkSession, d: str) -> DataFrame:
    """Candidates on a chr that the annotation has."""
    _, t = _both(spark, d)
    return cand.on_annotated_chr(_lnc(t), _coding(t)).select("transcript_id", "chr", "n_exons")


@_query(f"""with {EXONS}, {OVERLAP}, r as (select case when size < 200 then 'size' when n_exons = 1 then 'mono_exonic' when n_exons = 2 and smallest_exon < 25 then 'bi_exonic'
  when transcript_id in (select transcript_id from ov) then 'overlap' else 'kept' end drop_reason from ct) select drop_reason, count(*) n from r group by 1""")
def filter_log(spark: SparkSession, d: str) -> DataFrame:
    """How many candidates each rule drops, and how many are kept."""
    ex, t = _both(spark, d)
    return cand.filter_log(cand.filter_candidates(_lnc(ex), _lnc(t), _coding(ex)))
