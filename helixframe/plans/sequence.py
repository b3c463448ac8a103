"""Named queries over sequences and coding potential, each with its SQL.

Sequences are what the texts of documents hold of the letters A, C, G and T.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from helixframe.functions import sequence as seqf
from helixframe.functions.ids import spelled
from helixframe.operators import candidates, coding
from helixframe.operators import sequences as sq
from helixframe.operators import transcripts as tx
from helixframe.operators.coding_potential import KMERS, CodingPotential, coding_potential, frames_of_sequences, frames_of_transcripts, learning_parts
from helixframe.operators.pipeline import annotate
from helixframe.session import scratch_path, shared_checkpoint
from helixframe.sources.annotation import write_routed
from helixframe.sources.fasta import fasta_record, read_fasta

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def _query(sql: str | None = None) -> Callable:
    def add(f: Callable) -> Callable:
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


def _seqs(spark: SparkSession, d: str) -> DataFrame:
    docs = spark.read.parquet(f"{d}/documents.parquet")
    # A generated column is worked out once, where the letters would be picked for each use of them.
    letters = F.explode(F.array(F.regexp_replace(F.upper("text"), "[^ACGT]+", ""))).alias("seq")
    return docs.select(F.concat(F.lit("S"), "doc_id").alias("name"), F.coalesce("lang", F.lit("")).alias("lang"), letters).where(F.length("seq") >= 3)


SEQS = "seqs as (select 'S' || doc_id as name, coalesce(lang, '') lang, regexp_replace(upper(text), '[^ACGT]', '', 'g') seq from documents where length(regexp_replace(upper(text), '[^ACGT]', '', 'g')) >= 3)"


@_query(f"with {SEQS} select name, reverse(translate(seq, 'ACGT', 'TGCA')) rc from seqs")
def revcomp(spark: SparkSession, d: str) -> DataFrame:
    return _seqs(spark, d).select("name", seqf.reverse_complement(F.col("seq")).alias("rc"))


@_query(f"with {SEQS} select name, round(length(regexp_replace(seq, '[^GC]', '', 'g')) * 100.0 / length(seq), 6) gc from seqs")
def gc_content(spark: SparkSession, d: str) -> DataFrame:
    return _seqs(spark, d).select("name", F.round(seqf.gc_percent(F.col("seq")), 6).alias("gc"))


@_query("select doc_id, case when length(text) > 0 then cast(floor(length(regexp_replace(text, '[^Nn]', '', 'g')) * 100.0 / length(text)) as int) else -1 end n_percent from documents")
def n_fraction(spark: SparkSession, d: str) -> DataFrame:
    return spark.read.parquet(f"{d}/documents.parquet").select("doc_id", seqf.n_percent(F.col("text")).alias("n_percent"))


def _features(spark: SparkSession, d: str) -> DataFrame:
    """On each sequence, as a chromosome, a transcript of an exon of 60 letters in every 100."""
    at = F.explode(F.sequence(F.lit(0), F.floor(F.length("seq") / 100).cast("int")))
    rows = _seqs(spark, d).select("name", F.length("seq").alias("n"), at.alias("i"))
    return rows.select(F.col("name").alias("chr"), F.concat(F.lit("T"), "name").alias("transcript_id"), F.when(F.col("n") % 2 == 0, "+").otherwise("-").alias("strand"), (F.col("i") * 100 + 1).alias("start"), F.least("n", F.col("i") * 100 + 60).alias("end")).where("start <= end")


@_query(f"""with {SEQS}, p as (select name, length(seq) n, seq, unnest(range(0, cast(floor(length(seq) / 100) as bigint) + 1)) i from seqs),
  j as (select 'T' || name transcript_id, case when n % 2 = 0 then '+' else '-' end strand, string_agg(substr(seq, i * 100 + 1, 60), '' order by i) seq from p where substr(seq, i * 100 + 1, 60) <> '' group by all)
  select transcript_id, strand, case when strand = '-' then reverse(translate(seq, 'ACGT', 'TGCA')) else seq end seq from j""")
def cdna_concat(spark: SparkSession, d: str) -> DataFrame:
    chunks = sq.genome_chunks(_seqs(spark, d), "name", "seq", 256)
    return sq.cdna(_features(spark, d), chunks, 256)


_BEST = """
starts as (select name, length(seq) n, seq, unnest(range(1, length(seq) - 1)) s from seqs),
codons as (select name, n, s, substr(seq, s, 3) c from starts),
stops as (select name, s e from codons where c in ('TAA', 'TAG', 'TGA')),
begins as (select name, n, s, s + 3 place, c = 'ATG' atg from codons where c = 'ATG' union all select name, n, s, s, false from codons where s <= 3 and c not in ('TAA', 'TAG', 'TGA')),
ended as (select b.name, n, s, place, atg, min(e) e from begins b left join stops t on b.name = t.name and t.e > b.s and (t.e - b.s) % 3 = 0 group by all),
sized as (select *, e is not null stopped, case when e is not null then (e - s) // 3 + 1 else (n - s + 1) // 3 end codons, case when e is null and (n - s + 1) % 3 > 0 then 1 else 0 end more from ended)"""


def _orf_sql(kinds: dict[int, str], seqs: str = SEQS) -> str:
    """Kind -> which of the candidates it takes."""
    each = " union all ".join(f"select name, {k} kind, s, codons from (select *, row_number() over (partition by name order by codons + more desc, place) r from sized where {c}) where r = 1 and codons * 3 >= 6" for k, c in kinds.items())
    return f"with {seqs}, {_BEST}, tried as ({each}), won as (select * from tried qualify row_number() over (partition by name order by codons desc, kind) = 1) select name, kind orf_kind, s orf_start, codons * 3 orf_length, substr(seq, s, codons * 3) orf_seq, length(seq) rna_size from won join seqs using (name)"


_KINDS = {0: "atg and place <> s and stopped", 1: "atg and place <> s", 2: "stopped", 4: "true"}


@_query(_orf_sql({0: _KINDS[0]}))
def orf_type0(spark: SparkSession, d: str) -> DataFrame:
    return sq.orfs(_seqs(spark, d), 0)


@_query(_orf_sql({1: _KINDS[1]}))
def orf_type1(spark: SparkSession, d: str) -> DataFrame:
    return sq.orfs(_seqs(spark, d), 1)


@_query(_orf_sql({2: _KINDS[2]}))
def orf_type2(spark: SparkSession, d: str) -> DataFrame:
    return sq.orfs(_seqs(spark, d), 2)


@_query(_orf_sql({k: _KINDS[k] for k in (0, 1, 2)}))
def orf_type3(spark: SparkSession, d: str) -> DataFrame:
    return sq.orfs(_seqs(spark, d), 3)


@_query(_orf_sql(_KINDS))
def orf_type4(spark: SparkSession, d: str) -> DataFrame:
    return sq.orfs(_seqs(spark, d), 4)


@_query(f"select name, rna_size, orf_length, round(orf_length / rna_size, 6) orf_cover from ({_orf_sql({k: _KINDS[k] for k in (0, 1, 2)})})")
def orf_coverage(spark: SparkSession, d: str) -> DataFrame:
    return sq.orf_coverage(sq.orfs(_seqs(spark, d), 3)).withColumn("orf_cover", F.round("orf_cover", 6))


@_query(f"""with strict as ({_orf_sql({0: _KINDS[0]})}), relaxed as ({_orf_sql({k: _KINDS[k] for k in (0, 1, 2)})}),
  j as (select coalesce(r.name, s.name) as name, r.name is null or coalesce(s.orf_length / r.orf_length > 0.75, false) keep, r, s from relaxed r full join strict s on r.name = s.name)
  select name, case when keep then s.orf_kind else r.orf_kind end orf_kind, case when keep then s.orf_start else r.orf_start end orf_start, case when keep then s.orf_length else r.orf_length end orf_length from j""")
def orf_chosen(spark: SparkSession, d: str) -> DataFrame:
    seqs = _seqs(spark, d)
    return sq.chosen_orf(sq.orfs(seqs, 0), sq.orfs(seqs, 3)).select("name", "orf_kind", "orf_start", "orf_length")


_RNAS = f"""{SEQS.replace("seqs as", "dna as")}, p as (select name, length(seq) n, seq, unnest(range(0, cast(floor(length(seq) / 100) as bigint) + 1)) i from dna),
j as (select 'T' || name as name, n % 2 plus, string_agg(substr(seq, i * 100 + 1, 60), '' order by i) seq from p where substr(seq, i * 100 + 1, 60) <> '' group by all),
seqs as (select name, '' lang, case when plus = 0 then seq else reverse(translate(seq, 'ACGT', 'TGCA')) end seq from j)"""


@_query(f"""with orf as ({_orf_sql({k: _KINDS[k] for k in (0, 1, 2)}, _RNAS)}), {SEQS.replace("seqs as", "dna as")},
ex as (select 'T' || name transcript_id, name chr, case when n % 2 = 0 then '+' else '-' end strand, i * 100 + 1 s, least(n, i * 100 + 60) e from (select name, length(seq) n, unnest(range(0, cast(floor(length(seq) / 100) as bigint) + 1)) i from dna) where i * 100 + 1 <= n),
pl as (select *, coalesce(sum(e - s + 1) over (partition by transcript_id order by case when strand = '-' then -e else s end rows between unbounded preceding and 1 preceding), 0) + 1 f from ex),
u as (select pl.*, f + e - s l, unnest([{{'v': 'five_utr', 'a': 1, 'z': orf_start - 1}}, {{'v': 'CDS', 'a': orf_start, 'z': orf_start + orf_length - 1}}, {{'v': 'three_utr', 'a': orf_start + orf_length, 'z': 4611686018427387904}}]) k from pl join orf on orf.name = pl.transcript_id),
c as (select transcript_id, chr, strand, s, e, f, k.v feat_level, greatest(f, k.a) a, least(l, k.z) z from u)
select transcript_id, chr, strand, feat_level, cast(case when strand = '-' then e - (z - f) else s + a - f end as bigint) "start", cast(case when strand = '-' then e - (a - f) else s + z - f end as bigint) "end" from c where a <= z""")
def orf_on_genome(spark: SparkSession, d: str) -> DataFrame:
    """Coding and untranslated parts of the transcripts of `cdna_concat`, on their chromosomes."""
    cdna = cdna_concat(spark, d).select(F.col("transcript_id").alias("name"), "seq")
    return sq.genomic_parts(_features(spark, d), sq.orfs(cdna, 3)).select("transcript_id", "chr", "strand", "feat_level", F.col("start").cast("long").alias("start"), F.col("end").cast("long").alias("end"))


_CODONS = " ".join(f"when '{c}' then '{a}'" for c, a in seqf.codon_table().items())


@_query(f"with {SEQS}, c as (select name, i, case substr(seq, i * 3 + 1, 3) {_CODONS} end a from (select name, seq, unnest(range(0, length(seq) // 3)) i from seqs)) select name, string_agg(a, '' order by i) protein from c group by 1")
def translate_orf(spark: SparkSession, d: str) -> DataFrame:
    return _seqs(spark, d).select("name", seqf.translated(F.col("seq")).alias("protein"))


def _kmer_query(k: int, step: int) -> None:
    sql = f"with {SEQS} select kmer, count(*) n from (select substr(seq, unnest(range(1, length(seq) - {k} + 2, {step})), {k}) kmer from seqs) group by 1"

    def run(spark: SparkSession, d: str) -> DataFrame:
        return sq.kmer_counts(_seqs(spark, d), k, step)

    run.__name__ = f"kmer_count_k{k}"
    _query(sql)(run)


for _k, _step in ((1, 1), (2, 1), (3, 3), (6, 3)):
    _kmer_query(_k, _step)

_FRAMES = f"{SEQS}, f as materialized ({_orf_sql({k: _KINDS[k] for k in (0, 1, 2)})})"


def _models(k: int) -> str:
    s = 3 if k >= 3 else 1
    return f"""c{k} as (select kmer, count(*) * 1.0 / sum(count(*)) over () fc from (select substr(orf_seq, unnest(range(1, length(orf_seq) - {k} + 2, {s})), {k}) kmer from f join seqs using (name) where lang = 'en') group by 1),
  n{k} as (select kmer, count(*) * 1.0 / sum(count(*)) over () fn from (select substr(seq, unnest(range(1, length(seq) - {k} + 2)), {k}) kmer from seqs where lang <> 'en') group by 1),
  m{k} as (select kmer, coalesce(fc, 0) / (coalesce(fc, 0) + coalesce(fn, 0)) ratio from c{k} full join n{k} using (kmer)),
  s{k} as (select name, sum(coalesce(ratio, 0.5)) / count(*) score from (select name, substr(orf_seq, unnest(range(1, length(orf_seq) - {k} + 2, {s})), {k}) kmer from f) left join m{k} using (kmer) group by 1)"""


def _model(spark: SparkSession, d: str, k: int) -> DataFrame:
    """Reading frames of English texts against all letters of the others."""
    seqs = _seqs(spark, d)
    frames = sq.orfs(seqs.where("lang = 'en'"), 3).select("name", F.col("orf_seq").alias("seq"))
    return sq.kmer_model(frames, seqs.where("lang <> 'en'"), k)


@_query(f"with {_FRAMES}, {_models(3)} select kmer, round(ratio, 6) ratio from m3")
def kmer_ratio_model(spark: SparkSession, d: str) -> DataFrame:
    return _model(spark, d, 3).withColumn("ratio", F.round("ratio", 6))


@_query(f"with {_FRAMES}, {_models(3)} select name, round(score, 6) score from s3")
def kmer_score(spark: SparkSession, d: str) -> DataFrame:
    frames = sq.orfs(_seqs(spark, d), 3).select("name", F.col("orf_seq").alias("seq"))
    return sq.kmer_scores(frames, _model(spark, d, 3), 3).withColumn("score", F.round("score", 6))


_SCORES = ", ".join(f"round(s{k}.score, 6) kmer_score_{k}" for k in KMERS)


@_query(f"with {_FRAMES}, {', '.join(_models(k) for k in KMERS)} select name, {_SCORES}, round(orf_length / rna_size, 6) orf_cover, rna_size from f {' '.join(f'left join s{k} using (name)' for k in KMERS)}")
def feature_matrix(spark: SparkSession, d: str) -> DataFrame:
    seqs = _seqs(spark, d)
    found = sq.orfs(seqs, 3)
    english = found.join(seqs.where("lang = 'en'").select("name"), "name", "left_semi").select(F.col("orf_seq").alias("seq"))
    out = sq.feature_matrix(found, sq.kmer_models(english, seqs.where("lang <> 'en'").select("seq"), KMERS), KMERS)
    return out.select("name", *[F.round(c, 6).alias(c) for c in out.columns if c not in ("name", "rna_size")], "rna_size")


_EACH = " union all ".join(f"select {k} k, kmer, round(ratio, 6) ratio from m{k}" for k in KMERS)


@_query(f"with {_FRAMES}, {', '.join(_models(k) for k in KMERS)} {_EACH}")
def kmer_ratio_models(spark: SparkSession, d: str) -> DataFrame:
    """The models of all lengths at once."""
    seqs = _seqs(spark, d)
    english = sq.orfs(seqs.where("lang = 'en'"), 3).select(F.col("orf_seq").alias("seq"))
    return sq.kmer_models(english, seqs.where("lang <> 'en'").select("seq"), KMERS).withColumn("ratio", F.round("ratio", 6))


@_query(f"""with {SEQS}, p as (select name, length(seq) n, seq, unnest(range(0, cast(floor(length(seq) / 100) as bigint) + 1)) i from seqs),
  j as (select 'T' || name as name, n % 2 plus, string_agg(substr(seq, i * 100 + 1, 60), '' order by i) seq, string_agg(substr(seq, i * 100 + 1, 30), '' order by i) orf_seq from p where substr(seq, i * 100 + 1, 60) <> '' group by all),
  t as (select name, case when plus = 0 then seq else reverse(translate(seq, 'ACGT', 'TGCA')) end seq, case when plus = 0 then orf_seq else reverse(translate(orf_seq, 'ACGT', 'TGCA')) end orf_seq from j)
  select name, orf_seq, length(orf_seq) orf_length, length(seq) rna_size from t where length(orf_seq) >= {2 * max(KMERS)}""")
def annotated_frames(spark: SparkSession, d: str) -> DataFrame:
    """Frames of the transcripts of `cdna_concat` where the first 30 letters of each exon are annotated as coding."""
    exons = _features(spark, d).withColumn("feat_level", F.lit("exon"))
    parts = exons.withColumn("feat_level", F.lit("CDS")).withColumn("end", F.least("end", F.col("start") + 29))
    chunks = sq.genome_chunks(_seqs(spark, d), "name", "seq", 256)
    return frames_of_transcripts(exons.unionByName(parts), chunks, chunk=256).select("name", "orf_seq", "orf_length", "rna_size")


# Coding potential, over the forest's result table and the registry --------------------------


def _scored(spark: SparkSession, d: str) -> DataFrame:
    """(name, score, truth): each transcript once, truth 1 for those registered as protein coding."""
    rf = spark.read.parquet(f"{d}/rf_result.parquet").groupBy(spelled(F.col("tx_name")).alias("name")).agg(F.max("coding_potential").alias("score"))
    known = spark.read.parquet(f"{d}/transcripts.parquet").groupBy(spelled(F.col("transcript_id")).alias("name")).agg(F.max((F.col("biotype") == "protein_coding").cast("int")).alias("truth"))
    return rf.join(known, "name")


SCORED = """rf as (select upper(trim(tx_name)) as name, max(coding_potential) score from rf_result group by 1),
known as (select upper(trim(transcript_id)) as name, cast(max(cast(biotype = 'protein_coding' as int)) as int) truth from transcripts group by 1),
scored as (select name, score, truth from rf join known using (name)),
h as (select *, cast('0x' || substr(md5(name || '|1'), 1, 12) as bigint) h from scored)"""
FOLDS = f"""{SCORED}, folds as (select name, score, truth, cast(ceil(10.0 * row_number() over (order by h, name) / count(*) over ()) as int) fold from h)"""
CURVE = f"""{FOLDS}, g as (select fold, score cutoff, count(*) filter (truth = 1) c1, count(*) filter (truth = 0) c0 from folds where score is not null and truth is not null group by all),
curve as (select fold, cutoff, cast(sum(c1) over u as bigint) tp, cast(sum(c0) over u as bigint) fp, cast(sum(c1) over (partition by fold) as bigint) p, cast(sum(c0) over (partition by fold) as bigint) n from g window u as (partition by fold order by cutoff desc rows unbounded preceding)),
rates as (select *, tp / nullif(p, 0) sensitivity, 1 - fp / nullif(n, 0) specificity from curve),
bal as (select fold, cutoff from rates qualify row_number() over (partition by fold order by round(abs(sensitivity - specificity), 12) nulls last, cutoff desc) = 1)"""


@_query(f"with {SCORED} select name, truth, case when row_number() over (partition by truth order by h, name) <= floor(count(*) over (partition by truth) * 0.1) then 'model' else 'forest' end part from h")
def hash_split_10_90(spark: SparkSession, d: str) -> DataFrame:
    return coding.holdout_split(_scored(spark, d), "name", "truth").select("name", "truth", "part")


@_query(f"with {FOLDS} select name, fold from folds")
def cv_folds(spark: SparkSession, d: str) -> DataFrame:
    return coding.cv_folds(_scored(spark, d), "name").select("name", "fold")


def _curve(spark: SparkSession, d: str) -> DataFrame:
    return coding.cutoff_curve(coding.cv_folds(_scored(spark, d), "name"))


@_query(f"with {CURVE} select fold, cutoff, tp, fp, p, n, round(sensitivity, 6) sensitivity, round(specificity, 6) specificity from rates")
def cv_cutoff_curve(spark: SparkSession, d: str) -> DataFrame:
    return _curve(spark, d).withColumn("sensitivity", F.round("sensitivity", 6)).withColumn("specificity", F.round("specificity", 6))


@_query(f"with {CURVE} select fold, cutoff from bal")
def cv_cutoffs(spark: SparkSession, d: str) -> DataFrame:
    return coding.balanced_cutoffs(_curve(spark, d))


_METRICS = """tp, tn, fp, fn, round(tp / nullif(tp + fn, 0), 6) sen, round(tn / nullif(tn + fp, 0), 6) spe, round(tp / nullif(tp + fp, 0), 6) pre, round((tp + tn) / nullif(tp + tn + fp + fn, 0), 6) acc,
  round(2 * tp / nullif(2 * tp + fp + fn, 0), 6) f1, round((cast(tp as double) * tn - cast(fp as double) * fn) / nullif(sqrt(cast(tp + fp as double) * (tp + fn) * (tn + fp) * (tn + fn)), 0), 6) mcc"""
_COUNTS = "count(*) filter (truth = 1 and label = 1) tp, count(*) filter (truth = 0 and label = 0) tn, count(*) filter (truth = 0 and label = 1) fp, count(*) filter (truth = 1 and label = 0) fn"


@_query(f"with {CURVE}, l as (select folds.*, cast(score >= cutoff as int) label from folds join bal using (fold)), c as (select fold, {_COUNTS} from l where truth in (0, 1) and label in (0, 1) group by 1) select fold, {_METRICS} from c")
def confusion_metrics(spark: SparkSession, d: str) -> DataFrame:
    folded = shared_checkpoint(coding.cv_folds(_scored(spark, d), "name"))
    judged = coding.labelled(folded.join(coding.balanced_cutoffs(coding.cutoff_curve(folded)), "fold"), F.col("cutoff"))
    return coding.confusion(judged, ["fold"])


@_query(f"with {CURVE}, l as (select folds.*, cast(score >= (select avg(cutoff) from bal) as int) label from folds), c as (select {_COUNTS} from l where truth in (0, 1) and label in (0, 1)) select {_METRICS} from c")
def f1_mcc(spark: SparkSession, d: str) -> DataFrame:
    scored = shared_checkpoint(_scored(spark, d))
    cutoff = coding.balanced_cutoffs(coding.cutoff_curve(coding.cv_folds(scored, "name"))).agg(F.avg("cutoff")).scalar()
    return coding.confusion(coding.labelled(scored, cutoff), [])


_TWO = f"""{CURVE}, ml as (select fold, min(cutoff) filter (specificity >= 0.95) m, max(cutoff) filter (sensitivity >= 0.95) l from rates group by 1),
mean as (select avg(m) m, avg(l) l, avg(cutoff) b from ml join bal using (fold)), two as (select case when m > l then m else b end hi, case when m > l then l else b end lo from mean),
lab as (select name, case when score >= hi then 1 when score < lo then 0 when score is not null then -1 end as label from scored, two)"""


def _two(spark: SparkSession, d: str) -> DataFrame:
    scored = shared_checkpoint(_scored(spark, d))
    cutoffs = coding.two_cutoffs(coding.cutoff_curve(coding.cv_folds(scored, "name")), 0.95, 0.95)
    return coding.labelled(scored, cutoffs.select("coding_cutoff").scalar(), cutoffs.select("noncoding_cutoff").scalar())


@_query(f"with {_TWO} select name, label from lab")
def two_threshold_labels(spark: SparkSession, d: str) -> DataFrame:
    return _two(spark, d).select("name", "label")


@_query(f"""with {_TWO}, t as (select distinct upper(trim(transcript_id)) as name from transcripts)
  select case label when 0 then 'lncRNA' when 1 then 'mRNA' when -1 then 'TUCp' else 'noORF' end class, count(*) n from t left join lab using (name) group by 1""")
def route_by_label(spark: SparkSession, d: str) -> DataFrame:
    names = spark.read.parquet(f"{d}/transcripts.parquet").select(spelled(F.col("transcript_id")).alias("name")).distinct()
    return coding.routed(names, _two(spark, d), "name").groupBy("class").agg(F.count("*").alias("n"))


@_query(f"with {SCORED} select name, score, truth from h order by h, name limit 200")
def training_cap(spark: SparkSession, d: str) -> DataFrame:
    """The first 200 transcripts to learn from, in hash order."""
    return coding.capped(_scored(spark, d), "name", 200, least=1)


@_query("select label, count(*) n from rf_result group by 1")
def label_counts(spark: SparkSession, d: str) -> DataFrame:
    return spark.read.parquet(f"{d}/rf_result.parquet").groupBy("label").agg(F.count("*").alias("n"))


FEATURES = ["kmerscore_3mer", "kmerscore_6mer", "kmerscore_9mer", "orf_cover", "rna_size"]


def _matrix(spark: SparkSession, d: str) -> DataFrame:
    """(name, features, truth): as `_scored`, with the features a forest learns from."""
    rf = spark.read.parquet(f"{d}/rf_result.parquet").groupBy(spelled(F.col("tx_name")).alias("name")).agg(*[F.max(c).alias(c) for c in FEATURES])
    return rf.join(_scored(spark, d).select("name", "truth"), "name")


@_query()
def rf_predict(spark: SparkSession, d: str) -> DataFrame:
    """Nine of ten transcripts scored by a forest that has learnt from the others alone."""
    parts = coding.holdout_split(_matrix(spark, d), "name", "truth")
    return coding.forest_predictions(parts.where("part = 'model'"), parts.where("part = 'forest'"), FEATURES, "truth").select("name", F.round("score", 6).alias("score"))


@_query()
def rf_cross_validation(spark: SparkSession, d: str) -> DataFrame:
    """Metrics of each fold, judged by forests on the other folds at the mean of their cutoffs, and their mean."""
    scored = shared_checkpoint(coding.cross_validated(_matrix(spark, d), "name", FEATURES, "truth"))
    cutoff = coding.balanced_cutoffs(coding.cutoff_curve(scored.select("fold", "score", "truth"))).agg(F.avg("cutoff")).scalar()
    return coding.with_mean(coding.confusion(coding.labelled(scored, cutoff), ["fold"]))


@_query()
def rf_importances(spark: SparkSession, d: str) -> DataFrame:
    return coding.feature_importances(_matrix(spark, d), FEATURES, "truth")


_MEANS = ", ".join(f"round(avg({c}), 6) {c}" for c in coding.METRICS)


@_query(f"""with {CURVE}, l as (select folds.*, cast(score >= (select avg(cutoff) from bal) as int) label from folds), c as (select fold, {_COUNTS} from l where truth in (0, 1) and label in (0, 1) group by 1),
  m as (select cast(fold as varchar) fold, {_METRICS} from c) select fold, {', '.join(f'cast({c} as double) {c}' for c in coding.METRICS)} from m union all select 'mean', {_MEANS} from m""")
def metrics_with_mean(spark: SparkSession, d: str) -> DataFrame:
    folded = shared_checkpoint(coding.cv_folds(_scored(spark, d), "name"))
    cutoff = coding.balanced_cutoffs(coding.cutoff_curve(folded)).agg(F.avg("cutoff")).scalar()
    return coding.with_mean(coding.confusion(coding.labelled(folded, cutoff), ["fold"]))


@_query(f"with {_TWO} select round((select hi from two), 6) coding_cutoff, round((select lo from two), 6) noncoding_cutoff, count(*) filter (label = 0) n_lncrna, count(*) filter (label = 1) n_mrna, count(*) filter (label = -1) n_tucp, count(*) filter (label is null) n_unlabelled from lab")
def label_summary(spark: SparkSession, d: str) -> DataFrame:
    scored = shared_checkpoint(_scored(spark, d))
    cutoffs = coding.two_cutoffs(coding.cutoff_curve(coding.cv_folds(scored, "name")), 0.95, 0.95)
    high, low = cutoffs.select("coding_cutoff").scalar(), cutoffs.select("noncoding_cutoff").scalar()
    return coding.label_summary(coding.labelled(scored, high, low), F.round(high, 6), F.round(low, 6))


# The second stage whole: English sequences as coding, German ones as not, all others as candidates ---


def _learn_and_test(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    seqs = shared_checkpoint(_seqs(spark, d))
    others = seqs.where("lang not in ('en', 'de')")
    return *(frames_of_sequences(x) for x in (seqs.where("lang = 'en'"), seqs.where("lang = 'de'"), others)), others.select("name")


_LONG = f"{SEQS}, f as materialized ({_orf_sql({k: _KINDS[k] for k in (0, 1, 2)}).replace('codons * 3 >= 6', f'codons * 3 >= {2 * max(KMERS)}')})"
_PARTS = f"""{_LONG}, both_sides as (select name, case lang when 'en' then 1 else 0 end truth, cast('0x' || substr(md5(name || '|1'), 1, 12) as bigint) h from f join seqs using (name) where lang in ('en', 'de')),
parts as (select name, truth, case when row_number() over (partition by truth order by h, name) <= floor(count(*) over (partition by truth) * 0.1) then 'model' else 'forest' end part from both_sides)"""


@_query(f"with {_PARTS} select * from parts")
def codpot_parts(spark: SparkSession, d: str) -> DataFrame:
    """Which sequences make the k-mer models and which the forest."""
    coding_frames, other_frames, *_ = _learn_and_test(spark, d)
    return learning_parts(coding_frames, other_frames).select("name", "truth", "part")


@_query(f"with {_LONG} select name, seq, orf_seq, orf_length, rna_size from f join seqs using (name)")
def sequence_frames(spark: SparkSession, d: str) -> DataFrame:
    """Sequences with a frame of at least twice the longest k-mer."""
    return frames_of_sequences(_seqs(spark, d))


@_query(f"with {_LONG} select name, case when f.name is null then 'noORF' else 'scored' end class from (select name from seqs where lang not in ('en', 'de')) left join f using (name)")
def codpot_reach(spark: SparkSession, d: str) -> DataFrame:
    """Which candidates have a frame to be scored by."""
    *_, test, names = _learn_and_test(spark, d)
    return names.join(test.select("name", F.lit("scored").alias("class")), "name", "left").withColumn("class", F.coalesce("class", F.lit("noORF")))


def _codpot(spark: SparkSession, d: str, **options: object) -> CodingPotential:
    coding_frames, other_frames, test, names = _learn_and_test(spark, d)
    return coding_potential(coding_frames, other_frames, test, names, least=2, **options)


@_query()
def codpot_classes(spark: SparkSession, d: str) -> DataFrame:
    """Every candidate's class, by the whole second stage."""
    return _codpot(spark, d).classes


@_query()
def codpot_report(spark: SparkSession, d: str) -> DataFrame:
    """Metrics of the folds and their mean, with the cutoffs and counts, where two specificities are asked for."""
    run = _codpot(spark, d, specificities=(0.95, 0.95))
    counts = run.summary.first().asDict()
    return run.metrics.select("*", *[F.lit(v).alias(k) for k, v in counts.items()])


# All three stages, on sequences as chromosomes: each has a known transcript in its first half, of
# English ones coding, of German ones not, and a candidate on the other strand in its second half.


def _placed(spark: SparkSession, d: str) -> DataFrame:
    """Exons of 90 letters in every 100, of the known transcripts (K...) and the candidates (C...)."""
    seqs = _seqs(spark, d).select("name", "lang", F.length("seq").alias("n")).where("n >= 400")
    at = F.explode(F.sequence(F.lit(0), F.floor(F.col("n") / 100).cast("int") - 1)).alias("i")
    rows = seqs.select("name", "lang", F.floor(F.col("n") / 200).alias("half"), at).withColumn("known", F.col("i") < F.col("half"))
    who = F.concat(F.when(F.col("known"), "K").otherwise("C"), "name")
    biotype = F.when(~F.col("known"), "candidate").when(F.col("lang") == "en", "protein_coding").otherwise("lincRNA")
    strand = F.when(F.col("known"), "+").otherwise("-")
    start = (F.col("i") * 100 + 1).cast("long")
    return rows.select(who.alias("transcript_id"), F.concat(F.lit("G"), who).alias("gene_id"), F.col("name").alias("chr"), strand.alias("strand"), biotype.alias("biotype"), F.lit("exon").alias("feat_level"), start.alias("start"), (start + 89).alias("end"), "lang")


@_query()
def pipeline_interactions(spark: SparkSession, d: str) -> DataFrame:
    """The best partner of each candidate that is left by the filter and classed as lncRNA."""
    placed = shared_checkpoint(_placed(spark, d))
    known = placed.where("biotype <> 'candidate'")
    chunks = sq.genome_chunks(_seqs(spark, d), "name", "seq").withColumnRenamed("name", "chr")
    run = annotate(placed.where("biotype = 'candidate'"), known, known.where("lang = 'de'"), chunks, sq.CHUNK, least=2)
    return run.interactions.where("is_best = 1").drop("is_best")


_PLACED = f"""{SEQS}, pl as (select *, i < half known from (select name, lang, floor(length(seq) / 200) half, unnest(range(0, cast(floor(length(seq) / 100) as bigint))) i from seqs where length(seq) >= 400)),
c as (select 'C' || name transcript_id, count(*) n_exons, count(*) * 90 size from pl where not known group by 1)"""


@_query(f"with {_PLACED} select transcript_id, n_exons, size, case when size < 200 then 'size' end drop_reason from c")
def pipeline_filtered(spark: SparkSession, d: str) -> DataFrame:
    """The first stage of the same; no candidate overlaps a known transcript of its own strand."""
    placed = shared_checkpoint(_placed(spark, d))
    ex, known = placed.where("biotype = 'candidate'"), placed.where("biotype = 'protein_coding'")
    return candidates.filter_candidates(ex, tx.transcript_rollup(ex), known, mono_exonic=-1).select("transcript_id", "n_exons", "size", "drop_reason")


@_query(f"with {SEQS} select name, length(seq) n_letters from seqs")
def sequence_sizes(spark: SparkSession, d: str) -> DataFrame:
    return _seqs(spark, d).select("name", F.length("seq").cast("long").alias("n_letters"))


@_query(f"with {SEQS} select name, chr(62) || name || chr(10) || seq as record from seqs")
def fasta_records(spark: SparkSession, d: str) -> DataFrame:
    rows = _seqs(spark, d)
    return rows.select("name", fasta_record().alias("record"))


@_query(f"with {SEQS} select name, seq from seqs")
def fasta_read(spark: SparkSession, d: str) -> DataFrame:
    """Sequences written as FASTA, with a `>` in each header and lines of 60 letters, and read again."""
    rows = _seqs(spark, d).select(F.concat("name", F.lit(" from->to lang=>"), "lang").alias("name"), F.array_join(sq.runs_of("seq", 60), "\n").alias("seq"))
    path = scratch_path(spark)
    rows.select(fasta_record().alias("value")).write.text(path)
    return read_fasta(spark, path)


@_query(f"with {SEQS} select case lang when 'en' then 'mRNA' else 'lncRNA' end class, name, seq from seqs")
def routed_fasta(spark: SparkSession, d: str) -> DataFrame:
    """Sequences written into a folder of FASTA records for each class, and read again."""
    path = scratch_path(spark)
    write_routed(_seqs(spark, d).withColumn("class", F.when(F.col("lang") == "en", "mRNA").otherwise("lncRNA")), path, fasta_record())
    parts = [read_fasta(spark, f"{path}/class={c}").select(F.lit(c).alias("class"), "name", "seq") for c in ("mRNA", "lncRNA")]
    return parts[0].unionByName(parts[1])


@_query(f"with {SEQS} select doc_id, round(length(regexp_replace(substr(text, 101, 200), '[^Nn]', '', 'g')) * 100.0 / greatest(1, length(substr(text, 101, 200))), 6) share from documents where length(text) > 100")
def n_fraction_of_region(spark: SparkSession, d: str) -> DataFrame:
    """The share of N in letters 101 to 300."""
    docs = spark.read.parquet(f"{d}/documents.parquet").where(F.length("text") > 100)
    return docs.select("doc_id", F.round(seqf.percent_of(F.substring("text", 101, 200), "N"), 6).alias("share"))


@_query(f"""with {SEQS} select name, left(seq, 3) = 'ATG' starts, right(seq, 3) in ('TAA', 'TAG', 'TGA') stops from seqs""")
def start_and_stop(spark: SparkSession, d: str) -> DataFrame:
    return _seqs(spark, d).select("name", seqf.has_start(F.col("seq")).alias("starts"), seqf.has_stop(F.col("seq")).alias("stops"))
