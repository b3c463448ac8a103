"""Named queries of the general data-preparation operators, and the SQL they are checked against."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from helixframe.functions.ids import names_something, spelled
from helixframe.operators.interval_merge import merge_intervals
from helixframe.operators.key_balance import ordered_key_stats
from helixframe.operators.orphans import Parent, Referrer, orphan_references, orphan_report
from helixframe.operators.packed_fields import packed_members
from helixframe.operators.row_validation import bad_lines, clean_rows

PACKED_KEYS = ("oId", "nearest_ref", "tag")
DOMINANT_SHARE = 0.05


def _read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def _chr_stats(gtf: DataFrame) -> DataFrame:
    rows = gtf.select(spelled(F.col("chr")).alias("chr"), "row_id", "start_pos", "end_pos", (F.col("feat_level") == "exon").alias("is_exon"))
    return ordered_key_stats(rows, "chr", "row_id", "start_pos", "end_pos", "is_exon")


def p1_chr_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts, span, exon sum and steps back for every chr key."""
    return _chr_stats(_read(spark, sf_dir, "gtf")).select(F.col("key").alias("chr"), "n_rows", "span_start", "span_end", F.col("n_counted").alias("n_exons"), F.col("counted_sum").alias("exon_sum"), "n_back")


def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """chr keys with at least DOMINANT_SHARE of the rows whose chr isn't null."""
    gtf = _read(spark, sf_dir, "gtf")
    total = gtf.agg(F.count("chr")).scalar()
    return _chr_stats(gtf).where((F.col("n_rows") >= DOMINANT_SHARE * total) & names_something(F.col("key"))).select(F.col("key").alias("chr"))


def _orphans(spark: SparkSession, sf_dir: str) -> DataFrame:
    gtf = Referrer("gtf", _read(spark, sf_dir, "gtf"), "row_id", "loaded_at", {"chr": "chromosomes", "transcript_id": "transcripts"})
    inter = Referrer("interactions", _read(spark, sf_dir, "interactions"), "inter_id", "run_at", {"lncrna_transcript": "transcripts", "partnerrna_transcript": "transcripts"})
    return orphan_references(
        [gtf, inter],
        {
            "chromosomes": Parent(_read(spark, sf_dir, "chromosomes"), "chr", "added_at", "removed_at"),
            "transcripts": Parent(_read(spark, sf_dir, "transcripts"), "transcript_id", "registered_at", "deleted_at"),
        },
    )


def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every reference without a record valid at the time of its row."""
    return _orphans(spark, sf_dir).select("tbl", "row_id", "ref_field", "kind")


def p2_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orphans per table, month, field and kind."""
    return orphan_report(_orphans(spark, sf_dir))


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bad GTF lines with the first reason that applies."""
    return bad_lines(_read(spark, sf_dir, "gtf_lines"))


def p3_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The good GTF lines as typed rows."""
    return clean_rows(_read(spark, sf_dir, "gtf_lines"))


def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The members packed in oId, nearest_ref and tag, one a row."""
    return packed_members(_read(spark, sf_dir, "gtf"), "row_id", "attributes", PACKED_KEYS)


def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Blocks and gaps of the exons of each transcript."""
    tx = spelled(F.col("transcript_id"))
    exons = _read(spark, sf_dir, "gtf").where((F.col("feat_level") == "exon") & names_something(tx)).select(tx.alias("transcript_id"), "start_pos", "end_pos")
    return merge_intervals(exons, "transcript_id", "start_pos", "end_pos").withColumnRenamed("entity", "transcript_id")


QUERIES = {f.__name__: f for f in (p1_found, p1_chr_stats, p2_found, p2_report, p3_found, p3_clean, p4_found, p5_found)}

_ORPHANS = """
refs as (
  select 'gtf' tbl, row_id, 'chr' ref_field, 'c' parent, upper(trim(chr)) id, loaded_at t from gtf
  union all select 'gtf', row_id, 'transcript_id', 't', upper(trim(transcript_id)), loaded_at from gtf
  union all select 'interactions', inter_id, 'lncrna_transcript', 't', upper(trim(lncrna_transcript)), run_at from interactions
  union all select 'interactions', inter_id, 'partnerrna_transcript', 't', upper(trim(partnerrna_transcript)), run_at from interactions),
records as (
  select distinct 'c' parent, upper(trim(chr)) id, added_at a, removed_at z from chromosomes
  union select distinct 't', upper(trim(transcript_id)), registered_at, deleted_at from transcripts),
judged as (
  select tbl, row_id, ref_field, t, count(r.id) n, coalesce(bool_or(a <= t and (z is null or t < z)), false) ok, coalesce(bool_or(z <= t), false) gone
  from refs left join records r using (parent, id) where id not in ('', '.') group by all),
orphans as (
  select tbl, row_id, ref_field, t, case when n = 0 then 'missing' when gone then 'deleted' else 'late' end kind from judged where not ok)
"""
_LINES = """
lines as (
  select line_id, regexp_replace(line, '\\r+$', '') line from gtf_lines),
cut as (
  select *, string_split(line, chr(9)) c, regexp_extract_all(string_split(line, chr(9))[9], '[^\\s;"]+\\s+(?:"[^"]*"|[^;"]*)') p from lines where trim(line) <> '' and line not like '#%' and line not like 'track%'),
judged as (
  select line_id, c, p, case
    when len(c) <> 9 then 'columns'
    when c[8] not in ('0', '1', '2', '.') then 'frame'
    when not regexp_full_match(c[9], '(\\s*;)*\\s*([^\\s";]+\\s+("[^"]*"|[\\pL\\pN._:-]+)\\s*;[\\s;]*)*([^\\s";]+\\s+("[^"]*"|[\\pL\\pN._:-]+)\\s*)?') then 'quoting'
    when not coalesce(list_bool_or(list_transform(p, lambda x: regexp_matches(x, '^gene_id\\s+("\\s*[^"\\s]|[^"\\s])'))), false)
      or (c[3] <> 'gene' and not coalesce(list_bool_or(list_transform(p, lambda x: regexp_matches(x, '^transcript_id\\s+("\\s*[^"\\s]|[^"\\s])'))), false)) then 'ids'
    end reason from cut)
"""

SQL = {
    "p1_found": "select upper(trim(chr)) chr from gtf where chr is not null group by 1 having count(*) >= 0.05 * (select count(chr) from gtf) and upper(trim(chr)) not in ('', '.')",
    "p1_chr_stats": """
      with r as (select upper(trim(chr)) chr, row_id, start_pos s, end_pos e, feat_level = 'exon' x from gtf where chr is not null),
      b as (select *, s < lag(s ignore nulls) over (partition by chr order by row_id) back from r)
      select chr, count(*) n_rows, min(s) span_start, max(e) span_end, count(*) filter (x) n_exons,
        cast(coalesce(sum(e - s + 1) filter (x and s <= e), 0) as bigint) exon_sum, count(*) filter (back) n_back from b group by chr""",
    "p2_found": f"with {_ORPHANS} select tbl, row_id, ref_field, kind from orphans",
    "p2_report": f"with {_ORPHANS} select tbl, strftime(t, '%Y-%m') as month, ref_field, kind, count(*) n from orphans group by all",
    "p3_found": f"with {_LINES} select line_id, reason from judged where reason is not null",
    "p3_clean": f"""with {_LINES} select line_id, c[1] chr, c[2] source, c[3] feat_level, try_cast(c[4] as bigint) start_pos, try_cast(c[5] as bigint) end_pos,
      try_cast(c[6] as double) score, c[7] strand, c[8] frame, c[9] attributes,
      trim(regexp_replace(list_filter(p, lambda x: regexp_matches(x, '^gene_id\\s'))[-1], '^\\S+\\s+', ''), '"') gene_id,
      trim(regexp_replace(list_filter(p, lambda x: regexp_matches(x, '^transcript_id\\s'))[-1], '^\\S+\\s+', ''), '"') transcript_id
      from judged where reason is null""",
    "p4_found": r"""
      with pairs as (select row_id, unnest(regexp_extract_all(attributes, '[^\s;"]+\s+(?:"[^"]*"|[^;"]*)')) p, unnest(range(10000)) o from gtf where attributes is not null),
      kept as (select row_id, o, regexp_extract(p, '^\S+') attr_key, p from pairs where regexp_extract(p, '^\S+') in ('oId', 'nearest_ref', 'tag')),
      members as (select row_id, o, attr_key, unnest(m) val, unnest(range(1, len(m) + 1)) i from (
        select row_id, o, attr_key, regexp_extract_all(trim(regexp_replace(p, '^\S+\s+', ''), '"'), '''[^'']*''|[A-Za-z0-9._:-][A-Za-z0-9._:''-]*') m from kept))
      select row_id, attr_key, cast(row_number() over (partition by row_id, attr_key order by o, i) as int) pos, trim(val, '''') val from members where trim(val, ''' ') <> ''""",
    "p5_found": """
      with x as (select upper(trim(transcript_id)) transcript_id, start_pos s, end_pos e from gtf where feat_level = 'exon' and start_pos <= end_pos and upper(trim(transcript_id)) not in ('', '.')),
      m as (select *, max(e) over (partition by transcript_id order by s, e rows between unbounded preceding and 1 preceding) r from x),
      i as (select *, sum(case when r is null or s > r + 1 then 1 else 0 end) over (partition by transcript_id order by s, e rows unbounded preceding) g from m),
      b as (select transcript_id, g, min(s) s, max(e) e from i group by all),
      n as (select *, lead(s) over (partition by transcript_id order by s) nx from b)
      select transcript_id, 'block' kind, s seg_start, e seg_end from b union all select transcript_id, 'gap', e + 1, nx - 1 from n where nx is not null""",
}
