"""Reference operators on small hand-made and random cases."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from helixframe import session
from helixframe.functions import intervals as iv
from helixframe.functions import sequence as seqf
from helixframe.operators import candidates, classify, coding, coding_potential, forest, gene_level, sequences, transcripts
from helixframe.operators.range_join import range_join
from helixframe.plans import sequence as sequence_plans
from helixframe.plans.transcriptome import gtf_roundtrip
from helixframe.sources import annotation, fasta

EXON = "transcript_id string, gene_id string, chr string, strand string, biotype string, start long, end long"


def _exons(spark, rows):
    return spark.createDataFrame([(t, f"G{t}", "c", s, "b", a, z) for t, s, a, z in rows], EXON)


def test_range_join_equals_brute_force(spark):
    rng = random.Random(4)
    make = lambda n: [(i, rng.choice(["a", "b", None]), s := rng.choice([None, *range(-30, 200)]), s if s is None else s + rng.randint(-3, 60)) for i in range(n)]
    left, right = make(150), make(150)
    schema = "id int, k string, start long, end long"
    for slack in (0, 25):
        got = range_join(spark.createDataFrame(left, schema), spark.createDataFrame(right, schema), ["k"], slack, 16).select("l.id", F.col("r.id").alias("r")).collect()
        ok = lambda x: None not in x and x[2] <= x[3]
        want = [(a[0], b[0]) for a in left if ok(a) for b in right if ok(b) and a[1] == b[1] and a[2] - slack <= b[3] and b[2] <= a[3] + slack]
        assert sorted((r[0], r[1]) for r in got) == sorted(want)


def test_range_join_with_very_long_spans(spark):
    rng = random.Random(7)
    size = lambda: rng.choice([1, 30, 5000, 10**6, 2 * 10**9, 10**13])
    make = lambda n: [(i, rng.choice("ab"), s := rng.randint(-(10**6), 10**7), s + size()) for i in range(n)]
    left, right = make(120), make(120)
    schema = "id int, k string, start long, end long"
    for slack, width in ((0, 64), (100_000, 1 << 14)):
        got = range_join(spark.createDataFrame(left, schema), spark.createDataFrame(right, schema), ["k"], slack, width)
        want = [(a[0], b[0]) for a in left for b in right if a[1] == b[1] and a[2] - slack <= b[3] and b[2] <= a[3] + slack]
        assert sorted(tuple(r) for r in got.select("l.id", F.col("r.id").alias("r")).collect()) == sorted(want)
    none = spark.createDataFrame([], schema)
    assert range_join(none, none, ["k"]).count() == 0 and range_join(spark.createDataFrame(left, schema), none, ["k"]).count() == 0


def test_interval_functions(spark):
    df = spark.createDataFrame([(1, 5, 4, 9, "+", "-"), (1, 5, 6, 9, "+", "+"), (1, 5, 9, 9, ".", "+")], "b1 int, e1 int, b2 int, e2 int, s1 string, s2 string")
    c = [F.col(x) for x in ("b1", "e1", "b2", "e2")]
    s = F.col("s1"), F.col("s2")
    got = df.select(iv.overlaps(*c), iv.overlap_size(*c), iv.gap_distance(*c), iv.strands_agree(*s, 0), iv.strands_agree(*s, 1), iv.strands_agree(*s, -1)).collect()
    assert [tuple(r) for r in got] == [(True, 2, 0, True, False, True), (False, 0, 1, True, True, False), (False, 0, 4, True, False, False)]


def test_filter_rules_and_monoexonic_modes(spark):
    ex = _exons(spark, [("short", "+", 1, 50), ("mono", "+", 1000, 1500), ("anti", "-", 2000, 2400), ("bi", "+", 5000, 5200), ("bi", "+", 5300, 5310), ("ok", "+", 7000, 7200), ("ok", "+", 7300, 7400), ("hit", "+", 9000, 9200), ("hit", "+", 9300, 9400)])
    ann = _exons(spark, [("A", "+", 2100, 2200), ("B", "+", 9350, 9800), ("D", ".", 7000, 7400)])
    tx = transcripts.transcript_rollup(ex)
    reasons = lambda m: {r.transcript_id: r.drop_reason for r in candidates.filter_candidates(ex, tx, ann, mono_exonic=m).collect()}
    assert reasons(0) == {"short": "size", "mono": "mono_exonic", "anti": "mono_exonic", "bi": "bi_exonic", "ok": None, "hit": "overlap"}
    assert reasons(1)["mono"] is None and reasons(-1)["anti"] is None and reasons(-1)["mono"] == "mono_exonic"
    assert {r.transcript_id for r in candidates.unannotated(ex, tx, ann, 0.5).collect()} >= {"hit", "ok"}


def test_classification_geometry(spark):
    lnc = [("nested", "+", 120, 130), ("contains", "-", 50, 900), ("exonic", "+", 95, 105), ("down", "+", 1500, 1600), ("div", "-", 20, 40), ("far", "+", 900_000, 900_100)]
    mrna = [("M", "+", 100, 110), ("M", "+", 200, 300)]
    le, me = _exons(spark, lnc), _exons(spark, mrna)
    lt, mt = transcripts.transcript_rollup(le), transcripts.transcript_rollup(me)
    got = {r.lncrna_transcript: r for r in classify.interactions(lt, le, mt, me, 1000, 5000).collect()}
    kind = {k: (r.direction, r.rel_type, r.subtype, r.rel_location, r.distance) for k, r in got.items()}
    assert kind == {
        "nested": ("sense", "genic", "nested", "intronic", 0),
        "contains": ("antisense", "genic", "containing", "exonic", 0),
        "exonic": ("sense", "genic", "overlapping", "exonic", 0),
        "down": ("sense", "intergenic", "same_strand", "downstream", 1200),
        "div": ("antisense", "intergenic", "divergent", "upstream", 60),
    }
    assert [r[0] for r in classify.unmatched(lt, classify.interactions(lt, le, mt, me, 1000, 5000)).collect()] == ["far"]
    assert classify.neighbours(lt, mt, 1000, 500).count() == 0
    empty = classify.interactions(lt.limit(0), le.limit(0), mt, me)
    assert empty.count() == 0


def test_window_grows_only_until_a_hit(spark):
    lnc, near, far, farther = [("L", "+", 10_000, 10_100)], ("N", "+", 11_800, 11_900), ("F", "+", 11_950, 12_000), ("X", "+", 13_500, 13_600)
    lt, mt = (transcripts.transcript_rollup(_exons(spark, x)) for x in (lnc, [near, far, farther]))
    got = {(r.r.transcript_id, r.step) for r in classify.neighbours(lt, mt, 1000, 10_000).collect()}
    assert got == {("N", 2), ("F", 2)}


def test_structure_windows(spark):
    ex = _exons(spark, [("a", "-", 1, 10), ("a", "-", 13, 20), ("a", "-", 15, 40), ("a", "-", 100, 110), ("b", "-", 1, 10), ("b", "-", 13, 20), ("b", "-", 15, 40), ("b", "-", 100, 110)])
    assert {(r.start, r.end) for r in transcripts.introns(ex).where("transcript_id = 'a'").collect()} == {(11, 12), (41, 99)}
    assert {(r.start, r.end) for r in transcripts.merge_small_introns(ex, 5).where("transcript_id = 'a'").collect()} == {(1, 40), (100, 110)}
    assert [r.exon_number for r in transcripts.exon_ranks(ex).where("transcript_id = 'a'").orderBy("start").collect()] == [4, 3, 2, 1]
    assert [tuple(r) for r in transcripts.same_structure(ex).collect()] == [("b", "a")]


def test_transcript_with_most_rows(spark):
    rng = random.Random(4)
    rows = [("hot" if i % 3 else f"t{i % 40}", "-" if i % 2 else "+", s, s + rng.randint(0, 90)) for i, s in ((i, rng.randint(1, 300_000)) for i in range(1500))]
    gtf = spark.createDataFrame([(i, "exon", *r) for i, r in enumerate(rows)], "row_id long, feat_level string, transcript_id string, strand string, start_pos long, end_pos long").selectExpr("*", "'c' as chr", "'g' as gene_id", "'' as attributes")
    ex = transcripts.usable_exons(gtf)
    mine = {}
    for t, _, s, e in rows:
        mine.setdefault(t.upper(), set()).add((s, e))
    strands = {t.upper(): d for t, d, _, _ in rows}
    assert {(r.transcript_id, r.start, r.end, r.strand) for r in ex.collect()} == {(t, s, e, strands[t]) for t, xs in mine.items() for s, e in xs}
    ranks, gaps, wide = {}, set(), set()
    for t, xs in mine.items():
        order = sorted(xs, key=lambda x: (-x[1], -x[0])) if strands[t] == "-" else sorted(xs)
        ranks.update({(t, *x): n for n, x in enumerate(order, 1)})
        reach = begun = None
        for s, e in sorted(xs):
            if reach is not None and s > reach + 1:
                gaps.add((t, reach + 1, s - 1, s - reach - 1))
            if reach is None or s - reach - 1 >= 50:
                wide |= {(t, begun, reach)} if begun else set()
                begun = s
            reach = max(reach or 0, e)
        wide.add((t, begun, reach))
    assert {(r.transcript_id, r.start, r.end): r.exon_number for r in transcripts.exon_ranks(ex).collect()} == ranks
    assert {(r.transcript_id, r.start, r.end, r.size) for r in transcripts.introns(ex).collect()} == gaps
    assert {(r.transcript_id, r.start, r.end) for r in transcripts.merge_small_introns(ex, 50).collect()} == wide
    copy = ex.where("transcript_id = 'HOT'").withColumn("transcript_id", F.lit("AGAIN")).union(ex)
    assert [tuple(r) for r in transcripts.same_structure(copy.union(copy)).collect()] == [("HOT", "AGAIN")]
    assert all(f(ex.limit(0)).count() == 0 for f in (transcripts.introns, transcripts.merge_small_introns, transcripts.exon_ranks, transcripts.same_structure))


def test_sequence_functions(spark):
    df = spark.createDataFrame([("ATGGCNTAA",), ("",), (None,), ("AT",)], "s string")
    s = F.col("s")
    got = df.select(seqf.reverse_complement(s), seqf.translated(s), seqf.n_percent(s), seqf.has_start(s), seqf.has_stop(s)).collect()
    assert tuple(got[0]) == ("TTANGCCAT", "MX*", 11, True, True)
    assert (got[1][1], got[1][2], got[2][1], got[3][1]) == ("", -1, None, "")


def brute_orf(seq, need_start, need_stop):
    best = None
    stops = {"TAA", "TAG", "TGA"}
    begins = ([] if need_start else [i for i in range(3) if seq[i : i + 3] not in stops and i + 3 <= len(seq)]) + [i for i in range(len(seq) - 2) if seq[i : i + 3] == "ATG"]
    ends = [i for i in range(len(seq) - 2) if seq[i : i + 3] in stops]
    tail = [] if need_stop else [len(seq) - 3, len(seq) - 2, len(seq) - 1]
    for s in begins:
        later = [e for e in ends + tail if (e > s or (e == s and e in tail)) and (e - s) % 3 == 0]
        if later and (best is None or min(later) - s > best[0]):
            best = (min(later) - s, s)
    if best is None:
        return None
    text = seq[best[1] : best[1] + best[0] + 3]
    return best[1] + 1, len(text) // 3 * 3


def test_orfs_equal_brute_force(spark):
    rng = random.Random(6)
    seqs = ["".join(rng.choice("ACGT") for _ in range(rng.randint(3, 90))) for _ in range(250)]
    df = spark.createDataFrame([(str(i), s) for i, s in enumerate(seqs)] + [("null", None), ("none", "")], "name string, seq string")
    for kind, needs in sequences.KINDS.items():
        best = sequences._longest([*seqs, None, ""], [kind], 3)
        for i, s in enumerate(seqs):
            want = brute_orf(s, *needs)
            if kind < 4:
                assert (tuple(best[i]) if best[i][0] >= 0 else None) == (want and want[1] >= 3 and (kind, want[1], want[0]) or None), (kind, s)
        assert best[-1][0] == best[-2][0] == -1
    got = {r.name: (r.orf_kind, r.orf_length) for r in sequences.orfs(df, 3, 3).collect()}
    for i, s in enumerate(seqs):
        tried = [(w[1], -k) for k in (0, 1, 2) if (w := brute_orf(s, *sequences.KINDS[k]))]
        assert got.get(str(i)) == ((-max(tried)[1], max(tried)[0]) if tried else None)
    assert sequences.orfs(df.limit(0)).count() == 0


def test_frames_are_searched_once(spark):
    df = spark.createDataFrame([("a", "ATGAAATAA")], "name string, seq string")
    plan = sequences.orfs(df)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1


def test_very_long_sequences(spark):
    rng = random.Random(2)
    block = "".join(rng.choice("ACGT") for _ in range(1_000_003))
    df = spark.createDataFrame([("big", block)], "name string, seq string").select("name", F.repeat("seq", F.lit(8)).alias("seq"))
    chunks = sequences.genome_chunks(df, "name", "seq")
    n, letters, last = chunks.agg(F.count("*"), F.sum(F.length("chunk_seq")), F.max("chunk_no")).first()
    assert (letters, n, last) == (8 * len(block), -(-8 * len(block) // sequences.CHUNK), n - 1)
    assert sequences.kmer_counts(df, 2).agg(F.sum("n")).first()[0] == 8 * len(block) - 1
    assert sequences.orfs(df).first().rna_size == 8 * len(block)


def test_coding_parts(spark):
    rows = [("t", "exon", 1, 30), ("t", "CDS", 4, 9), ("t", "CDS", 20, 24), ("t", "stop_codon", 25, 27), ("t", "start_codon", 4, 6), ("u", "exon", 1, 9), ("v", "exon", 2, 8), ("v", "stop_codon", 4, 6)]
    f = spark.createDataFrame([(t, "c", "+", lv, a, z) for t, lv, a, z in rows], "transcript_id string, chr string, strand string, feat_level string, start long, end long")
    assert sorted((r.transcript_id, r.start, r.end) for r in sequences.coding_features(f).collect()) == [("t", 4, 9), ("t", 20, 27)]
    assert sorted((r.transcript_id, r.start) for r in sequences.rna_features(f).collect()) == [("t", 1), ("u", 1), ("v", 2)]


def test_cdna_over_chunks(spark):
    rng = random.Random(9)
    genome = "".join(rng.choice("ACGT") for _ in range(500))
    chunks = sequences.genome_chunks(spark.createDataFrame([("c", genome)], "id string, s string"), "id", "s", 64)
    feats = spark.createDataFrame([("p", "+", "c", 10, 200), ("p", "+", "c", 250, 260), ("m", "-", "c", 60, 70), ("m", "-", "c", 490, 900), ("x", "+", "nowhere", 1, 5)], "transcript_id string, strand string, chr string, start long, end long")
    got = {r.transcript_id: r.seq for r in sequences.cdna(feats, chunks, 64).collect()}
    back = (genome[59:70] + genome[489:]).translate(str.maketrans("ACGT", "TGCA"))[::-1]
    assert got == {"p": genome[9:200] + genome[249:260], "m": back}


def test_frames_on_the_genome(spark):
    for strand, want in (("+", {("five_utr", 10, 12), ("CDS", 13, 14), ("CDS", 21, 24), ("three_utr", 25, 29)}), ("-", {("five_utr", 27, 29), ("CDS", 21, 26), ("three_utr", 10, 14)})):
        ex = spark.createDataFrame([("t", "c", strand, 10, 14), ("t", "c", strand, 21, 29), ("u", "c", strand, 1, 5)], "transcript_id string, chr string, strand string, start long, end long")
        found = spark.createDataFrame([("t", 4, 6)], "name string, orf_start int, orf_length int")
        assert {(r.feat_level, r.start, r.end) for r in sequences.genomic_parts(ex, found).collect()} == want


def test_kmers_across_runs(spark):
    rng = random.Random(1)
    s = "".join(rng.choice("ACGT") for _ in range(3001))
    df = spark.createDataFrame([("a", s), ("b", "AC")], "name string, seq string")
    for k, step in ((3, 3), (6, 1), (2, 1)):
        want = sorted(s[i : i + k] for i in range(0, len(s) - k + 1, step)) + (["AC"] if k == 2 else [])
        assert sorted(r.kmer for r in sequences.kmers(df, k, step).collect()) == sorted(want)


def test_folds_and_split_sizes(spark):
    df = spark.range(95).selectExpr("concat('n', id) as name", "cast(id % 2 as int) as cls")
    sizes = sorted(r["count"] for r in coding.cv_folds(df, "name").groupBy("fold").count().collect())
    assert sum(sizes) == 95 and len(sizes) == 10 and sizes[0] >= 9 and sizes[-1] <= 10
    assert coding.holdout_split(df, "name", "cls").where("part = 'model'").count() == 4 + 4


def test_cutoffs_and_metrics(spark):
    rows = [(1, s, int(s > 0.5)) for s in (0.1, 0.2, 0.3, 0.6, 0.7, 0.9)] + [(1, None, 1)]
    df = spark.createDataFrame(rows, "fold int, score double, truth int")
    curve = coding.cutoff_curve(df)
    assert coding.balanced_cutoffs(curve).first().cutoff == 0.6
    m = coding.confusion(coding.labelled(df, 0.6), []).first()
    assert (m.tp, m.tn, m.fp, m.fn, m.mcc) == (3, 3, 0, 0, 1.0)
    two = coding.labelled(df, 0.7, 0.3).groupBy("label").count().collect()
    assert {r.label: r["count"] for r in two} == {1: 2, 0: 2, -1: 2, None: 1}


def test_cutoff_curve_in_blocks(spark):
    rng = random.Random(6)
    rows = [(i % 3 or None, rng.choice([0.5, rng.random(), rng.random()]), rng.choice([0, 1, 1, None])) for i in range(900)]
    df = spark.createDataFrame(rows, "fold int, score double, truth int")
    want = {}
    for fold in (1, 2, None):
        mine = [(s, t) for f, s, t in rows if f == fold and t is not None]
        for cut in {s for s, _ in mine}:
            want[fold, cut] = (sum(s >= cut and t == 1 for s, t in mine), sum(s >= cut and t == 0 for s, t in mine), sum(t for _, t in mine), sum(1 - t for _, t in mine))
    for blocks in (2, 16, 200):
        got = {(r.fold, r.cutoff): (r.tp, r.fp, r.p, r.n) for r in coding.cutoff_curve(df, blocks=blocks).collect()}
        assert got == want
    assert coding.cutoff_curve(df.limit(0)).count() == 0


def test_cross_validation(spark):
    rng = random.Random(9)
    rows = [(f"n{i}", rng.gauss(3 * (i % 2), 1) if i % 17 else None, rng.random(), i % 2) for i in range(240)]
    df = spark.createDataFrame(rows, "name string, a double, b double, truth int")
    scored = coding.cross_validated(df, "name", ["a", "b"], "truth", n_folds=3, trees=5).cache()
    assert scored.count() == 240 and scored.where("score is null").count() == sum(r[1] is None for r in rows)
    cutoffs = coding.balanced_cutoffs(coding.cutoff_curve(scored))
    found = coding.confusion(coding.labelled(scored.join(cutoffs, "fold"), F.col("cutoff")), ["fold"]).collect()
    assert len(found) == 3 and all(r.acc > 0.8 for r in found)
    weight = {r.feature: r.importance for r in coding.feature_importances(df, ["a", "b"], "truth", trees=5).collect()}
    assert weight["a"] > 0.6 and abs(sum(weight.values()) - 1) < 1e-9
    one = coding.cross_validated(df.where("truth = 1"), "name", ["a", "b"], "truth", n_folds=2, trees=2)
    assert one.where("score is not null").count() == 0 and one.count() == 120


def test_letters_are_picked_once(spark, tmp_path):
    texts = ["xxACGTxx", "acg t", "ac", None, "é\nGATTACA\n"]
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").selectExpr("*", "'en' lang").write.parquet(f"{tmp_path}/documents.parquet")
    seqs = sequence_plans._seqs(spark, str(tmp_path))
    assert {(r.name, r.seq) for r in seqs.collect()} == {("S0", "ACGT"), ("S1", "ACGT"), ("S4", "GATTACA")}
    assert seqs._jdf.queryExecution().optimizedPlan().toString().count("regexp_replace") == 1


def test_kmer_scores_in_place(spark):
    rng = random.Random(5)
    texts = ["".join(rng.choices("ACGTNé", [9, 9, 9, 9, 1, 1], k=n)) for n in (0, 1, 2, 5, 8, 9, 40, 300, 2000)] + [None]
    ks = (1, 2, 3, 6, 10)
    model = {k: {kmer: rng.random() for s in texts[-4:-1] for i in range(0, len(s) - k + 1, 2) if (kmer := s[i : i + k])} for k in ks}
    table = spark.createDataFrame([(k, kmer, r) for k, of in model.items() for kmer, r in of.items()], "k int, kmer string, ratio double")
    found = spark.createDataFrame([(f"n{i}", s, None if s is None else len(s), 4000) for i, s in enumerate(texts)], "name string, orf_seq string, orf_length int, rna_size int")
    matrix = sequences.feature_matrix(found, table, ks)
    for r in matrix.collect():
        s = texts[int(r.name[1:])] or ""
        for k in ks:
            own = [model[k].get(s[i : i + k], 0.5) for i in range(0, len(s) - k + 1, sequences.codon_step(k))]
            got = r[f"kmer_score_{k}"]
            assert got is None if not own else abs(got - sum(own) / len(own)) < 1e-9
    short = sequences.feature_matrix(found, table, ks[:4])
    assert "Exchange" not in short._jdf.queryExecution().executedPlan().toString() and short.count() == len(texts)
    letters = sequences.SCORED_LETTERS
    try:
        sequences.SCORED_LETTERS = 50
        some = sequences._mean_ratios(texts, *sequences._ratio_tables(table, ks[:4]))
    finally:
        sequences.SCORED_LETTERS = letters
    whole = sequences._mean_ratios(texts, *sequences._ratio_tables(table, ks[:4]))
    assert np.allclose(some, whole, equal_nan=True)


def test_kmers_of_models_are_numbers(spark):
    rng = random.Random(6)
    sides = [["".join(rng.choices("ACGTN", [9, 9, 9, 9, 1], k=n)) for n in (1, 40, 300)] + [None, "é" * 13 + "ACGTACGTACGT"] for _ in range(2)]
    coding_rows, other_rows = (spark.createDataFrame([(x,) for x in side], "seq string") for side in sides)
    ks = (1, 3, 12, 33)
    model = sequences.kmer_models(coding_rows, other_rows, ks)
    cut = lambda side, k, step: [x[i : i + k] for x in side if x for i in range(0, len(x) - k + 1, step)]
    want = {}
    for k in ks:
        c, n = cut(sides[0], k, sequences.codon_step(k)), cut(sides[1], k, 1)
        for kmer in {*c, *n}:
            fc, fn = c.count(kmer) / len(c), n.count(kmer) / len(n)
            want[k, kmer] = fc / (fc + fn)
    got = {(r.k, r.kmer): r.ratio for r in model.collect()}
    assert got.keys() == want.keys() and model.count() == len(want) and all(abs(got[x] - want[x]) < 1e-12 for x in want)
    assert "MapInArrow" in model._jdf.queryExecution().optimizedPlan().toString()


def test_frames_and_parts_stay_where_they_are(spark):
    rng = random.Random(7)
    rows = [(f"n{i}", "ATG" + "".join(rng.choices("ACG", k=60)) + "TAA", "x") for i in range(200)] + [(None, "ATGACGTAA" * 9, "x")]
    frames = coding_potential.frames_of_sequences(spark.createDataFrame(rows, "name string, seq string, other string"), kmers=(1, 3))
    plan = lambda d: d._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan(frames) and frames.columns == coding_potential.FRAME
    assert {(r.name, r.seq) for r in frames.collect()} == {x[:2] for x in rows[:-1]}
    sides = frames.where("name < 'n15'"), frames.where("name >= 'n15'")
    parts = coding_potential.learning_parts(*sides, share=0.2)
    assert "Join" not in plan(parts)
    named = frames.selectExpr("name", "int(name < 'n15') as truth")
    want = {tuple(r) for r in coding.holdout_split(named, "name", "truth", 0.2).select("name", "truth", "part").collect()}
    assert {tuple(r) for r in parts.select("name", "truth", "part").collect()} == want and parts.count() == 200


def test_forests_are_grown_in_few_jobs_and_repeat(spark):
    rng = random.Random(4)
    rows = [(f"n{i}", rng.gauss(2 * (i % 3 == 0), 1), rng.choice([0, 1, 2]), rng.random(), int(i % 3 == 0)) for i in range(300)]
    df = spark.createDataFrame(rows, "name string, a double, b int, c double, truth int")
    tracker = spark.sparkContext.statusTracker()
    before = len(tracker.getJobIdsForGroup(None))
    scores = lambda d: {r.name: r.score for r in coding.cross_validated(d, "name", ["a", "b", "c"], "truth", trees=60).collect()}
    got = scores(df)
    assert len(tracker.getJobIdsForGroup(None)) - before < 60
    assert got == scores(df.repartition(7, "c")) and len(set(got.values())) > 100


def test_grown_tree():
    r = np.random.default_rng(3)
    label = (np.arange(4000) % 4 == 0).astype(np.uint8)
    values = [r.normal(label * 2), r.integers(0, 5, 4000).astype(float), r.normal(0, 1, 4000)]
    edges = [forest.edges_of(v) for v in values]
    assert len(edges[0]) == forest.BINS - 1 and edges[1].tolist() == [0.5, 1.5, 2.5, 3.5]
    codes = np.stack([forest.binned(e, v) for e, v in zip(edges, values)], 1) * np.uint8(2) + label[:, None]
    feature, cut, share, _ = tree = forest.grown(codes, np.random.default_rng(1))
    drawn = forest._DRAWN[np.random.default_rng(1).integers(0, 1 << 16, 4000, np.uint16)]
    assert abs(drawn.mean() - 1) < 0.1
    # Walked by hand, each end holds the weighted share of the drawn rows that come there.
    ends = np.zeros(4000, int)
    for i, row in enumerate(codes // 2):
        for _ in range(forest.DEPTH):
            ends[i] = 2 * ends[i] + 1 + (row[feature[ends[i]]] > cut[ends[i]])
    ends -= len(feature)
    for e in set(ends[drawn > 0]):
        ones, others = (drawn[(ends == e) & (label == k)].sum() / (label == k).sum() for k in (1, 0))
        assert abs(share[e] - ones / (ones + others)) < 1e-9
    model = forest.Forest(edges, *(np.stack([x]) for x in tree))
    assert (model.scores(values) == share[ends]).all()
    # The root takes the best cut of the two features tried there.
    left = codes[:, feature[0]] // 2 <= cut[0]
    gini = lambda m: sum((p := [(drawn * m)[label == k].sum() / (label == k).sum() for k in (0, 1)])[k] ** 2 for k in (0, 1)) / sum(p)
    at_each = [gini(codes[:, feature[0]] // 2 <= b) + gini(codes[:, feature[0]] // 2 > b) for b in range(codes[:, feature[0]].max() // 2)]
    assert abs(gini(left) + gini(~left) - max(at_each)) < 1e-12
    # One label alone, or one value alone, is one end.
    for alone in (codes | 1, codes * 0 + label[:, None]):
        assert (forest.grown(alone, np.random.default_rng(2))[1] == 255).all()


def test_trees_counted_by_node(monkeypatch):
    r = np.random.default_rng(5)
    label = (r.random(3000) < 0.3).astype(np.uint8)
    for width in (1, 8, 9):
        codes = (r.integers(0, forest.BINS, (3000, width)) + 3 * label[:, None]).clip(0, forest.BINS - 1).astype(np.uint8) * np.uint8(2) + label[:, None]
        trees = []
        for rows in (0, 100, 1 << 30):
            monkeypatch.setattr(forest, "NODE_ROWS", rows)
            trees.append(forest.grown(codes, np.random.default_rng(8)))
        assert all((x == y).all() for other in trees[1:] for x, y in zip(trees[0], other, strict=True))
    drawn = np.arange(10, dtype=np.uint8)
    found = forest._drawn_rows(np.arange(20, dtype=np.uint8).reshape(10, 2), drawn.copy())
    assert (np.bincount(found[:, 1] & 63, found[:, 1] // 64 + 1, 20)[1::2] == drawn).all()


def test_transcript_rows_and_choice(spark):
    ex = _exons(spark, [("a", "-", 5, 10), ("a", "-", 13, 20), ("b", "+", 1, 2)]).withColumn("feat_level", F.lit("exon"))
    made = transcripts.with_transcript_rows(ex).where("feat_level = 'transcript'").collect()
    assert {(r.transcript_id, r.start, r.end, r.biotype) for r in made} == {("a", 5, 20, None), ("b", 1, 2, None)}
    pick = transcripts.random_per_gene(transcripts.transcript_rollup(ex).withColumn("gene_id", F.lit("g")), 3).collect()
    assert len(pick) == 1 and pick == transcripts.random_per_gene(transcripts.transcript_rollup(ex).withColumn("gene_id", F.lit("g")), 3).collect()


def test_gene_classes_over_the_annotation(spark):
    known = spark.createDataFrame([("g", "t1"), ("g", "t2"), ("g", "t2"), ("h", "t3")], "gene_id string, transcript_id string")
    best = spark.createDataFrame([("t1", "lincConv", "P", 10), ("t1", "lincSSup", "Q", 9), ("zz", "lincDivg", "P", 1), (None, "lincDivg", "P", 1), ("t2", "lincDivg", "Q", 100)], "transcript_id string, class string, partner_gene string, distance long")
    rows = gene_level.transcript_classes(known, best)
    assert sorted((r.transcript_id, r["class"]) for r in rows.collect()) == [("t1", "lincSSup"), ("t2", "lincDivg"), ("t3", None)]
    pick = lambda **o: {r.gene_id: (r["class"], r.class_type, r.distance) for r in gene_level.gene_classes(rows, **o).collect()}
    assert pick() == {"g": ("lincDivg", "n.n.1", 100), "h": ("unclassified", "unclassified", None)}
    assert pick(compat=True) == {"g": ("lincSS", "n.n.1", 100), "h": ("unclassified", "unclassified", None)}
    near = spark.createDataFrame([("g", "a", "lincSSup", "P", 9), ("g", "b", "lincSSup", "P", 10)], "gene_id string, transcript_id string, class string, partner_gene string, distance long")
    assert [gene_level.gene_classes(near, c).first().distance for c in (False, True)] == [9, 10]


def test_selecting_interactions(spark):
    rows = [(1, "a", "x", "sense", "genic", 0, "nested"), (2, "a", "y", "antisense", "intergenic", 5, "divergent"), (3, "b", "a", "sense", "intergenic", 9, None), (4, None, "y", None, None, None, None)]
    df = spark.createDataFrame(rows, "i int, lncrna_transcript string, partnerrna_transcript string, direction string, rel_type string, distance long, subtype string")
    ids = lambda **o: sorted(r.i for r in classify.select_interactions(df, **o).collect())
    assert [ids(compared=(op, 5)) for op in ("eq", "lt", "le", "gt", "ge")] == [[2], [1], [1, 2], [3], [2, 3]]
    assert [ids(transcript="a", side=side) for side in (1, 2, 3)] == [[1, 2], [3], [1, 2, 3]]
    assert (ids(nested=True), ids(divergent=False), ids(tags={"direction": "sense", "distance": 9}), ids()) == ([1], [1], [3], [1, 2, 3, 4])
    assert sorted(r.transcript_id for r in classify.selected_partners(df).collect()) == ["a", "x", "y"]


def test_common_part_by_strand(spark):
    df = spark.createDataFrame([(1, 9, 5, 12, "+", "-"), (1, 3, 5, 9, "+", "+")], "b1 int, e1 int, b2 int, e2 int, s1 string, s2 string")
    c = [F.col(x) for x in ("b1", "e1", "b2", "e2", "s1", "s2")]
    got = df.select(*[iv.common_part(*c, m).alias(f"m{i}") for i, m in enumerate((0, 1, -1))]).collect()
    assert [[tuple(x) for x in r] for r in got] == [[(5, 9), (0, 0), (5, 9)], [(0, 0)] * 3]


def test_second_stage_whole(spark):
    rng = random.Random(3)
    coding_rows = [(f"c{i}", "ATG" + "".join(rng.choice(["GCT", "GAA", "AAG", "CTG"]) for _ in range(60)) + "TAA" + "ACGT" * 5) for i in range(60)]
    other_rows = [(f"n{i}", "".join(rng.choice("ACGT") for _ in range(240)) + "ATG" + "ACT" * 9 + "TGA") for i in range(60)]
    make = lambda x: spark.createDataFrame(x, "name string, seq string")
    a, b = (coding_potential.frames_of_sequences(make(x), kmers=(1, 3, 6)) for x in (coding_rows, other_rows))
    names = make([("c0", ""), ("n0", ""), ("bare", "")]).select("name")
    test = a.where("name = 'c0'").unionByName(b.where("name = 'n0'"))
    for options in ({}, {"specificities": (0.9, 0.9)}, {"cutoff": 0.5}):
        run = coding_potential.coding_potential(a, b, test, names, kmers=(1, 3, 6), n_folds=3, trees=5, least=20, **options)
        assert {r.name: r["class"] for r in run.classes.collect()} == {"c0": "mRNA", "n0": "lncRNA", "bare": "noORF"}
        table = {r.fold: r.acc for r in run.metrics.collect()}
        assert set(table) == {"1", "2", "3", "mean"} and table["mean"] > 0.9
        assert tuple(run.summary.first())[2:] == (1, 1, 0, 0)
    assert run.learning.count() == 120 - 12 and abs(sum(r.importance for r in run.importances.collect()) - 1) < 1e-9
    with pytest.raises(ValueError):
        coding_potential.coding_potential(a, b, test, names, kmers=(1, 3), least=100)
    assert coding.capped(a, "name", 25, 20).count() == 25


def test_annotated_frames_win(spark):
    genome = spark.createDataFrame([("c", "CCATGAAATAACCATGCCCGGGTTTTAACC")], "id string, s string")
    rows = [("t", "exon", 1, 30), ("t", "CDS", 14, 25), ("t", "stop_codon", 26, 28), ("u", "exon", 1, 30)]
    f = spark.createDataFrame([(t, "c", "+", lv, a, z) for t, lv, a, z in rows], "transcript_id string, chr string, strand string, feat_level string, start long, end long")
    got = {r.name: (r.orf_seq, r.rna_size) for r in coding_potential.frames_of_transcripts(f, sequences.genome_chunks(genome, "id", "s"), 0, (1,)).collect()}
    assert got == {"t": ("ATGCCCGGGTTTTAA", 30), "u": ("ATGCCCGGGTTTTAA", 30)}


def test_clusters_need_a_shared_folder():
    assert session.is_local("local[8]") and session.is_local("local") and not session.is_local("local-cluster[2,1,1024]") and not session.is_local("yarn")


def test_gene_classes(spark):
    rows = [("g", "t1", "lincConv", "P", 10), ("g", "t2", "lincSSdw", "P", 5), ("g", "t3", "lincSSup", "Q", 9), ("h", "t4", None, None, None), ("i", "t5", "lncgASexNest", "P", 0)]
    got = {r.gene_id: (r["class"], r.class_type, r.partner_gene) for r in gene_level.gene_classes(spark.createDataFrame(rows, "gene_id string, transcript_id string, class string, partner_gene string, distance long")).collect()}
    assert got == {"g": ("lincSSdw_n.n.n", "n.n.n", "P"), "h": ("unclassified", "unclassified", None), "i": ("lncgASexNest", "1.1.1", "P")}


def test_gtf_gff3_bed_fasta_files(spark, tmp_path):
    gtf = tmp_path / "a.gtf"
    gtf.write_text('# c\n\nc\tlincRNA\texon\t5\t9\t.\t+\t.\tgene_id "g"; transcript_id "t"; tag "x"; tag "y; z"; transcript_type "q";\nc\ts\tgene\t1\t9\t.\t+\t.\tgene_id "g";\nHPATCH\ts\texon\t1\t2\t.\t+\t.\tgene_id "g"; transcript_id "u";\n')
    f = annotation.read_gtf(spark, str(gtf))
    row = f.collect()
    assert len(row) == 1 and row[0].attrs["tag"] == "y; z" and row[0].attrs["transcript_biotype"] == "lincRNA"
    annotation.write_gtf(f, str(tmp_path / "out"))
    assert annotation.read_gtf(spark, str(tmp_path / "out")).collect()[0].attrs["tag"] == "y; z"
    assert annotation.read_gtf(spark, str(gtf), attributes={"transcript_biotype": ["mRNA"]}).count() == 0
    assert annotation.read_gtf(spark, str(gtf), attributes={"absent": ["x"]}, columns={"strand": ["+"]}).count() == 1
    gff = tmp_path / "a.gff3"
    gff.write_text("c\ts\tmRNA\t1\t9\t.\t+\t.\tID=t1;Parent=g1\nc\ts\texon\t1\t4\t.\t+\t.\tParent=t1\nc\ts\texon\t1\t4\t.\t+\t.\tParent=t2\n")
    assert {(r.transcript_id, r.gene_id) for r in annotation.read_gff3(spark, str(gff)).collect()} == {("t1", "g1"), ("t2", "t2")}
    bed = tmp_path / "a.bed"
    bed.write_text("c\t0\t10\tn\t0\t+\nc\t20\t50\tn\t0\t-\t20\t50\t0\t2\t5,10,\t0,20,\n")
    assert sorted((r.transcript_id, r.start, r.end) for r in annotation.read_bed(spark, str(bed)).collect()) == [("n", 1, 10), ("n_dup2", 21, 25), ("n_dup2", 41, 50)]
    fa = tmp_path / "a.fa"
    fa.write_text(">s1 words here a->b\nACG\nTT\n>s2\nGG\n")
    s = fasta.read_fasta(spark, str(fa))
    assert {(r.name, r.seq) for r in s.collect()} == {("s1", "ACGTT"), ("s2", "GG")}
    (tmp_path / "b.fa").write_bytes(b"\n>s1 desc a->b>c\r\nACGT\r\nA C\r\n>empty\r\n>s2\r\nGG")
    assert sorted(tuple(r) for r in fasta.read_fasta(spark, str(tmp_path / "b.fa")).collect()) == [("empty", ""), ("s1", "ACGTAC"), ("s2", "GG")]
    fasta.write_fasta(s, str(tmp_path / "fa"))
    assert {(r.name, r.seq) for r in fasta.read_fasta(spark, str(tmp_path / "fa")).collect()} == {("s1", "ACGTT"), ("s2", "GG")}
    assert annotation.format_of("x.gff2") == "gtf" and annotation.format_of("x.fa") == "fasta"


def test_lines_that_cannot_be_read(spark):
    frame = lambda xs: spark.createDataFrame([(x,) for x in xs], "value string")
    good = 'c\ts\texon\t1\t9\t.\t+\t.\tgene_id "g"; transcript_id "t";'
    gtf = frame([good, good + "\r", "", "# x", "track y", "c\ts\texon\t1\t9", good + "\tmore", good.replace("\t1\t", "\tone\t"), None])
    assert annotation.gtf_features(gtf).count() == 2
    assert sorted(r.reason for r in annotation.rejected_lines(gtf).collect()) == ["columns", "columns", "coordinates"]
    bed = frame(["c\t0\t9\tn\t0\t+", "c\t0\t9\tn\t0", "c\tx\t9\tm\t0\t+", "c\t0\t9\tm\t0\t+\t0\t9\t0\t2\t3,\t0,5", "c\t0\t9\tm\t0\t+\t0\t9\t0\t2\t3,4,\t0,5,", "browser x"])
    assert sorted((r.transcript_id, r.start, r.end) for r in annotation.bed_features(bed).collect()) == [("m", 1, 3), ("m", 6, 9), ("n", 1, 9)]
    assert sorted(r.reason for r in annotation.rejected_lines(bed, "bed").collect()) == ["blocks", "columns", "coordinates"]
    assert annotation.bed_features(bed.limit(0)).count() == 0 and annotation.rejected_lines(bed.limit(0)).count() == 0


def test_roundtrip_counts_every_feature(spark, tmp_path):
    attrs = ['gene_id "g"; transcript_id "t"; tag "x; y";', 'gene_id "g"; tag "x";', 'transcript_id "t";', 'gene_id ""; transcript_id "t";', "", 'gene_id "g"; transcript_id "t"; note "a "b" c";', 'gene_id "g"; transcript_id "t"; note a"b"; tag "x";']
    lines = [(f"c\ts\texon\t{i}\t9\t.\t+\t.\t{a}",) for i, a in enumerate([*attrs, attrs[1]])]
    df = spark.createDataFrame(lines, "line string")
    df.write.parquet(f"{tmp_path}/gtf_lines.parquet")
    assert tuple(gtf_roundtrip(spark, str(tmp_path)).first()) == (8, 1)
    again = annotation.gtf_features(annotation.gtf_text(annotation.gtf_features(df.selectExpr("line as value")))).orderBy("start").collect()
    assert [(r.gene_id, r.transcript_id) for r in again[:5]] == [("g", "t"), ("g", None), (None, "t"), ("", "t"), (None, None)]
    assert again[5].attrs["note"] == 'a "b" c'


def test_routes_and_sinks(spark, tmp_path):
    rows = spark.createDataFrame([("a", 1), ("b", 0), ("c", -1)], "name string, label int")
    routed = coding.routed(spark.createDataFrame([(x,) for x in "abcd"], "name string"), rows, "name")
    assert {r.name: r["class"] for r in routed.collect()} == {"a": "mRNA", "b": "lncRNA", "c": "TUCp", "d": "noORF"}
