"""Corpus operators: against reference encoders, capacity checks and held-out accuracy."""

import random

import numpy as np
import pytest

tiktoken = pytest.importorskip("tiktoken")
pytest.importorskip("zstandard")
pytest.importorskip("ahocorasick")

from pyspark.sql import functions as F  # noqa: E402

from helixframe.llm.byte_bpe import PATTERN, ByteBpe, read_ranks  # noqa: E402
from helixframe.llm.encoding import decoded_text, token_ids  # noqa: E402
from helixframe.llm.packing import MAX_SPECS, Places, class_patterns, fill_report, pack_documents, packing_faults, refined_patterns  # noqa: E402
from helixframe.llm.plans import QUERIES, RANKS, TOKENIZERS  # noqa: E402
from helixframe.llm.toxicity import LEAST, calibrated_threshold, folded, toxicity_rates, toxicity_scores, toxic_documents  # noqa: E402


@pytest.mark.parametrize("name", ["byte_bpe_50k", "byte_bpe_multi_50k"])
def test_encoder_is_exact(name):
    bpe = ByteBpe(read_ranks(f"{TOKENIZERS}/{name}.tiktoken"))
    known = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks={t: i for i, t in enumerate(bpe.tokens)}, special_tokens={})
    rng = random.Random(1)
    bits = ["a", "e", "th", " ", "  ", "\n", "\t", "'s", "1", "23", "é", "ß", "漢", "😀", "ing", "-----", "\r\n", "aaaa", "\x00", "<|endoftext|>", "Hallumi", "ſ"]
    texts = ["".join(rng.choice(bits) for _ in range(rng.randint(0, 40))) for _ in range(3000)] + ["ab" * 20_000]
    offsets, ids = bpe.encode_batch(texts)
    for i, t in enumerate(texts):
        assert ids[offsets[i] : offsets[i + 1]].tolist() == known.encode_ordinary(t)
    assert bpe.decode_batch(offsets, ids) == texts


def test_separators_are_no_blanks():
    bpe = ByteBpe(read_ranks(RANKS))
    known = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks={t: i for i, t in enumerate(bpe.tokens)}, special_tokens={})
    rng = random.Random(2)
    bits = ["a", "th", "1", " ", "  ", "\n", "\t", "-", "\x1c", "\x1d", "\x1e", "\x1f", "\x85", "\u00a0", "\u3000"]
    texts = ["a  \x1cb"] + ["".join(rng.choice(bits) for _ in range(rng.randint(0, 20))) for _ in range(3000)]
    offsets, ids = bpe.encode_batch(texts)
    assert [ids[offsets[i] : offsets[i + 1]].tolist() for i in range(len(texts))] == [known.encode_ordinary(t) for t in texts]


def test_ids_and_back(spark):
    texts = ["one two", "", None, "  ", "ü" * 5000, "one two"]
    df = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "doc_id long, text string, ids string")
    ids = token_ids(df, "doc_id", "text", RANKS)
    got = {r.doc_id: r.ids for r in ids.collect()}
    assert got[1] == got[2] == [] and got[0] == got[5] and len(got) == len(texts)
    assert {r.doc_id: r.text for r in decoded_text(ids, "doc_id", "ids", RANKS).collect()} == {i: t or "" for i, t in enumerate(texts)}
    nulls = spark.createDataFrame([(1, None)], "doc_id long, ids array<int>")
    assert decoded_text(nulls, "doc_id", "ids", RANKS).collect()[0].text == ""
    assert token_ids(df.limit(0), "doc_id", "text", RANKS).count() == 0


@pytest.mark.parametrize("capacity", [10, 97, 10**6])
def test_patterns_place_everything(capacity):
    rng = random.Random(capacity)
    counts = {n: rng.randint(1, 40) for n in {rng.randint(1, min(capacity, 50_000)) for _ in range(2000)} | {capacity}}
    patterns = refined_patterns(counts, capacity)
    assert all(sum(n * q for n, q in p) <= capacity for p, _ in patterns)
    assert all(q == min(capacity // n, q) for p, _ in patterns for n, q in p[:1])
    placed = {}
    for p, bins in patterns:
        for n, q in p:
            placed[n] = placed.get(n, 0) + q * bins
    assert placed == counts
    places = Places({7: patterns, 999: patterns})
    for n in list(counts)[:50]:
        ranks = np.arange(1, counts[n] + 1)
        for spec in (7, 999):
            got = places.bins(np.full(len(ranks), spec), np.full(len(ranks), n), ranks)
            assert got.min() >= 1 and got.max() <= sum(b for _, b in patterns)


def test_classes_are_filled_by_count():
    patterns = class_patterns({1: 3, 2: 5, 7: 6})
    assert sorted(patterns) == [([(1, 1)], 3), ([(2, 1)], 1), ([(2, 2)], 2), ([(7, 6)], 1)]


@pytest.mark.parametrize("refined", [True, False])
def test_packing_is_whole_and_within_capacity(spark, refined):
    rng = random.Random(2)
    sizes = [(i, rng.choice([None, 0, 1, 5, 37, 99, 100, 101, 250, rng.randint(1, 6000)])) for i in range(600)] + [(0, 100)]
    docs = spark.createDataFrame([(*s, 1) for s in sizes], "doc_id long, n long, piece int")
    specs = spark.createDataFrame([(1, 100), (2, 5000), (3, None), (4, 0)], "spec_id int, capacity int")
    packed = pack_documents(docs, "doc_id", "n", specs, refined).persist()
    for spec, cap in ((1, 100), (2, 5000)):
        mine = packed.where(F.col("spec_id") == spec)
        assert mine.agg(F.sum("n_tokens")).first()[0] == sum(n or 0 for _, n in sizes)
        assert mine.select("doc_id").distinct().count() == 600
        assert mine.where("bin_id > 0").groupBy("bin_id").agg(F.sum("n_tokens").alias("t")).agg(F.max("t")).first()[0] <= cap
        whole = mine.groupBy("doc_id").agg(F.count("*").alias("n"), F.sum("n_tokens").alias("t"), F.max("n_tokens").alias("m")).where(f"doc_id > 0 and t <= {cap} and n > 1")
        assert whole.count() == 0
        assert mine.where("(n_tokens = 0) <> (bin_id = 0)").count() == 0
    assert {r.spec_id for r in fill_report(packed, specs).collect()} == {1, 2}
    if refined:
        assert min(r.fill for r in fill_report(packed, specs).collect()) > 0.9
    once = docs.groupBy("doc_id").agg(F.max("n").alias("n"))
    faults = packing_faults(pack_documents(once, "doc_id", "n", specs, refined), once, "doc_id", "n", specs).collect()
    assert sorted(tuple(r) for r in faults) == [(1, 600, 0, 0, 0), (2, 600, 0, 0, 0)]
    assert pack_documents(docs.limit(0), "doc_id", "n", specs).count() == 0
    assert pack_documents(docs, "doc_id", "n", specs.limit(0)).count() == 0


def test_packing_with_many_specs_and_large_capacities(spark):
    docs = spark.createDataFrame([(i, 10_000 - i) for i in range(5)], "doc_id long, n long")
    specs = spark.createDataFrame([(i, 10_000 + i) for i in range(300)], "spec_id int, capacity int")
    packed = pack_documents(docs, "doc_id", "n", specs).groupBy("spec_id").agg(F.count_distinct("bin_id").alias("n"), F.min("bin_id").alias("a"), F.max("bin_id").alias("z")).collect()
    assert len(packed) == 300 and {(r.n, r.a, r.z) for r in packed} == {(5, 1, 5)}
    wide = spark.createDataFrame([(1, 10**6)], "spec_id int, capacity int")
    many = spark.range(3000).selectExpr("id as doc_id", "1 + pmod(xxhash64(id), 400000) as n")
    assert fill_report(pack_documents(many, "doc_id", "n", wide), wide).first().fill > 0.99
    with pytest.raises(ValueError):
        pack_documents(docs, "doc_id", "n", spark.range(MAX_SPECS + 1).selectExpr("cast(id as int) as spec_id", "10 as capacity"))


def _corpus(n, seed):
    rng = random.Random(seed)
    plain = ["the mayor opened the new bridge on monday", "a farmer from the district sold his horses", "the committee thanked the teacher for her work", "fresh oysters daily at the market hall"]
    bad = ["you are the filthy scum of this town and should drown", "go to hell you miserable stinking rat of a man", "every last one of them is vermin and must be driven out"]
    out = []
    for i in range(n):
        lines = [rng.choice(plain) + f" {rng.randint(1, 99)}" for _ in range(8)]
        y = int(i % 4 == 0)
        if y:
            lines.insert(rng.randint(0, 8), rng.choice(bad))
        out.append((i, "\n".join(lines), "en", f"s{i % 3}", y))
    return out


def test_toxicity_on_held_out_documents(spark):
    docs = _corpus(400, 1) + [(1000, None, None, None, 0), (1001, "", "en", "s0", 0), (1002, "word " * 20_000, "xx", "s0", 0)]
    df = spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, truth int")
    labels = spark.createDataFrame([(d[0], d[4]) for d in docs[:200]] + [(3, 1), (4, None), (5, 0)], "doc_id long, toxic int")
    got = {r.doc_id: r for r in toxic_documents(df, "doc_id", "text", "lang", labels).collect()}
    assert len(got) == len(docs) and got[1000].score == got[1001].score == LEAST and not got[1002].is_toxic
    unseen = docs[200:400]
    assert sum(got[d[0]].is_toxic == bool(d[4]) for d in unseen) >= 0.95 * len(unseen)
    rates = toxicity_rates(toxic_documents(df, "doc_id", "text", "lang", labels), df, "doc_id", "source").collect()
    assert sum(r.n_docs for r in rates) == len(docs)


def test_rates_count_every_row(spark, tmp_path):
    docs = [(1, "a", "en", "s"), (1, "b", "en", "t"), (1, "c", "en", None), (None, "d", "en", "s"), (None, "", None, "u")]
    df = spark.createDataFrame(docs, "doc_id long, text string, lang string, source string")
    df.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id long, toxic int").write.parquet(f"{tmp_path}/review_labels.parquet")
    want = {"s": 2, "t": 1, "u": 1, None: 1}
    assert {r.source: r.n_docs for r in QUERIES["p8_rates"](spark, str(tmp_path)).collect()} == want
    judged = df.selectExpr("doc_id", "text = 'a' as is_toxic")
    assert {r.source: (r.n_docs, r.n_toxic) for r in toxicity_rates(judged, df, "doc_id", "source").collect()} == {"s": (2, 1), "t": (1, 1), "u": (1, 0), None: (1, 1)}


def test_toxicity_without_labels(spark):
    df = spark.createDataFrame([(1, "some text", None), (2, None, "en")], "doc_id long, text string, lang string")
    labels = spark.createDataFrame([], "doc_id long, toxic int")
    scored, held_out = toxicity_scores(df, "doc_id", "text", "lang", labels)
    assert {r.doc_id: r.score for r in scored.collect()} == {1: 0, 2: LEAST}
    assert calibrated_threshold(scored, held_out) == 1
    assert toxic_documents(df.limit(0), "doc_id", "text", "lang", labels).count() == 0


def test_folding_joins_what_scans_break():
    assert folded("Hal-\nlumi") == folded("H a l l u m i".replace(" ", "")) == folded("HALLUMI")
    assert folded("die H a l l u m i kom") == folded("die Hallumi kom")
