"""Dealt operators against brute force, with nulls, ties, repeats, empty tables and clashing names."""

import random
import re
from collections import Counter
from datetime import datetime

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from helixframe.operators.interval_merge import merge_intervals
from helixframe.operators.key_balance import block_borders, number_rows, ordered_key_stats, with_block
from helixframe.operators.orphans import Parent, Referrer, bloom_words, orphan_references, orphan_report, probed, words_for
from helixframe.operators.packed_fields import packed_members, split_members
from helixframe.operators.row_validation import bad_lines, clean_rows, failed_rules


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_number_rows_hot_key_blocks_and_null_order(spark):
    data = [("a" if i % 3 else None, i, i % 7) for i in range(1000)] + [("a", None, 1), ("b", 5, 1), ("b", 5, 1)]
    df = spark.createDataFrame(data, "k string, o long, rank long")
    got = number_rows(df, ["k"], "o", ["rank"], block_rows=64, name="n").collect()
    by = {}
    for r in got:
        by.setdefault(r.k, []).append((r.n, r.o))
    for k, xs in by.items():
        assert sorted(n for n, _ in xs) == list(range(1, len(xs) + 1)), k
        orders = [o for _, o in sorted(xs)]
        known = [o for o in orders if o is not None]
        assert known == sorted(known) and (None not in orders or orders[-1] is None)
    assert len(got) == len(data)


@pytest.mark.parametrize("order", ["id", "xxhash64(id)", "7", "cast(null as long)", "if(id < 900, id, (1L << 62) + id)"])
def test_blocks_are_even_for_any_order(spark, order):
    df = spark.range(1000).selectExpr("'hot' as k", f"{order} as o", "id % 50 as t", "id")
    at = F.struct(F.col("o").alias("o"), F.col("t").alias("t"), F.xxhash64("id").alias("h"))
    sizes = [r["count"] for r in with_block(df, at, block_borders(df, at, 64), "b").groupBy("b").count().collect()]
    assert len(sizes) >= 12 and max(sizes) <= 200 and sum(sizes) == 1000
    got = number_rows(df, ["k"], "o", ["t"], block_rows=64).collect()
    assert sorted(r["rank"] for r in got) == list(range(1, 1001))
    keys = [((r.o is None), r.o or 0, r.t) for r in sorted(got, key=lambda r: r["rank"])]
    assert keys == sorted(keys)


@pytest.mark.parametrize("chunk", [3, 1000])
def test_ordered_key_stats(spark, chunk):
    rng = random.Random(chunk)
    data = [(rng.choice(["x", "x", "x", "y", None]), i, rng.choice([None, *range(1, 60)]), rng.choice([None, *range(1, 90)]), rng.choice([True, False, None]), "clash") for i in range(400)]
    df = spark.createDataFrame(data, "key string, rank long, s long, e long, c boolean, chunk string")
    got = {r.key: r for r in ordered_key_stats(df, "key", "rank", "s", "e", "c", chunk_rows=chunk, block_rows=32).collect()}
    for k in ("x", "y"):
        mine = [d for d in data if d[0] == k]
        starts = [d[2] for d in mine if d[2] is not None]
        r = got[k]
        assert (r.n_rows, r.span_start, r.span_end) == (len(mine), min(starts), max(d[3] for d in mine if d[3] is not None))
        assert r.n_counted == sum(1 for d in mine if d[4])
        assert r.counted_sum == sum(d[3] - d[2] + 1 for d in mine if d[4] and d[2] is not None and d[3] is not None and d[2] <= d[3])
        assert r.n_back == sum(b < a for a, b in zip(starts, starts[1:]))
    assert set(got) == {"x", "y"}
    assert ordered_key_stats(df.limit(0), "key", "rank", "s", "e", "c").count() == 0


def _t(day):
    return day and datetime(2024, 1, day)


def test_orphans_against_brute_force(spark):
    rng = random.Random(5)
    ids = ["A", "b ", " c", "D", "", ".", None, "gone", "zz"]
    refs = [(i, rng.choice(ids) if i % 3 else "HOT", _t(rng.choice([None, *range(1, 20)]))) for i in range(300)]
    recs = [("a", _t(3), _t(8)), ("A ", _t(3), _t(8)), ("B", _t(5), None), ("C", None, _t(10)), ("hot", _t(2), _t(4)), ("hot", _t(9), _t(12)), ("d", _t(19), None)]
    r = spark.createDataFrame(refs, "row_id long, id string, at timestamp_ntz").selectExpr("*", "'x' as slot", "'y' as kind")
    p = spark.createDataFrame(recs, "id string, since timestamp_ntz, until timestamp_ntz")
    refer, parent = [Referrer("t", r, "row_id", "at", {"id": "p"})], {"p": Parent(p, "id", "since", "until")}
    got = orphan_references(refer, parent, hot_rows=20)
    want = []
    for i, x, t in refs:
        key = (x or "").strip().upper()
        if key in ("", "."):
            continue
        mine = [q for q in recs if q[0].strip().upper() == key]
        if not mine:
            want.append(("t", i, "id", "missing"))
        elif t is not None and not any((a is None or a <= t) and (z is None or t < z) for _, a, z in mine):
            want.append(("t", i, "id", "deleted" if any(z is not None and z <= t for _, _, z in mine) else "late"))
    assert rows(got.select("tbl", "row_id", "ref_field", "kind")) == sorted(want, key=repr)
    for other in (orphan_references(refer, parent, hot_rows=20, few_periods=1), orphan_references(refer, parent, broadcast_words=0)):
        assert rows(other.select("tbl", "row_id", "ref_field", "kind")) == sorted(want, key=repr)
    assert sum(x.n for x in orphan_report(got).collect()) == len(want)
    empty = orphan_references([Referrer("t", r, "row_id", "at", {"id": "p"})], {"p": Parent(p.limit(0), "id", "since", "until")})
    assert {x.kind for x in empty.collect()} == {"missing"}
    assert orphan_references([Referrer("t", r.limit(0), "row_id", "at", {"id": "p"})], {"p": Parent(p, "id", "since", "until")}).count() == 0


def test_bloom_is_bounded_and_proves_orphans_at_any_size(spark):
    assert bloom_words(spark.range(5000).selectExpr("cast(id as string) as k"), "k", 16).count() <= 16
    for n in (1000, 10_000, 1_000_000):
        keys, others = spark.range(n).selectExpr("concat('k', id) as k"), spark.range(20_000).selectExpr("concat('o', id) as k")
        assert probed(others, keys, "k", words_for(n)).where("maybe").count() < 0.05 * 20_000
        assert probed(keys, keys, "k", words_for(n), 0).where("not maybe").count() == 0


GOOD = 'c\ts\texon\t1\t9\t.\t+\t.\tgene_id "g;1"; transcript_id t.1;; note "a b";'
LINES = {
    GOOD: None,
    GOOD + "\r\r": None,
    "c\ts\tgene\t1\t9\t5\t+\t0\tgene_id g": None,
    "c\ts\texon\t1\t9": "columns",
    GOOD + "\tx": "columns",
    GOOD.replace("+\t.", "+\t3"): "frame",
    GOOD.replace("+\t.", "+\t"): "frame",
    GOOD.replace('"a b"', "a b"): "quoting",
    GOOD.replace('"a b"', '"a "b"'): "quoting",
    GOOD.replace("t.1;;", 't.1 x "y"'): "quoting",
    GOOD.replace("gene_id", "Gene_id"): "ids",
    GOOD.replace("t.1", '" "'): "ids",
    "c\ts\texon\t1\t9\t.\t+\t.\t": "ids",
    "c\ts\texon\t1\t9\t.\t+\t.\t;": "ids",
    "# x": 0, "": 0, "  ": 0, "track a": 0,
}


def test_row_validation(spark):
    data = [(i, line, "r") for i, line in enumerate(LINES)] + [(99, None, "n"), (0, GOOD, "again")]
    df = spark.createDataFrame(data, "line_id long, line string, reason string")
    want = {i: v for i, v in enumerate(LINES.values()) if v}
    assert {r.line_id: r.reason for r in bad_lines(df).collect()} == want
    clean = clean_rows(df).collect()
    assert Counter(r.line_id for r in clean) == {0: 2, 1: 1, 2: 1}
    first = next(r for r in clean if r.line_id == 1)
    assert (first.start_pos, first.end_pos, first.score, first.gene_id, first.transcript_id) == (1, 9, None, "g;1", "t.1")
    assert bad_lines(df.limit(0)).count() == 0 and clean_rows(df.limit(0)).count() == 0
    long = GOOD + ' k "v";' * 50_000
    assert failed_rules(spark.createDataFrame([(1, long)], "line_id long, line string")).count() == 0


def brute_members(text, keys):
    out = []
    for key, value in re.findall(r'([^\s;"]+)\s+("[^"]*"|[^;"]*)', text or ""):
        if key in keys:
            for quoted, run in re.findall(r"'([^']*)'|([A-Za-z0-9._:\-][A-Za-z0-9._:'\-]*)", value.strip().strip('"')):
                if run or quoted.strip():
                    out.append((key, run or quoted))
    return out


def test_packed_members(spark):
    rng = random.Random(3)
    parts = ["a.1", "b:2", "5'open", "'x, y'", "'z'", "''", "b-2", "' '"]
    seps = [",", ";", " | ", "/", "+", ",,", " "]
    texts = [None, "", ";", "tag", 'note "tag x"; tag "p q"', "tag bare; tag two"]
    for _ in range(300):
        value = rng.choice(["", ","]) + "".join(rng.choice(parts) + rng.choice(seps) for _ in range(rng.randint(0, 6)))
        texts.append(f'gene_id "g"; tag "{value}"; oId  "{value}" ; other "tag 1; oId 2"; tag last')
    df = spark.createDataFrame([(i, t, 1, "v") for i, t in enumerate(texts)], "row_id long, packed string, pos int, val string")
    got = {}
    for r in packed_members(df, "row_id", "packed", ("tag", "oId")).collect():
        got.setdefault(r.row_id, []).append((r.attr_key, r.pos, r.val))
    for i, t in enumerate(texts):
        n, want = Counter(), []
        for k, v in brute_members(t, ("tag", "oId")):
            n[k] += 1
            want.append((k, n[k], v))
        assert sorted(got.get(i, [])) == sorted(want), t
    assert packed_members(df.limit(0), "row_id", "packed", ("tag",)).count() == 0


def test_packed_members_beyond_ascii():
    values = ["a–b", "a\u00a0b", "“a” b", "a，é、漢字", "e\u0301a…ß", "'x–y' 'ü'", "𝒜😀b٣", "हिन्दी।x"]
    got = split_members(pa.array(range(9)), pa.array([f'tag "{v}";' for v in [*values, "a.b,c"]]), ("tag",)).to_pylist()
    mine = [[r["val"] for r in got if r["row_id"] == i] for i in range(9)]
    assert mine == [["a", "b"], ["a", "b"], ["a", "b"], ["a", "é", "漢字"], ["e\u0301a", "ß"], ["x–y", "ü"], ["𝒜", "b٣"], ["हिन्दी", "x"], ["a.b", "c"]]


def test_packed_members_odd_quotes():
    cut = lambda t: split_members(pa.array([7]), pa.array([t]), ("tag",)).column(3).to_pylist()
    assert cut("tag \"'open, x 3'end\"") == ["open", "x", "3'end"]
    assert cut('tag "never closed, b') == ["never", "closed", "b"]
    assert cut("tag " + "x," * 100_000) == ["x"] * 100_000


def test_merge_intervals(spark):
    rng = random.Random(8)
    data = []
    for i in range(900):
        s = rng.randint(-50, 3000) if i % 3 else rng.randint(1, 200)
        data.append((rng.choice(["a", "a", "b", None]), rng.choice([s, s, s, None]), s + rng.choice([-2, 0, 1, 5, 40, 700]), "c"))
    data += [("far", 1, 10**15), ("far", 10**15 + 1, 10**15 + 1), ("far", 5, 7), ("t", 1, 4), ("t", 5, 9), ("t", 11, 11)]
    data = [(*d[:3], "c") for d in data] + data[:50]
    df = spark.createDataFrame(data, "entity string, s long, e long, kind string")
    want = []
    for k in ("a", "b", "far", "t"):
        block = None
        for s, e in sorted((d[1], d[2]) for d in data if d[0] == k and d[1] is not None and d[1] <= d[2]):
            if block and s <= block[1] + 1:
                block[1] = max(block[1], e)
            else:
                if block:
                    want += [(k, "block", *block), (k, "gap", block[1] + 1, s - 1)]
                block = [s, e]
        want.append((k, "block", *block))
    small = [d for d in data if d[0] != "far"]
    got = merge_intervals(spark.createDataFrame(small, df.schema), "entity", "s", "e", shard_width=16)
    assert rows(got) == sorted((w for w in want if w[0] != "far"), key=repr)
    assert rows(merge_intervals(spark.createDataFrame(small, df.schema), "entity", "s", "e", shard_width=2, seam_shards=1)) == sorted((w for w in want if w[0] != "far"), key=repr)
    for own in (0, 1, 512):
        assert rows(merge_intervals(df, "entity", "s", "e", max_pieces=64, own_widths=own)) == sorted(want, key=repr)
    assert rows(merge_intervals(df.where("entity <> 'far'"), "entity", "s", "e", shard_width=4, max_pieces=16, own_widths=1)) == sorted((w for w in want if w[0] != "far"), key=repr)
    assert merge_intervals(df.limit(0), "entity", "s", "e").count() == 0


def test_merge_intervals_at_the_ends_of_long(spark):
    low, high = -(1 << 63), (1 << 63) - 1
    data = [("x", 1, 5), ("x", low, 7), ("y", 10, 1 << 61), ("y", (1 << 61) + 1, (1 << 61) + 4), ("z", low, low + 2), ("z", high - 1, high), ("z", high, high), ("all", low, high), ("all", 0, 1), ("w", high - 9, high - 5)]
    df = spark.createDataFrame(data, "entity string, s long, e long")
    want = [("x", "block", low, 7), ("y", "block", 10, (1 << 61) + 4), ("z", "block", low, low + 2), ("z", "gap", low + 3, high - 2), ("z", "block", high - 1, high), ("all", "block", low, high), ("w", "block", high - 9, high - 5)]
    for own in (0, 2, 512):
        assert rows(merge_intervals(df, "entity", "s", "e", own_widths=own)) == sorted(want, key=repr)
    assert rows(merge_intervals(df, "entity", "s", "e", shard_width=1000, max_pieces=7)) == sorted(want, key=repr)


def test_merge_intervals_far_apart(spark):
    rng = random.Random(3)
    starts = sorted(rng.sample(range(-(10**15), 10**15), 400))
    df = spark.createDataFrame([("hot", x, x + rng.randint(0, 3 * 10**5)) for x in starts], "entity string, s long, e long")
    spans = [(r.s, r.e) for r in df.orderBy("s").collect()]
    want = [("hot", "block", a, b) for a, b in spans] + [("hot", "gap", b + 1, c - 1) for (_, b), (c, _) in zip(spans, spans[1:])]
    assert rows(merge_intervals(df, "entity", "s", "e")) == sorted(want, key=repr)
