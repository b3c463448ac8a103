"""cDNA, open reading frames and k-mers."""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from helixframe.functions.sequence import reverse_complement
from helixframe.operators.interval_merge import merge_intervals

CHUNK = 1 << 16


def runs_of(seq: str, width: int, overlap: int = 0) -> Column:
    """Array of the runs of `width` letters of `seq`, each with the next `overlap` ones, cut in one pass."""
    inner = f"(?s)(?=(.{{1,{width + overlap}}})).{{1,{width}}}"
    return F.regexp_extract_all(seq, F.lit(inner), F.lit(1))


def genome_chunks(genome: DataFrame, seq_id: str, seq: str, chunk: int = CHUNK) -> DataFrame:
    """(chr, chunk_no, chunk_seq): sequences cut into pieces of equal length, numbered from 0."""
    return genome.where(F.length(seq) > 0).select(F.col(seq_id).alias("chr"), F.posexplode(runs_of(seq, chunk)).alias("chunk_no", "chunk_seq"))


def feature_sequences(features: DataFrame, chunks: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """`features` (chr, start, end, ...) with seq, put together from the chunks they touch.

    Positions beyond the sequence's end have no letters; a feature without any, or on an
    unknown chr, is left out.
    """
    cols = [c for c in features.columns]
    low, high = F.floor((F.col("start") - 1) / chunk).cast("int"), F.floor((F.col("end") - 1) / chunk).cast("int")
    pieces = features.where(F.col("start") <= F.col("end")).withColumn("chunk_no", F.explode(F.sequence(low, high))).join(chunks, ["chr", "chunk_no"])
    offset = F.col("chunk_no") * chunk
    first = F.greatest(F.lit(1), F.col("start") - offset).cast("int")
    last = F.least(F.lit(chunk), F.col("end") - offset).cast("int")
    cut = pieces.withColumn("piece", F.substring("chunk_seq", first, last - first + 1)).where("piece <> ''")
    return cut.groupBy(*cols).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("chunk_no", "piece"))), lambda p: p["piece"]), "").alias("seq"))


def cdna(features: DataFrame, chunks: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """(transcript_id, strand, seq): the features of each transcript joined in order, turned round on the minus strand."""
    parts = feature_sequences(features.select("transcript_id", "strand", "chr", "start", "end").distinct(), chunks, chunk)
    joined = parts.groupBy("transcript_id", "strand").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("start", "end", "seq"))), lambda p: p["seq"]), "").alias("seq"))
    return joined.withColumn("seq", F.when(F.col("strand") == "-", reverse_complement(F.col("seq"))).otherwise(F.col("seq")))


#: Levels that make up a transcript's coding part, and those that aren't exons.
CODING_LEVELS = r"(?i)(CDS|stop_codon)"
NO_EXON_LEVELS = r"(?i)(CDS|stop_codon|start_codon)"


def rna_features(features: DataFrame) -> DataFrame:
    """The features (with feat_level) that make up the whole RNA: all but coding parts and codons."""
    return features.where(~F.col("feat_level").rlike(NO_EXON_LEVELS))


def coding_features(features: DataFrame) -> DataFrame:
    """The coding parts and stop codons of transcripts that have at least one coding part.

    A stop codon within a coding part is there once: parts that touch or overlap are joined.
    """
    with_cds = features.where(F.col("feat_level").rlike("(?i)CDS")).select("transcript_id").distinct()
    kept = features.where(F.col("feat_level").rlike(CODING_LEVELS)).join(with_cds, "transcript_id", "left_semi")
    whose = F.struct("transcript_id", "chr", "strand")
    blocks = merge_intervals(kept.select(whose.alias("whose"), "start", "end"), "whose", "start", "end").where("kind = 'block'")
    return blocks.select("entity.*", F.col("seg_start").alias("start"), F.col("seg_end").alias("end"))


#: For each kind of frame whether a start and a stop are needed; kinds 3 and 4 take the longest of several.
KINDS = {0: (True, True), 1: (True, False), 2: (False, True), 4: (False, False)}


def _starts(letters: np.ndarray, ends: np.ndarray) -> dict[str, np.ndarray]:
    """Every way to begin a reading frame in texts that stand one after the other, up to `ends`.

    A frame begins with ATG, or with the first codon of its register if that is no stop, and
    goes on to the next stop or the last whole codon. An unfinished codon weighs as one.
    """
    sizes = np.diff(ends, prepend=0)
    first = ends - sizes
    owner = np.repeat(np.arange(len(ends)), sizes)
    at = np.arange(len(letters)) - np.repeat(first, sizes)
    a, g, t = (np.append(letters == ord(x), [False, False]) for x in "AGT")
    whole = at + 3 <= sizes[owner]
    n = len(letters)
    stop = whole & t[:n] & ((a[1 : n + 1] & (a[2 : n + 2] | g[2 : n + 2])) | (g[1 : n + 1] & a[2 : n + 2]))
    atg = whole & a[:n] & t[1 : n + 1] & g[2 : n + 2]
    # One number orders places by text, then register, then position.
    wide = int(sizes.max(initial=0)) + 3
    key = lambda p: (owner[p] * 3 + at[p] % 3) * wide + at[p]
    stops = np.sort(key(np.flatnonzero(stop)))
    opening, met = np.flatnonzero(whole & (at < 3) & ~stop), np.flatnonzero(atg)
    p = np.concatenate([opening, met])
    k = key(p)
    i = np.searchsorted(stops, k)
    next_stop = np.append(stops, -1)[np.minimum(i, len(stops))]
    stopped = (i < len(stops)) & (next_stop // wide == k // wide)
    left = sizes[owner[p]] - at[p]
    codons = np.where(stopped, (next_stop - k) // 3 + 1, left // 3)
    is_atg = np.arange(len(p)) >= len(opening)
    return {"owner": owner[p], "start": at[p] + 1, "codons": codons, "weight": codons + (~stopped & (left % 3 > 0)), "place": at[p] + np.where(is_atg, 4, 1), "atg": is_atg, "stopped": stopped}


def _longest(seqs: list[str | None], tried: list[int], min_length: int) -> np.ndarray:
    """(kind, length, start) of the frame of each text; kind -1 where there is none."""
    raw = [s.encode("ascii", "replace") if s else b"" for s in seqs]
    best = np.zeros((len(raw), 3), np.int64)
    best[:, 0] = -1
    if not raw:
        return best
    s = _starts(np.frombuffer(b"".join(raw), np.uint8), np.cumsum([len(x) for x in raw]))
    for kind in tried:
        need_start, need_stop = KINDS[kind]
        fits = np.flatnonzero((s["atg"] | (not need_start)) & (s["stopped"] | (not need_stop)))
        ranked = fits[np.lexsort((s["place"][fits], -s["weight"][fits], s["owner"][fits]))]
        who, top = np.unique(s["owner"][ranked], return_index=True)
        found = np.stack([np.full(len(who), kind), s["codons"][ranked[top]] * 3, s["start"][ranked[top]]], 1)
        better = (found[:, 1] >= min_length) & (found[:, 1] > best[who, 1])
        best[who[better]] = found[better]
    return best


def orfs(sequences: DataFrame, kind: int = 3, min_length: int = 6, keep: tuple[str, ...] = ()) -> DataFrame:
    """(name, orf_kind, orf_start, orf_length, orf_seq, rna_size) and `keep`: the frame of each sequence, if any.

    Kinds 0, 1 and 2 need start and stop, a start, a stop. Kind 3 takes the longest of these,
    kind 4 of these and of frames that need neither; the lowest kind on ties, and within a
    kind the first. Frames under `min_length` don't count. `sequences` has name and seq, of
    capital letters; null and short ones have no frame.
    """
    tried = {3: [0, 1, 2], 4: [0, 1, 2, 4]}.get(kind, [kind])

    @F.pandas_udf("kind int, length int, start int")
    def frame(seq: pd.Series) -> pd.DataFrame:
        return pd.DataFrame(_longest(seq.tolist(), tried, min_length).astype(np.int32), columns=["kind", "length", "start"])

    # A generated column is worked out once, where the function would be for each use of it.
    found = sequences.select("name", "seq", *[c for c in keep if c not in ("name", "seq")]).withColumn("b", F.explode(F.array(frame("seq")))).where("b.kind >= 0")
    return found.select("name", F.col("b.kind").alias("orf_kind"), F.col("b.start").alias("orf_start"), F.col("b.length").alias("orf_length"), F.substring("seq", F.col("b.start"), F.col("b.length")).alias("orf_seq"), F.length("seq").alias("rna_size"), *keep)


def orf_coverage(found: DataFrame) -> DataFrame:
    return found.select("name", "rna_size", "orf_length", (F.col("orf_length") / F.col("rna_size")).alias("orf_cover"))


def chosen_orf(strict: DataFrame, relaxed: DataFrame, share: float = 0.75) -> DataFrame:
    """The strict frame of each sequence if it has more than `share` of the relaxed one's length, else the relaxed one."""
    cols = ["orf_kind", "orf_start", "orf_length", "orf_seq", "rna_size"]
    both = relaxed.select("name", F.struct(*cols).alias("r")).join(strict.select("name", F.struct(*cols).alias("s")), "name", "full")
    keep = F.col("r").isNull() | (F.col("s.orf_length") / F.col("r.orf_length") > share)
    return both.select("name", F.when(F.coalesce(keep, F.lit(False)), F.col("s")).otherwise(F.col("r")).alias("o")).select("name", "o.*")


def genomic_parts(exons: DataFrame, found: DataFrame) -> DataFrame:
    """(transcript_id, chr, strand, feat_level, start, end): exons cut into five_utr, CDS and three_utr.

    `found` has name (the transcript), orf_start and orf_length on the transcript's own sequence.
    Exons of a transcript must not overlap; transcripts without a frame are left out.
    """
    length = F.col("end") - F.col("start") + 1
    along = Window.partitionBy("transcript_id").orderBy(F.when(F.col("strand") == "-", -F.col("end")).otherwise(F.col("start"))).rowsBetween(Window.unboundedPreceding, -1)
    placed = exons.select("transcript_id", "chr", "strand", "start", "end", (F.coalesce(F.sum(length).over(along), F.lit(0)) + 1).alias("first")).withColumn("last", F.col("first") + F.col("end") - F.col("start"))
    frame = found.select(F.col("name").alias("transcript_id"), F.col("orf_start").cast("long").alias("b"), (F.col("orf_start") + F.col("orf_length") - 1).cast("long").alias("e"))
    top = F.lit((1 << 62)).cast("long")
    parts = F.array(*[F.struct(F.lit(n).alias("feat_level"), a.alias("a"), z.alias("z")) for n, a, z in (("five_utr", F.lit(1).cast("long"), F.col("b") - 1), ("CDS", F.col("b"), F.col("e")), ("three_utr", F.col("e") + 1, top))])
    cut = placed.join(frame, "transcript_id").withColumn("p", F.explode(parts)).withColumn("a", F.greatest("first", "p.a")).withColumn("z", F.least("last", "p.z")).where("a <= z")
    minus = F.col("strand") == "-"
    return cut.select(
        "transcript_id", "chr", "strand", "p.feat_level",
        F.when(minus, F.col("end") - (F.col("z") - F.col("first"))).otherwise(F.col("start") + F.col("a") - F.col("first")).alias("start"),
        F.when(minus, F.col("end") - (F.col("a") - F.col("first"))).otherwise(F.col("start") + F.col("z") - F.col("first")).alias("end"),
    )


#: Sequences are cut into runs of about so many k-mers first: taking letters from far inside a long string is slow.
RUN = 240


def kmers(sequences: DataFrame, k: int, step: int = 1, keys: tuple[str, ...] = ()) -> DataFrame:
    """(keys, kmer): every k letters of seq, from the first on in steps; shorter sequences have none."""
    run = max(RUN // step, 1) * step
    pieces = sequences.where(F.length("seq") >= k).select(*keys, F.explode(runs_of("seq", run, k - 1)).alias("piece")).where(F.length("piece") >= k)
    at = F.sequence(F.lit(1), F.length("piece") - k + 1, F.lit(step))
    return pieces.select(*keys, "piece", F.explode(at).alias("at")).select(*keys, F.substring("piece", F.col("at"), F.lit(k)).alias("kmer"))


def kmer_counts(sequences: DataFrame, k: int, step: int = 1) -> DataFrame:
    return kmers(sequences, k, step).groupBy("kmer").agg(F.count("*").alias("n"))


def kmer_model(coding: DataFrame, noncoding: DataFrame, k: int) -> DataFrame:
    """(kmer, ratio): a k-mer's frequency in coding frames, as a share of that and its frequency elsewhere.

    Frames are read codon by codon (letter by letter if k < 3), other sequences at every letter.
    """
    c = kmer_counts(coding, k, 3 if k >= 3 else 1)
    n = kmer_counts(noncoding, k, 1)
    total = lambda d: d.agg(F.sum("n")).scalar()
    a = c.select("kmer", (F.col("n") / total(c)).alias("fc"))
    b = n.select("kmer", (F.col("n") / total(n)).alias("fn"))
    fc, fn = F.coalesce("fc", F.lit(0.0)), F.coalesce("fn", F.lit(0.0))
    return a.join(b, "kmer", "full").select("kmer", (fc / (fc + fn)).alias("ratio"))


#: A model of at most so many k-mers (4 ** k) may be broadcast.
BROADCAST_KMERS = 4**9


def kmer_scores(sequences: DataFrame, model: DataFrame, k: int) -> DataFrame:
    """(name, score): the mean ratio of a sequence's k-mers; those the model lacks count 0.5."""
    model = F.broadcast(model) if 4**k <= BROADCAST_KMERS else model
    own = kmers(sequences, k, codon_step(k), ("name",)).groupBy("name", "kmer").agg(F.count("*").alias("n"))
    scored = own.join(model, "kmer", "left").groupBy("name").agg(F.sum(F.coalesce("ratio", F.lit(0.5)) * F.col("n")).alias("s"), F.sum("n").alias("m"))
    return scored.select("name", (F.col("s") / F.col("m")).alias("score"))


def codon_step(k: int) -> int:
    """Frames are read codon by codon, letter by letter if k < 3."""
    return 3 if k >= 3 else 1


def all_kmers(sequences: DataFrame, steps: Mapping[int, int], keys: tuple[str, ...] = ()) -> DataFrame:
    """(keys, k, kmer): as `kmers` for several k at once, each with its step (a divisor of RUN)."""
    pieces = sequences.where(F.length("seq") >= min(steps)).select(*keys, F.explode(runs_of("seq", RUN, max(steps) - 1)).alias("piece"))

    def of(k: int) -> Column:
        upto = F.least(F.lit(RUN), F.length("piece") - k + 1)
        at = F.when(upto >= 1, F.sequence(F.lit(1), upto, F.lit(steps[k]))).otherwise(F.array().cast("array<int>"))
        return F.transform(at, lambda i: F.struct(F.lit(k).alias("k"), F.substring("piece", i, F.lit(k)).alias("kmer")))

    return pieces.select(*keys, F.explode(F.concat(*[of(k) for k in steps])).alias("x")).select(*keys, "x.k", "x.kmer")


_DIGIT = np.full(256, 4, np.int64)
_DIGIT[[ord(x) for x in "ACGT"]] = range(4)
_OTHER_LETTERS = "[^ACGT]"
#: So many letters are worked on at once.
SCORED_LETTERS = 1 << 20
#: k-mers of at most so many of A, C, G and T are numbers of 64 bits.
NUMBERED = 31


def _letters_at_once(raw: list[bytes]) -> Iterator[tuple[int, int]]:
    """Neighbouring texts of about SCORED_LETTERS in all, from and up to."""
    upto, a = np.cumsum([0, *map(len, raw)]), 0
    while a < len(raw):
        z = max(a + 1, int(np.searchsorted(upto, upto[a] + SCORED_LETTERS, "right")) - 1)
        yield a, z
        a = z


def _numbers(digit: np.ndarray, p: np.ndarray, k: int) -> np.ndarray:
    """The k digits from each of `p` on as a number to base 4."""
    code = np.zeros(len(p), np.int64)
    for i in range(k):
        code = code * 4 + digit[p + i]
    return code


def _numbered(seqs: list[str | None], steps: Mapping[int, int]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(k, which text, number) of the k-mers of A, C, G and T alone, each as a number to base 4."""
    raw = [s.encode("ascii", "replace") if s else b"" for s in seqs]
    for a, z in _letters_at_once(raw):
        sizes = np.array([len(x) for x in raw[a:z]])
        digit = _DIGIT[np.frombuffer(b"".join(raw[a:z]), np.uint8)]
        owner = np.repeat(np.arange(z - a), sizes)
        at = np.arange(len(digit)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        odd = np.append(0, np.cumsum(digit > 3))
        for k, step in steps.items():
            p = np.flatnonzero((at % step == 0) & (at + k <= sizes[owner]))
            p = p[odd[p + k] == odd[p]]
            yield k, owner[p] + a, _numbers(digit, p, k)


def numbered_kmers(sequences: DataFrame, k: int, step: int = 1) -> DataFrame:
    """(name, number): as `kmers` of A, C, G and T alone, each as a number to base 4."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for _, whose, number in _numbered(b["seq"].to_pylist(), {k: step}):
                yield pa.record_batch({"name": b["name"].take(pa.array(whose)), "number": number})

    return sequences.select("name", "seq").mapInArrow(cut, StructType([sequences.schema["name"], StructField("number", LongType())]))


def numbered_counts(sequences: DataFrame, steps: Mapping[int, int]) -> DataFrame:
    """(k, number, n): as `numbered_kmers` for several k at once, counted over some texts at a time."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for k, _, number in _numbered(b["seq"].to_pylist(), steps):
                known, n = np.unique(number, return_counts=True)
                yield pa.record_batch({"k": np.full(len(known), k, np.int32), "number": known, "n": n})

    return sequences.select("seq").mapInArrow(count, "k int, number long, n long")


def kmer_models(coding: DataFrame, noncoding: DataFrame, ks: Sequence[int]) -> DataFrame:
    """(k, kmer, ratio): as `kmer_model` for several k, over `seq` of coding frames and of other sequences."""
    sides = [(coding, {k: codon_step(k) for k in ks}, "c"), (noncoding, dict.fromkeys(ks, 1), "n")]
    of = lambda n: [F.sum(F.when(F.col("side") == x, F.col(n))).alias(x) for x in "cn"]
    numbers, odd = [], []
    for d, steps, side in sides:
        if small := {k: s for k, s in steps.items() if k <= NUMBERED}:
            numbers.append(numbered_counts(d, small).withColumn("side", F.lit(side)))
        # k-mers with other letters, and very long ones, are counted by their letters.
        whole = all_kmers(d if len(small) < len(steps) else d.where(F.col("seq").rlike(_OTHER_LETTERS)), steps)
        odd.append(whole.where((F.col("k") > NUMBERED) | F.col("kmer").rlike(_OTHER_LETTERS)).withColumn("side", F.lit(side)))
    counts = reduce(DataFrame.unionByName, odd).withColumn("n", F.lit(1)).groupBy("k", "kmer").agg(*of("n"))
    if numbers:
        known = reduce(DataFrame.unionByName, numbers).groupBy("k", "number").agg(*of("n"))
        spelled = F.translate(F.lpad(F.conv(F.col("number").cast("string"), 10, 4), F.col("k"), F.lit("0")), "0123", "ACGT")
        counts = known.select("k", spelled.alias("kmer"), "c", "n").unionByName(counts)
    counts = counts.fillna(0, ["c", "n"])
    totals = counts.groupBy("k").agg(F.sum("c").alias("all_c"), F.sum("n").alias("all_n"))  # a row for each k
    fc, fn = (F.coalesce(F.try_divide(x, f"all_{x}"), F.lit(0.0)) for x in "cn")
    return counts.join(F.broadcast(totals), "k").select("k", "kmer", (fc / (fc + fn)).alias("ratio"))


def _mean_ratios(seqs: list[str | None], tables: dict[int, np.ndarray], others: dict[str, float]) -> np.ndarray:
    """For each text and k the mean ratio of its k-mers; no number where it has none. `tables` has a
    ratio for every k-mer of A, C, G and T, as a number to base 4, `others` those with other letters."""
    raw = [s.encode("ascii", "replace") if s else b"" for s in seqs]
    out = np.full((len(raw), len(tables)), np.nan)
    for a, z in _letters_at_once(raw):
        sizes = np.array([len(x) for x in raw[a:z]])
        digit = _DIGIT[np.frombuffer(b"".join(raw[a:z]), np.uint8)]
        owner = np.repeat(np.arange(z - a), sizes)
        at = np.arange(len(digit)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        odd = np.append(0, np.cumsum(digit > 3))
        digit &= 3
        for c, (k, table) in enumerate(tables.items()):
            p = np.flatnonzero((at % codon_step(k) == 0) & (at + k <= sizes[owner]))
            ratio = table[_numbers(digit, p, k)]
            for i in np.flatnonzero(odd[p + k] > odd[p]):
                ratio[i] = others.get(seqs[a + owner[p[i]]][at[p[i]] : at[p[i]] + k], 0.5)
            n = np.bincount(owner[p], minlength=z - a)
            out[a:z, c] = np.divide(np.bincount(owner[p], ratio, z - a), n, out=out[a:z, c].copy(), where=n > 0)
    return out


def _ratio_tables(model: DataFrame, ks: Sequence[int]) -> tuple[dict[int, np.ndarray], dict[str, float]]:
    """The model of these k as `_mean_ratios` takes it; k-mers it lacks have 0.5."""
    tables, others = {k: np.full(4**k, 0.5) for k in ks}, {}
    for r in model.where(F.col("k").isin(*ks)).select("k", "kmer", "ratio").toArrow().to_batches():
        for k, kmer, ratio in zip(*(c.to_pylist() for c in r.columns), strict=True):
            if set(kmer) <= set("ACGT"):
                tables[k][int(kmer.translate(_TO_BASE_4), 4)] = ratio
            else:
                others[kmer] = ratio
    return tables, others


_TO_BASE_4 = str.maketrans("ACGT", "0123")


def _met_ratios(frames: DataFrame, model: DataFrame, k: int) -> DataFrame:
    """(name, k, s, m): the sums of the ratios of each frame's k-mers, which are joined to the model, and their number.

    Those of A, C, G and T are joined by number, all others by their letters; rows of a name may be several.
    """
    sums = lambda d: d.groupBy("name").agg(F.sum(F.coalesce("ratio", F.lit(0.5))).alias("s"), F.count("*").alias("m"))
    model, parts, step = model.where(F.col("k") == k).select("kmer", "ratio"), [], codon_step(k)
    odd = F.col("kmer").rlike(_OTHER_LETTERS)
    if k <= NUMBERED:
        number = F.conv(F.translate("kmer", "ACGT", "0123"), 4, 10).cast("long")
        parts.append(sums(numbered_kmers(frames, k, step).join(model.where(~odd).select(number.alias("number"), "ratio"), "number", "left")))
        frames, model = frames.where(F.col("seq").rlike(_OTHER_LETTERS)), model.where(odd)
    own = kmers(frames, k, step, ("name",))
    parts.append(sums((own.where(odd) if k <= NUMBERED else own).join(model, "kmer", "left")))
    return reduce(DataFrame.unionByName, parts).withColumn("k", F.lit(k))


def feature_matrix(found: DataFrame, model: DataFrame, ks: Sequence[int], keep: tuple[str, ...] = ()) -> DataFrame:
    """(name, kmer_score_k..., orf_cover, rna_size) and `keep` of the sequences with an open reading frame.

    `found` has name, orf_seq, orf_length and rna_size, `model` k, kmer and ratio. A score is
    null where the frame is shorter than k. Names are unique. The models of short k-mers are
    read when this is called.
    """
    # Short k-mers are many to a frame, but their models small: they are looked up where the frame is.
    short = [k for k in ks if 4**k <= BROADCAST_KMERS]
    out = found.withColumn("orf_cover", F.col("orf_length") / F.col("rna_size"))
    if short:
        known = found.sparkSession.sparkContext.broadcast(_ratio_tables(model, short))

        @F.pandas_udf(", ".join(f"kmer_score_{k} double" for k in short))
        def means(seq: pd.Series) -> pd.DataFrame:
            return pd.DataFrame(_mean_ratios(seq.tolist(), *known.value), columns=[f"kmer_score_{k}" for k in short])

        out = out.withColumn("s", F.explode(F.array(means("orf_seq")))).select("name", "s.*", "orf_cover", "rna_size", *keep)
    if long := [k for k in ks if k not in short]:
        frames = found.select("name", F.col("orf_seq").alias("seq"))
        met = reduce(DataFrame.unionByName, [_met_ratios(frames, model, k) for k in long])
        mean = lambda k: F.sum(F.when(F.col("k") == k, F.col("s"))) / F.sum(F.when(F.col("k") == k, F.col("m")))
        out = out.join(met.groupBy("name").agg(*[mean(k).alias(f"kmer_score_{k}") for k in long]), "name", "left")
    return out.select("name", *[f"kmer_score_{k}" for k in ks], "orf_cover", "rna_size", *keep)
