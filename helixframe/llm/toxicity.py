"""Abusive, hateful or sexual passages, found by compression distance.

Two zstandard dictionaries are trained on labelled documents, one on toxic passages, one on
ordinary text. A window of text that the toxic dictionary compresses better than the ordinary
one is suspicious; a document's score is the largest such gain, in bytes, of two neighbouring
windows. The threshold is calibrated on all labelled documents that the dictionaries haven't
seen and on the scores of the whole corpus.
"""

from __future__ import annotations

import math
import re
import unicodedata
from collections import Counter
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StructField, StructType

from helixframe.session import shared_checkpoint

#: At most so many labelled documents (the first by hash) make the dictionaries.
FIT_DOCUMENTS = 4_500
WINDOW, STRIDE = 40, 10
#: The most bytes that training may give the dictionaries; it reads all samples, whatever their number.
TOXIC_BYTES, ORDINARY_BYTES = 1 << 18, 1 << 20
#: Letters of a sample of ordinary text.
SAMPLE = 200
#: What training takes as a segment, in letters: passages are short, ordinary sentences are not.
TOXIC_SEGMENT, ORDINARY_SEGMENT = 60, 500
LEVEL = 3

#: Letters that scanning mistakes for each other count as one.
CONFUSED = ["ce", "ao0", "nu", "li1!|jt", "hb", "vy"]
#: Other spellings of a language's code.
LANGUAGES = {"eng": "en", "deu": "de", "ger": "de", "fra": "fr", "fre": "fr", "spa": "es"}

_BROKEN = re.compile(r"[-=‐¬­–]\s*\n\s*")
_SPACED = re.compile(rb" [a-z] [a-z] [a-z] (?:[a-z] )*[a-z]\b")
_FOLD = bytearray(range(256))
for _c in range(65, 91):
    _FOLD[_c] = _c + 32
_LOWER = bytes(_FOLD)
for _group in CONFUSED:
    for _c in _group.encode():
        _FOLD[_c] = _group.encode()[0]
_FOLDED = bytes(_FOLD)
_MARKS = b".,;:-*_'\"()=~/"


def folded(text: str) -> bytes:
    """Text without what scanning and hiding do to it: broken words joined, spaced letters
    closed up, marks, accents and case dropped, letters that look alike made the same."""
    plain = unicodedata.normalize("NFKD", _BROKEN.sub("", text).replace("ſ", "s").replace("ß", "ss")).encode("ascii", "ignore")
    words = b" ".join(plain.translate(_LOWER, _MARKS).split())
    return _SPACED.sub(lambda m: b" " + m[0].replace(b" ", b""), words).translate(_FOLDED)


def windows(text: bytes) -> list[bytes]:
    return [text[i : i + WINDOW] for i in range(0, max(1, len(text) - WINDOW + STRIDE), STRIDE)]


class Gain:
    """How many bytes less the toxic dictionary needs for a window than the ordinary one."""

    def __init__(self, toxic: zstandard.ZstdCompressionDict, ordinary: zstandard.ZstdCompressionDict) -> None:
        params = zstandard.ZstdCompressionParameters.from_level(LEVEL, write_content_size=False, write_checksum=False, write_dict_id=False)
        self.toxic, self.ordinary = (zstandard.ZstdCompressor(dict_data=d, compression_params=params) for d in (toxic, ordinary))

    def of(self, window: bytes) -> int:
        return len(self.ordinary.compress(window)) - len(self.toxic.compress(window))

    def score(self, text: str | None) -> int:
        """The largest gain of two neighbouring windows; LEAST for texts with nothing to read."""
        plain = folded(text or "")
        if not plain:
            return LEAST
        gains = list(map(self.of, windows(plain)))
        return max(map(sum, zip(gains, gains[1:] or gains, strict=False)))


#: Below any score of a text with letters.
LEAST = -10 * WINDOW


@dataclass(frozen=True)
class Dictionaries:
    """Two trained dictionaries; `raw` ones are the samples themselves, where training had too few."""

    toxic: bytes
    ordinary: bytes
    raw: tuple[bool, bool] = (False, False)

    def gain(self) -> Gain:
        kinds = (zstandard.DICT_TYPE_RAWCONTENT if r else zstandard.DICT_TYPE_FULLDICT for r in self.raw)
        return Gain(*(zstandard.ZstdCompressionDict(d, dict_type=k) for d, k in zip((self.toxic, self.ordinary), kinds, strict=True)))


def trained(samples: list[bytes], most: int, segment: int) -> tuple[bytes, bool]:
    """(dictionary, raw): trained on all samples; where they are too few to train on, they are it."""
    try:
        return zstandard.train_dictionary(most, samples, k=segment, d=8, level=LEVEL).as_bytes(), False
    except zstandard.ZstdError:
        return b"\n".join(samples), True


def _pairs(text: bytes) -> list[tuple[bytes, bytes]]:
    words = text.split(b" ")
    return list(zip(words, words[1:], strict=False))


def pair_weights(texts: list[bytes], toxic: list[int], langs: list[str]) -> dict[tuple[bytes, bytes], float]:
    """The log odds of a pair of words in toxic documents. Ordinary documents count as many as
    the toxic ones of their language, so that a language isn't taken for abuse."""
    n = Counter(zip(langs, toxic, strict=True))
    seen = (Counter(), Counter())
    for text, y, lang in zip(texts, toxic, langs, strict=True):
        share = 1.0 if y else (n[lang, 1] + 1) / (n[lang, 0] + 1)
        for p in set(_pairs(text)):
            seen[y][p] += share
    return {p: math.log((seen[1][p] + 0.3) / (seen[0][p] + 0.3)) for p in seen[0].keys() | seen[1].keys() if seen[0][p] + seen[1][p] >= 2}


#: A pair of words counts for at most PAIR_MOST towards a passage, less PAIR_COST; a passage ends where
#: its sum falls by PAIR_DROP, and is one from PASSAGE_LEAST on.
PAIR_MOST, PAIR_COST, PAIR_DROP, PASSAGE_LEAST = 4.0, 1.2, 2.0, 6.0


def passages(text: bytes, weights: dict, least: float = PASSAGE_LEAST) -> list[bytes]:
    """Stretches of words whose pairs add up to `least` or more, without ordinary words at their ends."""
    words, found = text.split(b" "), []
    total = best = 0.0
    first = start = end = 0
    gains = [min(weights.get(p, 0.0), PAIR_MOST) - PAIR_COST for p in _pairs(text)]
    for i, g in enumerate([*gains, -math.inf]):
        if total <= 0:
            total, first = 0.0, i
        total += g
        if total > best:
            best, start, end = total, first, i
        if total < best - PAIR_DROP:
            if best >= least:
                found.append(b" ".join(words[start : end + 2]))
            total = best = 0.0
    return found


def fit_dictionaries(rows: list[tuple[str, int, str]]) -> Dictionaries | None:
    """The two dictionaries from (text, toxic, language); None if a class is missing.

    Trained on all toxic passages (whole toxic documents if none has any), and on all text of the
    ordinary documents without a passage that looks toxic (of all of them if each has one).
    """
    texts, toxic, langs = [folded(t) for t, _, _ in rows], [y for _, y, _ in rows], [lang for _, _, lang in rows]
    if len(set(toxic)) < 2:
        return None
    weights = pair_weights(texts, toxic, langs)
    bad, good = ([t for t, y in zip(texts, toxic, strict=True) if y == side] for side in (1, 0))
    abuse = [p for t in bad for p in passages(t, weights)] or bad
    plain = [t for t in good if not passages(t, weights, 4.0)] or good
    (a, a_raw), (o, o_raw) = trained(abuse, TOXIC_BYTES, TOXIC_SEGMENT), trained([t[i : i + SAMPLE] for t in plain for i in range(0, len(t), SAMPLE)], ORDINARY_BYTES, ORDINARY_SEGMENT)
    return Dictionaries(a, o, (a_raw, o_raw))


def language(c: Column) -> Column:
    """The two-letter code; `und` where there is none."""
    code = F.lower(F.trim(F.substring_index(F.substring_index(c, "-", 1), "_", 1)))
    for k, v in LANGUAGES.items():
        code = F.when(code == k, v).otherwise(code)
    return F.coalesce(code, F.lit("und"))


def judged_documents(labels: DataFrame, doc_id: str, toxic: str) -> DataFrame:
    """(doc_id, y): documents on which all reviewers agree."""
    return labels.where(F.col(doc_id).isNotNull() & F.col(toxic).isNotNull()).groupBy(F.col(doc_id).cast("long").alias("doc_id")).agg(F.max(toxic).alias("y"), F.min(toxic).alias("low")).where("y = low").select("doc_id", F.col("y").cast("int").alias("y"))


def _chosen(judged: DataFrame, fit_documents: int) -> DataFrame:
    """Three of four judged documents, at most `fit_documents`, by hashes of their ids alone."""
    to_fit = F.pmod(F.xxhash64("doc_id", F.lit("fit")), F.lit(4)) > 0
    return judged.where(to_fit).orderBy(F.xxhash64("doc_id", F.lit("order")), "doc_id").limit(fit_documents)


def held_out_documents(judged: DataFrame, fit_documents: int = FIT_DOCUMENTS) -> DataFrame:
    """The judged documents that no dictionary has seen."""
    return judged.join(F.broadcast(_chosen(judged, fit_documents).select("doc_id")), "doc_id", "left_anti")


def toxicity_scores(df: DataFrame, doc_id: str, text: str, lang: str, labels: DataFrame, label_id: str = "doc_id", toxic: str = "toxic", fit_documents: int = FIT_DOCUMENTS, keep: Sequence[str] = ()) -> tuple[DataFrame, DataFrame]:
    """((doc_id, score, the columns `keep`) of every row, the labelled documents not used for the dictionaries).

    Three of four labelled documents, at most `fit_documents`, make the dictionaries; their texts
    come to the driver, so that is what bounds it. Scoring runs at once (the scores are checkpointed,
    being read several times). Null, empty
    and blank texts score LEAST. Without labels of both kinds every other text scores 0.
    """
    spark = df.sparkSession
    judged = judged_documents(labels, label_id, toxic)
    chosen = _chosen(judged, fit_documents)
    kept = {f"_keep{i}": c for i, c in enumerate(keep)}
    docs = df.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"), language(F.col(lang)).alias("lang"), *[F.col(c).alias(k) for k, c in kept.items()])
    # `chosen` has at most fit_documents rows, so its broadcast is bounded.
    sample = docs.join(F.broadcast(chosen), "doc_id").where(F.length("text") > 0).orderBy("doc_id").limit(fit_documents)
    fitted = fit_dictionaries([(r.text, r.y, r.lang) for r in sample.collect()])
    shared = spark.sparkContext.broadcast(fitted)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gain = shared.value.gain() if shared.value else None
        for batch in batches:
            texts = batch.column(1).to_pylist()
            scores = [gain.score(t) if gain else 0 if t and t.strip() else LEAST for t in texts]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(scores, pa.int32()), *batch.columns[2:]], ["doc_id", "score", *kept])

    carried = [x for x in docs.schema.fields if x.name in kept]
    schema = StructType([StructField("doc_id", LongType()), StructField("score", IntegerType()), *carried])
    scored = docs.select("doc_id", "text", *kept).mapInArrow(run, schema).withColumnsRenamed(kept)
    return shared_checkpoint(scored), held_out_documents(judged, fit_documents)


#: The lowest threshold is taken whose F measure is within this of the best: a passage missed is worse than one reviewed in vain.
TOLERANCE = 0.01


def calibrated_threshold(scored: DataFrame, held_out: DataFrame) -> int:
    """The score from which documents are called toxic, by the F measure expected in the corpus.

    Reviewers err: the share of documents called toxic that score like the lower half of the
    ordinary ones, and of those called ordinary that score like the upper half of the toxic
    ones, tell how often, and recall is worked out without them. Precision rests on the scores
    of the whole corpus and on how many toxic documents these imply, as people are given
    suspicious documents to judge more often than others.
    """
    hist = scored.join(held_out, "doc_id").groupBy("score", "y").count().collect()
    corpus = Counter({r.score: r["count"] for r in scored.groupBy("score").count().collect()})
    toxic, ordinary = (Counter({r.score: r["count"] for r in hist if r.y == y}) for y in (1, 0))
    if not toxic or not ordinary:
        return 1

    def above(c: Counter, t: int) -> float:
        return sum(n for s, n in c.items() if s >= t) / max(1, c.total())

    median = lambda c: sorted(c.elements())[c.total() // 2]
    low, high = median(ordinary), median(toxic)
    wrong_toxic = (1 - above(toxic, low)) / max(1 - above(ordinary, low), 1 / ordinary.total())
    wrong_ordinary = above(ordinary, high) / above(toxic, high)
    apart = 1 - wrong_toxic - wrong_ordinary
    if apart <= 0:  # labels that say nothing about scores
        return max(low + 1, high)
    recall = lambda t: min(1.0, max(0.0, ((1 - wrong_ordinary) * above(toxic, t) - wrong_toxic * above(ordinary, t)) / apart))
    share = above(corpus, high) / max(recall(high), 1e-9)
    f = {t: 2 * share * recall(t) / max(share + above(corpus, t), 1e-9) for t in range(low, max(low, high) + 1)}
    return min(t for t, x in f.items() if x >= max(f.values()) - TOLERANCE)


def toxic_documents(df: DataFrame, doc_id: str, text: str, lang: str, labels: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """(doc_id, score, threshold, is_toxic, the columns `keep`) of every document. Scoring runs at once."""
    scored, held_out = toxicity_scores(df, doc_id, text, lang, labels, keep=keep)
    threshold = calibrated_threshold(scored, held_out)
    return scored.select("doc_id", "score", F.lit(threshold).alias("threshold"), (F.col("score") >= threshold).alias("is_toxic"), *keep)


def toxicity_rates(judged: DataFrame, df: DataFrame, doc_id: str, source: str) -> DataFrame:
    """(source, n_docs, n_toxic, rate): rows of `df` by source, null for those without one.

    If `judged` carries the column `source` its rows are counted as they are. Else they are
    found by id, null ids too: each row of `df` counts once, and rows that share an id are
    all toxic if one of them is.
    """
    if source in judged.columns:
        rows = judged.select(F.col(source).alias("source"), "is_toxic")
    else:
        sources = df.select(F.col(doc_id).cast("long").alias("_id"), F.col(source).alias("source"))
        verdicts = judged.groupBy("doc_id").agg(F.max("is_toxic").alias("is_toxic"))
        rows = sources.join(verdicts, sources["_id"].eqNullSafe(verdicts["doc_id"])).select("source", "is_toxic")
    return rows.groupBy("source").agg(F.count("*").alias("n_docs"), F.count_if("is_toxic").alias("n_toxic"), F.avg(F.col("is_toxic").cast("int")).alias("rate"))


def toxicity_quality(judged: DataFrame, labels: DataFrame, label_id: str = "doc_id", toxic: str = "toxic", category: str = "category", lang: str = "lang") -> DataFrame:
    """(lang, category, n, n_found): labelled documents not used for the dictionaries, and how many are called toxic.

    `judged` has doc_id, is_toxic and `lang`; category is that of the labels, `none` for ordinary
    documents. n_found / n is the recall of a category, and the rate of false alarms of `none`,
    both as far as reviewers are right. Documents on which they disagree are left out.
    """
    kinds = labels.where(F.col(toxic) == 1).groupBy(F.col(label_id).cast("long").alias("doc_id")).agg(F.min(category).alias("category"))
    unseen = held_out_documents(judged_documents(labels, label_id, toxic)).join(kinds, "doc_id", "left")
    named = F.when(F.col("y") == 1, F.coalesce("category", F.lit("other"))).otherwise("none")
    rows = judged.select("doc_id", "is_toxic", language(F.col(lang)).alias("lang")).join(unseen, "doc_id")
    return rows.groupBy("lang", named.alias("category")).agg(F.count("*").alias("n"), F.count_if("is_toxic").alias("n_found"))
