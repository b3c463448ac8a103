"""Filling containers of fixed capacity with documents of varying length, by harmonic packing.

Class k holds the lengths from just over capacity / (k + 1) to capacity / k, so that k documents
of it always fit. The bins of a class are filled with k documents each, so any worker finds a
document's bin from its number within its class alone.

As such (`refined=False`) a bin holds documents of one class and the room that k of them leave
stays empty. By default the classes are refined: within a class, documents are told apart by
their exact length, so that the room left in a class's bins is known before any document is
placed, and it is given to documents of smaller classes, again so many of each length a bin. Bin
patterns follow from the counts of lengths, never from documents.
"""

from __future__ import annotations

from bisect import bisect_right

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from helixframe.operators.key_balance import number_rows
from helixframe.session import shared_checkpoint

#: Each spec is held as a literal and as arrays on every worker; more are an error.
MAX_SPECS = 1000

#: ([(length or class, documents of it in a bin)], bins).
Pattern = tuple[list[tuple[int, int]], int]


def class_patterns(counts: dict[int, int]) -> list[Pattern]:
    """Patterns from the documents per class: k of class k in a bin, one last bin for the rest."""
    full = [([(k, k)], n // k) for k, n in sorted(counts.items()) if n >= k]
    return full + [([(k, n % k)], 1) for k, n in sorted(counts.items()) if n % k]


def refined_patterns(counts: dict[int, int], capacity: int) -> list[Pattern]:
    """Patterns from the documents per exact length, such that every document has its place.

    Bins are begun class by class, from class 1 on. A bin of class k takes its k documents from
    the largest lengths left in the class, then as many as fit of the largest length left in
    this or a smaller class that fits the room, and so on. A pattern is kept for as many bins
    as the counts allow, so each one uses a length up.
    """
    sizes = sorted(n for n, c in counts.items() if c > 0)
    left = [counts[n] for n in sizes]
    lower = list(range(len(sizes) + 1))  # lower[i]: where to look for a length below place i that isn't used up

    def below(i: int) -> int:
        """One more than the place of the largest length left among the first i."""
        at = i
        while lower[at] != at:
            at = lower[at]
        while lower[i] != at:
            lower[i], i = at, lower[i]
        return at

    patterns: list[Pattern] = []
    while top := below(len(sizes)):
        room, taken = capacity, []
        while top:
            i = top - 1
            take = min(left[i], room // sizes[i])
            taken.append((i, take))
            room -= take * sizes[i]
            top = below(bisect_right(sizes, room, 0, i))
        bins = min(left[i] // q for i, q in taken)
        for i, q in taken:
            left[i] -= q * bins
            if not left[i]:
                lower[i + 1] = i
        patterns.append(([(sizes[i], q) for i, q in taken], bins))
    return patterns


class Places:
    """The bin of a document from its spec, class (or length) and number within both."""

    def __init__(self, patterns_of: dict[int, list[Pattern]]) -> None:
        runs: dict[int, list[tuple[int, int, int]]] = {}
        held: dict[int, int] = {}
        for spec, patterns in patterns_of.items():
            base = 1
            for pattern, bins in patterns:
                for c, q in pattern:
                    group = self.group(spec, c)
                    first = held.get(group, 0)
                    runs.setdefault(group, []).append((first, base, q))
                    held[group] = first + q * bins
                base += bins
        groups = sorted(runs)
        self.groups = np.array(groups, np.int64)
        #: How many documents the groups before have, so that one sorted array serves all.
        self.before = np.cumsum([0, *(held[g] for g in groups)], dtype=np.int64)[:-1]
        table = [(b + first, base, q) for g, b in zip(groups, self.before.tolist(), strict=True) for first, base, q in runs[g]]
        self.firsts, self.bases, self.each = np.array(table or np.zeros((0, 3)), np.int64).reshape(-1, 3).T.copy()

    @staticmethod
    def group(spec, c):
        return (spec << 32) + c

    def bins(self, spec: np.ndarray, c: np.ndarray, rank: np.ndarray) -> np.ndarray:
        place = self.before[np.searchsorted(self.groups, self.group(spec, c))] + rank - 1
        at = np.searchsorted(self.firsts, place, "right") - 1
        return self.bases[at] + (place - self.firsts[at]) // self.each[at]


def pack_documents(counts: DataFrame, doc_id: str, n_tokens: str, specs: DataFrame, refined: bool = True) -> DataFrame:
    """(spec_id, doc_id, piece, n_tokens, bin_id): the container of each document, per spec.

    `specs` has spec_id and capacity, at most MAX_SPECS rows (more is an error); specs with a
    null or non-positive capacity hold nothing and are left out. A document over the capacity
    is cut into full pieces and a rest, piece counts from 1; others stay whole. Documents
    without tokens (null or 0) need no room: they come out in bin 0, other bins count from 1.
    No bin holds more than its capacity. Repeated rows are packed each. `refined` is described
    above. Counting lengths runs at once; of each spec at most as many counts as its capacity
    has tokens come to the driver, however many documents there are.
    """
    spark = counts.sparkSession
    capacities = [(r.spec_id, int(r.capacity)) for r in specs.where("capacity > 0").select("spec_id", "capacity").distinct().limit(MAX_SPECS + 1).collect()]
    if len(capacities) > MAX_SPECS:
        raise ValueError(f"more than {MAX_SPECS} container specs")
    if not capacities:
        return spark.createDataFrame([], "spec_id int, doc_id long, piece int, n_tokens long, bin_id long")
    # Read three times below, and dear to make.
    sizes = shared_checkpoint(counts.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(n_tokens).cast("long"), F.lit(0)).alias("n")))
    options = F.array(*[F.struct(F.lit(s).cast("int").alias("spec_id"), F.lit(i).alias("spec_no"), F.lit(c).cast("long").alias("cap")) for i, (s, c) in enumerate(capacities)])
    per_spec = sizes.select("doc_id", "n", F.explode(options).alias("o")).select("doc_id", "n", "o.*")
    cut = per_spec.withColumn("piece", F.explode(F.sequence(F.lit(1), F.greatest(F.lit(1), F.ceil(F.col("n") / F.col("cap")).cast("int")))))
    pieces = cut.withColumn("size", F.least("cap", F.col("n") - (F.col("piece") - 1) * F.col("cap")))
    cls = F.col("size") if refined else F.when(F.col("size") > 0, F.floor(F.col("cap") / F.col("size"))).otherwise(0)
    pieces = pieces.select("spec_id", "spec_no", "doc_id", "piece", "size", cls.cast("int").alias("cls"))

    held: dict[int, dict[int, int]] = {i: {} for i in range(len(capacities))}
    for r in pieces.where("size > 0").groupBy("spec_no", "cls").count().collect():
        held[r.spec_no][r.cls] = r["count"]
    shared = spark.sparkContext.broadcast(Places({i: refined_patterns(held[i], c) if refined else class_patterns(held[i]) for i, (_, c) in enumerate(capacities)}))

    @F.pandas_udf("long")
    def bin_of(spec_no: pd.Series, cls: pd.Series, rank: pd.Series) -> pd.Series:
        return pd.Series(shared.value.bins(*(x.to_numpy(np.int64) for x in (spec_no, cls, rank))))

    ranked = number_rows(pieces.where("size > 0"), ["spec_no", "cls"], "doc_id", ["piece", "size"])
    packed = ranked.select("spec_id", "doc_id", "piece", F.col("size").alias("n_tokens"), bin_of("spec_no", "cls", "rank").alias("bin_id"))
    empty = pieces.where("size = 0").select("spec_id", "doc_id", "piece", F.col("size").alias("n_tokens"), F.lit(0).cast("long").alias("bin_id"))
    return packed.unionAll(empty)


def fill_report(packed: DataFrame, specs: DataFrame) -> DataFrame:
    """(spec_id, capacity, n_bins, n_tokens, fullest, fill): how full the bins of each spec are."""
    bins = packed.where("bin_id > 0").groupBy("spec_id", "bin_id").agg(F.sum("n_tokens").alias("held"))
    used = bins.groupBy("spec_id").agg(F.count("*").alias("n_bins"), F.sum("held").alias("n_tokens"), F.max("held").alias("fullest"))
    return used.join(specs.select("spec_id", "capacity").distinct(), "spec_id").select(
        "spec_id", "capacity", "n_bins", "n_tokens", "fullest", (F.col("n_tokens") / (F.col("n_bins") * F.col("capacity"))).alias("fill")
    )


def packing_faults(packed: DataFrame, counts: DataFrame, doc_id: str, n_tokens: str, specs: DataFrame) -> DataFrame:
    """(spec_id, n_docs, n_over, n_cut, n_off): documents packed, and what is wrong with that, per spec.

    n_over counts bins that hold more than the capacity, n_cut documents in another number of
    pieces than their length calls for (one, up to the capacity), n_off documents whose pieces
    don't add up to their length. `counts` has a document id once.
    """
    caps = specs.where("capacity > 0").select("spec_id", "capacity").distinct()
    over = packed.where("bin_id > 0").groupBy("spec_id", "bin_id").agg(F.sum("n_tokens").alias("held")).join(caps, "spec_id").groupBy("spec_id").agg(F.count_if(F.col("held") > F.col("capacity")).alias("n_over"))
    truth = counts.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(n_tokens), F.lit(0)).alias("n"))
    docs = packed.groupBy("spec_id", "doc_id").agg(F.sum("n_tokens").alias("held"), F.count("*").alias("pieces")).join(truth, "doc_id").join(caps, "spec_id")
    wanted = F.greatest(F.lit(1), F.ceil(F.col("n") / F.col("capacity")))
    found = docs.groupBy("spec_id").agg(F.count("*").alias("n_docs"), F.count_if(F.col("pieces") != wanted).alias("n_cut"), F.count_if(F.col("held") != F.col("n")).alias("n_off"))
    return found.join(over, "spec_id", "left").select("spec_id", "n_docs", F.coalesce("n_over", F.lit(0)).alias("n_over"), "n_cut", "n_off")
