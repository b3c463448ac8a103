"""Second stage in one call: from sequences and their frames to classes of transcripts.

A tenth of the sequences to learn from makes the k-mer models, the rest a forest; ten folds of
that rest give the cutoff and its metrics, a forest on all of it scores the candidates.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from helixframe.operators import coding
from helixframe.operators import sequences as sq
from helixframe.session import shared_checkpoint

#: The lengths of k-mers.
KMERS = (1, 2, 3, 6, 9, 12)
FRAME = ["name", "seq", "orf_seq", "orf_length", "rna_size"]


def frames_of_sequences(sequences: DataFrame, kind: int = 3, kmers: Sequence[int] = KMERS) -> DataFrame:
    """(name, seq, orf_seq, orf_length, rna_size) of the sequences (name, seq) with a frame of at least twice the longest k-mer."""
    return sq.orfs(sequences.where("name is not null"), kind, 2 * max(kmers), ("seq",)).select(*FRAME)


def frames_of_transcripts(features: DataFrame, chunks: DataFrame, kind: int = 3, kmers: Sequence[int] = KMERS, chunk: int = sq.CHUNK) -> DataFrame:
    """The same of transcripts, from features (transcript_id, chr, strand, feat_level, start, end) on a genome in chunks.

    The RNA is made of the exons. Where a transcript has coding parts, these with its stop codon
    are its frame, and none is searched; a frame of under twice the longest k-mer leaves the
    transcript out.
    """
    rna = sq.cdna(sq.rna_features(features), chunks, chunk).select(F.col("transcript_id").alias("name"), "seq")
    known = sq.cdna(sq.coding_features(features), chunks, chunk).select(F.col("transcript_id").alias("name"), F.col("seq").alias("orf_seq"))
    annotated = rna.join(known.where(F.length("orf_seq") >= 2 * max(kmers)), "name").select("name", "seq", "orf_seq", F.length("orf_seq").alias("orf_length"), F.length("seq").alias("rna_size"))
    return annotated.unionByName(frames_of_sequences(rna.join(known.select("name"), "name", "left_anti"), kind, kmers))


@dataclass(frozen=True)
class CodingPotential:
    """What comes out: the features learnt from with fold and score, the metrics of each fold and
    their mean, the candidates with features, score and label, their classes, and the summary."""

    learning: DataFrame
    metrics: DataFrame
    scored: DataFrame
    classes: DataFrame
    summary: DataFrame
    importances: DataFrame


def learning_parts(coding_frames: DataFrame, other_frames: DataFrame, share: float = 0.1, seed: int = 1) -> DataFrame:
    """Both sides as one table with truth (1 coding, 0 not) and part: model or forest.

    Names alone are numbered, when this is called; the frames are told apart by the last name of
    each side's model part.
    """
    both = coding_frames.select(*FRAME).withColumn("truth", F.lit(1)).unionByName(other_frames.select(*FRAME).withColumn("truth", F.lit(0)))
    parts = coding.holdout_split(shared_checkpoint(both.select("name", "truth")), "name", "truth", share, seed)
    at = F.struct(coding.hash_order(F.col("name"), seed).alias("h"), "name")
    last = {r.truth: r["last"] for r in parts.where("part = 'model'").groupBy("truth").agg(F.max(at).alias("last")).collect()}  # two rows
    part = F.lit("forest")
    for truth, (h, name) in last.items():
        part = F.when((F.col("truth") == truth) & (at <= F.struct(F.lit(h).alias("h"), F.lit(name).alias("name"))), "model").otherwise(part)
    return both.where("name is not null").withColumn("part", part)


def learnt_features(parts: DataFrame, candidates: DataFrame, kmers: Sequence[int] = KMERS) -> tuple[DataFrame, DataFrame]:
    """(the forest's part with features and truth, the candidates with features)."""
    for_model = parts.where("part = 'model'")
    model = shared_checkpoint(sq.kmer_models(for_model.where("truth = 1").select(F.col("orf_seq").alias("seq")), for_model.where("truth = 0").select("seq"), kmers))
    forest = parts.where("part = 'forest'")
    return sq.feature_matrix(forest, model, kmers, ("truth",)), sq.feature_matrix(candidates, model, kmers)


def coding_potential(
    coding_frames: DataFrame, other_frames: DataFrame, candidates: DataFrame, names: DataFrame, kmers: Sequence[int] = KMERS, share: float = 0.1, n_folds: int = 10, trees: int = coding.TREES,
    cutoff: float | None = None, specificities: tuple[float, float] | None = None, most: int | None = None, least: int = 100, seed: int = 1,
) -> CodingPotential:
    """Learn what tells coding frames from others, and class every candidate.

    The three tables of frames are those of `frames_of_sequences` or `frames_of_transcripts`;
    names are unique over the first two, and in the third. `names` (name) holds all candidates,
    so that those without a frame come out as noORF. At most `most` of each side are learnt
    from, fewer than `least` are an error. The cutoff is `cutoff`, else the mean of the folds'
    cutoffs where sensitivity and specificity meet; with `specificities` (of coding, of not
    coding) there are two, and candidates between them are TUCp. Models are fitted when this
    is called.
    """
    sides = [coding.capped(shared_checkpoint(d.select(*FRAME)), "name", most, least, seed) for d in (coding_frames, other_frames)]
    parts = learning_parts(*sides, share, seed)
    learn, test = learnt_features(parts if most is None else shared_checkpoint(parts), shared_checkpoint(candidates.select(*FRAME)), kmers)
    learn, features = shared_checkpoint(learn), [*(f"kmer_score_{k}" for k in kmers), "orf_cover", "rna_size"]
    folded = shared_checkpoint(coding.cross_validated(learn, "name", features, "truth", n_folds, trees, seed))
    curve = coding.cutoff_curve(folded.select("fold", "score", "truth"))
    if specificities:
        # Specificity of non-coding ones is the sensitivity for coding ones.
        high, low = coding.two_cutoffs(curve, *specificities).first()
    else:
        high = low = cutoff if cutoff is not None else coding.balanced_cutoffs(curve).agg(F.avg("cutoff")).first()[0]
    metrics = coding.with_mean(coding.confusion(coding.labelled(folded, high), ["fold"]))
    model = coding.fitted_forest(learn, features, "truth", trees, seed)
    scored = shared_checkpoint(coding.labelled(coding.forest_scores(model, test, features), high, low))
    classes = coding.routed(names.select("name").distinct(), scored, "name")
    return CodingPotential(folded, metrics, scored, classes, coding.label_summary(scored, high, low), coding.feature_importances(learn, features, "truth", trees, seed, model))
