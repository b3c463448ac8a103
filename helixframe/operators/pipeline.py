"""The three stages in a row: candidates are filtered, scored for coding potential and classified."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame

from helixframe.operators.candidates import filter_candidates
from helixframe.operators.classify import interactions
from helixframe.operators.coding_potential import CodingPotential, coding_potential, frames_of_transcripts
from helixframe.operators.transcripts import transcript_rollup
from helixframe.session import shared_checkpoint

EXON = ["transcript_id", "gene_id", "chr", "strand", "biotype", "start", "end"]


@dataclass(frozen=True)
class Annotated:
    """The transcripts with their drop_reason, the second stage's results, and the interactions of the lncRNAs."""

    filtered: DataFrame
    potential: CodingPotential
    interactions: DataFrame


def annotate(candidates: DataFrame, annotation: DataFrame, not_coding: DataFrame, chunks: DataFrame, chunk: int, coding_biotype: str = "protein_coding", mono_exonic: int = -1, least: int = 100, **options: object) -> Annotated:
    """Find and classify the lncRNAs among `candidates`.

    All three tables hold features (transcript_id, gene_id, chr, strand, biotype, feat_level,
    start, end): candidates have exons, the annotation those and coding parts, `not_coding` exons of
    transcripts known not to code. Candidates are filtered against the annotation's transcripts
    of `coding_biotype`, which are also learnt from; those classed as lncRNA are classified
    against the whole annotation. `chunks` is the genome in pieces of `chunk` letters; options
    are those of `coding_potential`. The stages before the last run when this is called.
    """
    exons = lambda d: shared_checkpoint(d.where("feat_level = 'exon'").select(*EXON).distinct())
    mine, known = exons(candidates), exons(annotation)
    filtered = shared_checkpoint(filter_candidates(mine, transcript_rollup(mine), known.where(known["biotype"] == coding_biotype), mono_exonic=mono_exonic))
    left = filtered.where("drop_reason is null").select("transcript_id")
    kept = candidates.join(left, "transcript_id", "left_semi")
    frames = [frames_of_transcripts(d, chunks, chunk=chunk) for d in (annotation.where(annotation["biotype"] == coding_biotype), not_coding, kept)]
    potential = coding_potential(*frames, left.withColumnRenamed("transcript_id", "name"), least=least, **options)
    lnc = potential.classes.where("class = 'lncRNA'").select(potential.classes["name"].alias("transcript_id"))
    lnc_exons = shared_checkpoint(mine.join(lnc, "transcript_id", "left_semi"))
    return Annotated(filtered, potential, interactions(transcript_rollup(lnc_exons), lnc_exons, transcript_rollup(known), known))
