"""Nucleotide sequences as column expressions."""

from __future__ import annotations

from itertools import product

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Fixed value: amino acids of the codons in the order T, C, A, G of the standard code.
STANDARD_CODE = "FFLLSSSSYY**CC*WLLLLPPPPHHQQRRRRIIIMTTTTNNKKSSRRVVVVAAAADDEEGGGG"
START, STOPS = "ATG", ("TAA", "TAG", "TGA")


def codon_table() -> dict[str, str]:
    return dict(zip(map("".join, product("TCAG", repeat=3)), STANDARD_CODE, strict=True))


def reverse_complement(seq: Column) -> Column:
    return F.reverse(F.translate(seq, "ACGTacgt", "TGCAtgca"))


def percent_of(seq: Column, letters: str) -> Column:
    """The share of `letters`, either case, in percent; null for an empty sequence."""
    return F.when(F.length(seq) > 0, F.length(F.regexp_replace(seq, f"[^{letters.upper()}{letters.lower()}]", "")) * F.lit(100.0) / F.length(seq))


def gc_percent(seq: Column) -> Column:
    return percent_of(seq, "GC")


def n_percent(seq: Column) -> Column:
    """Whole percent of N; -1 for an empty sequence."""
    return F.coalesce(F.floor(percent_of(seq, "N")).cast("int"), F.lit(-1))


def translated(seq: Column) -> Column:
    """Amino acids of the whole codons; X for codons with other letters than ACGT."""
    table = " ".join(codon_table())

    def amino(c: Column) -> Column:
        at = F.call_function("instr", F.lit(table), c)
        return F.when(at > 0, F.substring(F.lit(STANDARD_CODE), F.shiftright(at + 3, 2), F.lit(1))).otherwise("X")

    return F.array_join(F.transform(F.regexp_extract_all(F.upper(seq), F.lit("(?s).{3}"), F.lit(0)), amino), "")


def has_start(seq: Column) -> Column:
    return F.upper(seq).startswith(START)


def has_stop(seq: Column) -> Column:
    return F.upper(F.right(seq, F.lit(3))).isin(*STOPS)
