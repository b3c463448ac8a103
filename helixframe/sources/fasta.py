"""FASTA files as (name, seq), and back."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def read_fasta(spark: SparkSession, path: str) -> DataFrame:
    """(name, seq): the first word of each header and the letters below it, one row a record.

    A record begins with `>` at the start of a line; one within a header is part of it. Lines
    may end in either way; blanks within letters are dropped, a header without letters has none.
    """
    records = spark.read.option("lineSep", "\n>").text(path).where(F.trim("value") != "")
    # The separator holds the `>` of all records but a file's first.
    value = F.regexp_replace("value", r"^\s*>", "")
    parts = records.select(F.split(value, r"\r?\n|\r", 2).alias("p"))
    return parts.select(F.regexp_extract(F.get("p", F.lit(0)), r"^\s*(\S+)", 1).alias("name"), F.regexp_replace(F.coalesce(F.get("p", F.lit(1)), F.lit("")), r"\s", "").alias("seq"))


def fasta_record() -> Column:
    """Header and letters of a row with name and seq."""
    return F.concat(F.lit(">"), "name", F.lit("\n"), "seq")


def fasta_text(sequences: DataFrame) -> DataFrame:
    return sequences.select(fasta_record().alias("value"))


def write_fasta(sequences: DataFrame, path: str) -> None:
    fasta_text(sequences).write.mode("error").text(path)
