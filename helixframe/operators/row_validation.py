"""Loading raw GTF lines: good ones typed, bad ones apart with the reason.

Every line is parsed into cells (row, column, value); a rule table is joined by column, each
rule is evaluated on its cell, failures are aggregated per line, and the clean lines are what
an anti-join with the failures leaves.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: The rules, in the order in which reasons apply. Column 0 is the line itself.
RULES = [(1, "columns", 0), (2, "frame", 8), (3, "quoting", 9), (4, "ids", 9)]
COLUMNS = ["chr", "source", "feat_level", "start_pos", "end_pos", "score", "strand", "frame", "attributes"]
#: A cell of pairs parted by semicolons. Every repeat is possessive, so a cell is read once and without recursion.
_BARE = r"[\p{L}\p{N}._:-]++"
_LIST = rf"""\A[\s;]*+(?:[^\s";]++\s++(?:"[^"]*+"|{_BARE})\s*+(?:;[\s;]*+|\z))*+\z"""


def _with_filled(key: str) -> str:
    """A cell with a pair of `key` whose value isn't blank; semicolons within quotes part nothing."""
    pair = rf"""\s*+{key}\s++(?:"\s*+[^"\s][^"]*+"|{_BARE})\s*+(?:;|\z)"""
    return rf"""\A(?:(?!{pair})(?:[^";]++|"[^"]*+")*+;)*+{pair}"""


_SPLIT = "\u0001"


def attribute_pairs(attributes: Column) -> Column:
    """The `key value` pairs of a column 9, cut at semicolons outside double quotes."""
    parts = F.split(F.translate(attributes, _SPLIT, "\u0002"), '"', -1)
    cut = F.transform(parts, lambda s, i: F.when(i % 2 == 0, F.translate(s, ";", _SPLIT)).otherwise(s))
    pairs = F.transform(F.split(F.array_join(cut, '"'), _SPLIT, -1), lambda p: F.regexp_replace(p, r"^\s+|\s+$", ""))
    return F.filter(pairs, lambda p: p != "")


def attribute_value(pairs: Column, key: str) -> Column:
    """The last value under `key`, without its quotes; null if absent."""
    of_key = F.filter(pairs, lambda p: p.rlike(rf"^\Q{key}\E\s"))
    return F.regexp_replace(F.regexp_replace(F.try_element_at(of_key, F.lit(-1)), r"^\S+\s+", ""), r'^"|"$', "")


def _lines(df: DataFrame, line_id: str, line: str) -> DataFrame:
    text = F.regexp_replace(F.col(line), r"\r+$", "")
    return df.select(F.col(line_id).alias("line_id"), text.alias("line")).where((F.trim("line") != "") & ~F.col("line").startswith("#") & ~F.col("line").startswith("track"))


def failed_rules(df: DataFrame, line_id: str = "line_id", line: str = "line") -> DataFrame:
    """(line_id, line, reason, reasons): lines that break a rule, with the first and all reasons.

    Carriage returns at the end are dropped; null and blank lines and those beginning with `#`
    or `track` are no rows. Repeated lines are judged each; if a line id comes again with
    another line, each line is judged by itself. An empty table gives none.
    """
    spark = df.sparkSession
    rules = spark.createDataFrame(RULES, "rule int, reason string, col_no int")
    rows = _lines(df, line_id, line).withColumn("cells", F.split("line", "\t", -1))
    cells = rows.select(
        "line_id",
        "line",
        F.try_element_at("cells", F.lit(3)).alias("level"),
        F.posexplode(F.concat(F.array(F.size("cells").cast("string")), "cells")).alias("col_no", "value"),
    )
    value, level = F.col("value"), F.col("level")
    passes = (
        F.when(F.col("rule") == 1, value == str(len(COLUMNS)))
        .when(F.col("rule") == 2, value.isin("0", "1", "2", "."))
        .when(F.col("rule") == 3, value.rlike(_LIST))
        .when(F.col("rule") == 4, value.rlike(_with_filled("gene_id")) & ((level == "gene") | value.rlike(_with_filled("transcript_id"))))
    )
    return (
        cells.join(F.broadcast(rules), "col_no")
        .where(~passes)
        .groupBy("line_id", "line")
        .agg(F.array_sort(F.collect_set(F.struct("rule", "reason"))).alias("failed"))
        .select("line_id", "line", F.col("failed")[0]["reason"].alias("reason"), F.col("failed.reason").alias("reasons"))
    )


def bad_lines(df: DataFrame, line_id: str = "line_id", line: str = "line") -> DataFrame:
    """(line_id, reason): the lines that fail, once each (repeats of id and line are one line)."""
    return failed_rules(df, line_id, line).select("line_id", "reason")


def clean_rows(df: DataFrame, line_id: str = "line_id", line: str = "line") -> DataFrame:
    """Lines that fail no rule, typed: line_id, the nine columns, gene_id and transcript_id.

    Coordinates that are no whole numbers, and scores of `.` that are no number, become null.
    """
    # A line is known by its id and 128 bits of hashes, so failed texts aren't shuffled again.
    marks = [F.xxhash64("line", F.lit(x)) for x in ("a", "b")]
    failed = failed_rules(df, line_id, line).select(F.col("line_id").alias("_i"), *[m.alias(f"_f{i}") for i, m in enumerate(marks)])
    rows = _lines(df, line_id, line).select("line_id", "line", *[m.alias(f"_m{i}") for i, m in enumerate(marks)])
    kept = rows.join(failed, rows["line_id"].eqNullSafe(failed["_i"]) & (rows["_m0"] == failed["_f0"]) & (rows["_m1"] == failed["_f1"]), "left_anti")
    cells = kept.select("line_id", F.split("line", "\t", -1).alias("c"))
    pairs = attribute_pairs(F.get("c", F.lit(8)))
    typed = {"start_pos": lambda c: c.try_cast("long"), "end_pos": lambda c: c.try_cast("long"), "score": lambda c: c.try_cast("double")}
    return cells.select(
        "line_id",
        *[typed.get(n, lambda c: c)(F.get("c", F.lit(i))).alias(n) for i, n in enumerate(COLUMNS)],
        attribute_value(pairs, "gene_id").alias("gene_id"),
        attribute_value(pairs, "transcript_id").alias("transcript_id"),
    )
