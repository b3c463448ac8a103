"""Named queries of the corpus operators."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from helixframe.llm.encoding import decoded_text, token_counts, token_ids
from helixframe.llm.packing import fill_report, pack_documents, packing_faults
from helixframe.llm.toxicity import toxic_documents, toxicity_quality, toxicity_rates
from helixframe.session import shared_checkpoint

#: Where the public vocabularies lie; never copied into this repository.
TOKENIZERS = os.environ.get("HELIXFRAME_TOKENIZERS", "/opt/tokenizers")
RANKS = f"{TOKENIZERS}/byte_bpe_50k.tiktoken"


def _read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def p6_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The token ids of every document."""
    return token_ids(_read(spark, sf_dir, "documents"), "doc_id", "text", RANKS)


def p6_decoded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document, encoded and decoded again."""
    return decoded_text(p6_ids(spark, sf_dir), "doc_id", "ids", RANKS)


def _counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(_read(spark, sf_dir, "documents"), "doc_id", "text", RANKS)


def p7_bins(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The container of every document, or piece of one, for each capacity."""
    return pack_documents(_counts(spark, sf_dir), "doc_id", "n_tokens", _read(spark, sf_dir, "pack_specs"))


def p7_plain_bins(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same with one class in a bin, its room left empty."""
    return pack_documents(_counts(spark, sf_dir), "doc_id", "n_tokens", _read(spark, sf_dir, "pack_specs"), refined=False)


def p7_fill(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How full the containers are, with refined classes and with plain ones."""
    specs = _read(spark, sf_dir, "pack_specs")
    report = lambda q, name: fill_report(q(spark, sf_dir), specs).withColumn("classes", F.lit(name))
    return report(p7_bins, "refined").unionByName(report(p7_plain_bins, "plain"))


def p7_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents packed, containers too full, documents cut wrongly and those with tokens lost, for each capacity."""
    counts, specs = shared_checkpoint(_counts(spark, sf_dir)), _read(spark, sf_dir, "pack_specs")
    return packing_faults(pack_documents(counts, "doc_id", "n_tokens", specs), counts, "doc_id", "n_tokens", specs)


def p8_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The score of every document and whether it is held to be toxic."""
    return toxic_documents(_read(spark, sf_dir, "documents"), "doc_id", "text", "lang", _read(spark, sf_dir, "review_labels"))


def p8_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with an abusive, hateful or sexual passage."""
    return p8_scores(spark, sf_dir).where("is_toxic").select("doc_id")


def p8_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The share of such documents per source."""
    docs = _read(spark, sf_dir, "documents")
    judged = toxic_documents(docs, "doc_id", "text", "lang", _read(spark, sf_dir, "review_labels"), keep=["source"])
    return toxicity_rates(judged, docs, "doc_id", "source")


def p8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many of the held-out labelled documents are found, by language and category."""
    labels = _read(spark, sf_dir, "review_labels")
    judged = toxic_documents(_read(spark, sf_dir, "documents"), "doc_id", "text", "lang", labels, keep=["lang"])
    return toxicity_quality(judged, labels)


QUERIES = {f.__name__: f for f in (p6_ids, p6_decoded, p7_bins, p7_plain_bins, p7_fill, p7_checks, p8_found, p8_scores, p8_rates, p8_quality)}

SQL = {
    "p6_decoded": "select doc_id, coalesce(text, '') as text from documents",
    "p7_checks": "select spec_id, (select count(*) from documents) n_docs, 0 n_over, 0 n_cut, 0 n_off from pack_specs where capacity > 0",
}
