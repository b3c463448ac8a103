"""Token ids of whole corpora by a public byte-level BPE vocabulary."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession

from helixframe.llm.byte_bpe import ByteBpe, encoder, read_ranks

#: Texts of one batch are encoded together up to this many characters.
GROUP_CHARS = 4_000_000


def share_tokens(spark: SparkSession, rank_file: str) -> Broadcast:
    """The vocabulary, read once by the driver: some ten thousand short tokens."""
    return spark.sparkContext.broadcast(tuple(read_ranks(rank_file)))


def _groups(ids: list, texts: list[str | None]) -> Iterator[tuple[list, list[str | None]]]:
    at = chars = 0
    for i, t in enumerate(texts):
        chars += len(t or "")
        if chars >= GROUP_CHARS:
            yield ids[at : i + 1], texts[at : i + 1]
            at, chars = i + 1, 0
    if at < len(texts):
        yield ids[at:], texts[at:]


def token_ids(df: DataFrame, doc_id: str, text: str, rank_file: str) -> DataFrame:
    """(doc_id, ids): one row for each row of `df`, its text's ids without special tokens.

    Null and empty texts have an empty list, and strings of special tokens are ordinary text.
    Texts are encoded whole, however long. Repeated rows come out repeated.
    """
    tokens = share_tokens(df.sparkSession, rank_file)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe: ByteBpe = encoder(tokens.value)
        for batch in batches:
            for docs, texts in _groups(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                offsets, ids = bpe.encode_batch(texts)
                yield pa.RecordBatch.from_arrays([pa.array(docs, pa.int64()), pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(ids))], ["doc_id", "ids"])

    return df.select(df[doc_id].cast("long").alias("doc_id"), df[text].alias("text")).mapInArrow(run, "doc_id long, ids array<int>")


def token_counts(df: DataFrame, doc_id: str, text: str, rank_file: str) -> DataFrame:
    """(doc_id, n_tokens): as `token_ids`, but only how many."""
    tokens = share_tokens(df.sparkSession, rank_file)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe: ByteBpe = encoder(tokens.value)
        for batch in batches:
            for docs, texts in _groups(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                yield pa.RecordBatch.from_arrays([pa.array(docs, pa.int64()), pa.array(bpe.count_batch(texts))], ["doc_id", "n_tokens"])

    return df.select(df[doc_id].cast("long").alias("doc_id"), df[text].alias("text")).mapInArrow(run, "doc_id long, n_tokens long")


def decoded_text(df: DataFrame, doc_id: str, ids: str, rank_file: str) -> DataFrame:
    """(doc_id, text): the texts whose ids are in `ids`; null ids give an empty text."""
    tokens = share_tokens(df.sparkSession, rank_file)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe: ByteBpe = encoder(tokens.value)
        for batch in batches:
            lists = batch.column(1).fill_null(pa.scalar([], pa.list_(pa.int32())))
            flat = lists.flatten().to_numpy()
            offsets = np.concatenate([[0], np.cumsum(lists.value_lengths().to_numpy(zero_copy_only=False))])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(bpe.decode_batch(offsets, flat), pa.string())], ["doc_id", "text"])

    return df.select(df[doc_id].cast("long").alias("doc_id"), df[ids].cast("array<int>").alias("ids")).mapInArrow(run, "doc_id long, text string")
