"""GTF lines judged as they arrive."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from helixframe.operators.row_validation import bad_lines, clean_rows


def line_stream(spark: SparkSession, path: str) -> DataFrame:
    """Files of (line_id, file_name, line) in a folder, as they are added."""
    return spark.readStream.schema("line_id long, file_name string, line string").parquet(path)


def load_lines(lines: DataFrame, good: str, bad: str, checkpoint: str) -> StreamingQuery:
    """Write typed rows below `good` and bad lines with their reason below `bad`, one folder a batch.

    A batch that is run again after a failure replaces its own folders, so each line is
    loaded once. Ends when everything there has been read.
    """

    def load(batch: DataFrame, number: int) -> None:
        clean_rows(batch).write.mode("overwrite").parquet(f"{good}/batch={number}")
        bad_lines(batch).write.mode("overwrite").parquet(f"{bad}/batch={number}")

    return lines.writeStream.foreachBatch(load).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
