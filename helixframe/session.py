"""Sessions and shared scratch folders."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def build_session(master: str = "local[*]", shuffle_partitions: int = 8, checkpoint_dir: str | None = None) -> SparkSession:
    """A session for tests and benches; on a cluster the launcher's own settings hold."""
    builder = (
        SparkSession.builder.master(master)
        .appName("helixframe")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
    )
    return (builder.config("spark.checkpoint.dir", checkpoint_dir) if checkpoint_dir else builder).getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder named by spark.checkpoint.dir, which all machines share.

    Where it names none, a folder of its own is made on a single machine (master local); on a
    cluster that is an error, as its machines couldn't read each other's local folders.
    """
    sc = spark.sparkContext
    if sc._jsc.sc().getCheckpointDir().isEmpty():
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if not folder and not is_local(sc.master):
            raise ValueError("spark.checkpoint.dir must name a folder that all machines of the cluster share")
        sc.setCheckpointDir(folder or tempfile.mkdtemp(prefix="helixframe-"))
    return sc._jsc.sc().getCheckpointDir().get()


def scratch_path(spark: SparkSession) -> str:
    """A path of its own in the shared folder, not there yet."""
    return f"{shared_folder(spark)}/{uuid.uuid4().hex}"


def shared_checkpoint(df: DataFrame, eager: bool = True) -> DataFrame:
    """Cut the lineage of `df` in the shared folder."""
    shared_folder(df.sparkSession)
    return df.checkpoint(eager)


def is_local(master: str) -> bool:
    """Whether all tasks run in the driver's own process."""
    return master == "local" or master.startswith("local[")
