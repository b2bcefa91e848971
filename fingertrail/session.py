"""Session settings and the shared folder for checkpoints and scratch tables."""

from __future__ import annotations

import shutil
import tempfile
import uuid
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession


def build_session(app: str = "fingertrail", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        # a join on (session, touch) may reuse rows already clustered by session
        "spark.sql.requireAllClusterKeysForCoPartition": "false",
        # of a repeated key in a document the last one counts
        "spark.sql.variant.allowDuplicateKeys": "true",
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    ship_package(spark)
    return spark


def ship_package(spark: SparkSession) -> None:
    """Send this package to the Python workers, which need not have it installed or run in its folder."""
    if spark.conf.get("fingertrail.shipped", None):
        return
    folder = Path(__file__).resolve().parent
    archive = shutil.make_archive(str(Path(tempfile.mkdtemp(prefix="fingertrail-")) / folder.name), "zip",
                                  folder.parent, folder.name)
    spark.sparkContext.addPyFile(archive)
    spark.conf.set("fingertrail.shipped", "true")


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, as named by the cluster.

    Only when the session names none and all executors run on this machine (local runs and tests) is a temporary
    folder set; on a cluster executors would each write to a disk of their own.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not folder and not is_local(context.master):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    if not folder:
        folder = tempfile.mkdtemp(prefix="fingertrail-")
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(folder)
    return folder


def is_local(master: str) -> bool:
    """Whether driver and executors are one process; local-cluster starts executors of their own."""
    return master == "local" or master.startswith("local[")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def store(df: DataFrame) -> DataFrame:
    """Write a table to the shared folder and read it back: cuts the lineage, survives lost executors.

    Unlike a checkpoint it also takes its size statistics from the files, so estimates do not multiply
    from step to step, and later reads prune columns.
    """
    path = scratch_path(df.sparkSession, "stage")
    df.write.parquet(path)
    stored = df.sparkSession.read.schema(df.schema).parquet(path)
    stored._stored_at = path
    return stored


#: Rows of a settled table that a core reads in one task; a smaller table is dealt over all cores.
TASK_ROWS = 1_000_000


def settle(df: DataFrame) -> DataFrame:
    """df as a stored table, for steps that read it again and again.

    Means that are computed anew add up in another order and may differ in the last digit, so rows that are matched by such
    values must be the same ones in every pass. A small table would be one file, and one task of each pass; it is dealt
    over the cores. A stored table stays as it is.
    """
    if hasattr(df, "_stored_at"):
        return df
    kept, cores = store(df), df.sparkSession.sparkContext.defaultParallelism
    return store(kept.repartition(cores)) if kept.count() <= cores * TASK_ROWS else kept


def discard(stored: DataFrame) -> None:
    """Delete a table that ``store`` wrote and that nothing will read again."""
    path = stored.sparkSession._jvm.org.apache.hadoop.fs.Path(stored._stored_at)
    path.getFileSystem(stored.sparkSession._jsparkSession.sessionState().newHadoopConf()).delete(path, True)
