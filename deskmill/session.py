"""Session set-up and the shared folder for reliable checkpoints."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def build_session(name: str, master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the jobs rely on; ``conf`` uses ``_`` for ``.``."""
    builder = (
        SparkSession.builder.appName(name)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        # Files of a checkpoint go when nothing refers to it any more.
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key.replace("_", "."), value)
    return builder.getOrCreate()


def checkpoint_dir(spark: SparkSession) -> str:
    """Folder for reliable checkpoints, as the cluster names it.

    A local session without a setting gets a fresh temporary folder. On a cluster a
    missing setting is an error: a folder on one machine would be lost with it.
    """
    context = spark.sparkContext
    configured = context.getCheckpointDir() or context.getConf().get("spark.checkpoint.dir")
    if not configured:
        if not re.match(r"local(\[|$)", context.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
        configured = tempfile.mkdtemp(prefix="deskmill-checkpoint-")
    if not context.getCheckpointDir():
        context.setCheckpointDir(configured)
    return configured


def materialize(df: DataFrame) -> DataFrame:
    """Write ``df`` once to the checkpoint folder and continue from the files.

    Used where later steps must see the very same rows and partitions, also after an
    executor is lost.
    """
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def written(df: DataFrame) -> DataFrame:
    """Like ``materialize``, for loops of many rounds: a table in the checkpoint folder.

    A checkpoint keeps the size estimates and constraints of the plan before it. Those of
    joins multiply from round to round; a table starts again from the size of its files.
    The files go when the session ends.
    """
    spark = df.sparkSession
    folder = f"{checkpoint_dir(spark).rstrip('/')}/round-{uuid.uuid4().hex}"
    df.write.parquet(folder)
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(path)
    return spark.read.schema(df.schema).parquet(folder)
