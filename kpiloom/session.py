"""Sessions and the shared folder for intermediate results."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def local_session(cores: int | str = 8, name: str = "kpiloom", **conf: str) -> SparkSession:
    """A session on this machine, for tests and measurements. On a cluster, use the session it gives you."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(name)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "6g")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def use_checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder of the session (``spark.checkpoint.dir``).

    A session on a single machine that has none gets a temporary one; on a cluster it has to be set,
    because a folder that only one machine sees is lost with it.
    """
    context = spark.sparkContext
    folder = context.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if folder is None:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all machines share")
        folder = tempfile.mkdtemp(prefix="kpiloom-checkpoint-")
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(folder)
    return folder


def shared_folder(spark: SparkSession, name: str) -> str:
    """A path of its own below the shared checkpoint folder; nothing is created yet."""
    return f"{use_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
