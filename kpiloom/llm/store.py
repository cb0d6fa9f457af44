"""Intermediate tables in the folder that the whole cluster shares."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

from kpiloom.session import use_checkpoint_dir


def new_folder(spark: SparkSession, name: str) -> str:
    """A path of its own below ``spark.checkpoint.dir``; nothing is created yet."""
    return f"{use_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str, compression: str = "snappy", **options: str) -> DataFrame:
    """Write a frame to the shared folder and read it back: its lineage ends at files that outlive executors."""
    spark = df.sparkSession
    folder = new_folder(spark, name)
    df.write.options(**options).parquet(folder, compression=compression)
    return spark.read.schema(df.schema).parquet(folder)


def share_code(spark: SparkSession) -> None:
    """Give this package to the Python workers of the session, for clusters where it isn't installed."""
    context = spark.sparkContext
    if context.applicationId in _shared:
        return
    package = Path(__file__).resolve().parents[1]
    archive = Path(tempfile.mkdtemp(prefix="code-")) / f"{package.name}-code.zip"
    with zipfile.ZipFile(archive, "w") as code:
        for file in sorted(package.rglob("*.py")):
            code.write(file, file.relative_to(package.parent))
    context.addPyFile(str(archive))
    _shared.add(context.applicationId)


_shared: set[str] = set()
