"""Writing base tables and KPI tables."""

from __future__ import annotations

import json
import uuid
from collections.abc import Mapping

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from kpiloom.sources.schemas import TABLES

MANIFEST = "manifest.json"


def write_kpi_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """KPI table as CSV with a header, CRLF line ends and an empty field for a missing value.

    A KPI table has a row per day, month or window, so its files are small; sort it before writing and
    the part files keep that order.
    """
    df.write.mode(mode).option("header", True).option("lineSep", "\r\n").option("nullValue", "").csv(path)


def publish_kpi_csv(kpis: Mapping[str, DataFrame], folder: str) -> None:
    """KPI tables as single CSV files ``<folder>/<name>.csv``, and a manifest that lists them.

    All of them are first written under temporary names. Only when the last one is there they take their places, each
    by one rename, and the manifest is replaced last; so a refresh that fails while writing leaves the files of the
    refresh before as they are. The manifest has each file's columns and rows and the name of the refresh. A KPI
    table is small: its rows, in their order, go through one task. Files that are no longer written stay, but
    aren't listed any more. No tables give an empty manifest.
    """
    if not kpis:
        raise ValueError("there are no tables to publish")
    spark = next(iter(kpis.values())).sparkSession
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path
    target = path(folder)
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    files = target.getFileSystem(conf)
    target = files.makeQualified(target)
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(target.toUri(), conf)
    kind = getattr(jvm, "org.apache.hadoop.fs.Options$Rename")
    overwrite = spark.sparkContext._gateway.new_array(kind, 1)
    overwrite[0] = kind.OVERWRITE
    refresh = uuid.uuid4().hex
    staging = path(target, f"_staging-{refresh}")
    try:
        listed, staged = [], {}
        for name, df in kpis.items():
            seen = Observation()
            counted = df.observe(seen, F.count(F.lit(1)).alias("rows"))
            # Without rows, Spark would write no header if there was no task.
            write_kpi_csv(counted.coalesce(1), path(staging, name).toString())
            parts = [x.getPath() for x in files.listStatus(path(staging, name)) if x.getPath().getName().startswith("part-")]
            if len(parts) != 1:
                raise RuntimeError(f"{name}: {len(parts)} files were written")
            staged[f"{name}.csv"] = parts[0]
            listed.append({"name": name, "file": f"{name}.csv", "columns": df.columns, "rows": seen.get["rows"]})
        out = files.create(path(staging, MANIFEST))
        out.write(bytearray(json.dumps({"refresh": refresh, "tables": listed}, indent=1).encode()))
        out.close()
        for name, part in (staged | {MANIFEST: path(staging, MANIFEST)}).items():
            context.rename(part, path(target, name), overwrite)
    finally:
        files.delete(staging, True)


def write_kpi_parquet(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """KPI table as parquet."""
    df.write.mode(mode).parquet(path)


def write_base_table(df: DataFrame, role: str, path: str, mode: str = "overwrite", fmt: str = "parquet") -> None:
    """Base table as parquet, ORC, CSV or JSON under its stored column names; facts get one folder per ``day``.

    The rebalance hint gathers each day into few files and still splits a day that is far larger than
    the others over several tasks.
    """
    spec = TABLES[role]
    stored = df.selectExpr(*(f"{name} AS {kept}" for kept, name, _ in spec.columns))
    if spec.partition_column is not None:
        stored = stored.hint("rebalance", spec.partition_column)
    writer = stored.write.mode(mode).format(fmt)
    if fmt == "csv":
        writer = writer.option("header", True)
    if spec.partition_column is not None:
        writer = writer.partitionBy(spec.partition_column)
    writer.save(path)
