"""Refresh all KPI tables: ``spark-submit`` this module, or run ``python -m kpiloom``.

    python -m kpiloom --floor 2025-01-01 --out /shared/kpis --format parquet \\
        --table users=/shared/users --table purchases=/shared/purchases ...

With ``--database`` the tables are catalog tables instead of folders.
"""

from __future__ import annotations

import argparse
from collections.abc import Sequence
from datetime import date, datetime

from pyspark.sql import SparkSession

from kpiloom.operators.cleaning import Rules
from kpiloom.operators.periods import yesterday
from kpiloom.plans.refresh import kpi_tables, write_kpi_tables
from kpiloom.sources.schemas import CONTENT_TYPES, EXAM_CATEGORIES, MAIN_CATEGORIES, WIDE_CATEGORIES
from kpiloom.sources import TABLES, bind_tables, publish_kpi_csv, read_tables, write_kpi_csv, write_kpi_parquet

CATEGORIES = {"category": EXAM_CATEGORIES, "main-category": MAIN_CATEGORIES, "wide-category": WIDE_CATEGORIES}
SINKS = {"csv": write_kpi_csv, "parquet": write_kpi_parquet}
# One file for each table under its own name, all of them replaced after the last is written.
SNAPSHOT = "snapshot"


def main(arguments: Sequence[str] | None = None, now: datetime | None = None) -> None:
    parser = argparse.ArgumentParser(prog="kpiloom", description="Refresh all KPI tables.")
    parser.add_argument("--table", action="append", required=True, metavar="ROLE=PATH", help=f"one of {', '.join(TABLES)}")
    parser.add_argument("--database", help="take the tables from this catalog database")
    parser.add_argument("--format", choices=["parquet", "orc", "csv", "json"], help="of files; default: parquet")
    parser.add_argument("--floor", type=date.fromisoformat, required=True, help="first day in the reports")
    parser.add_argument("--ref-date", type=date.fromisoformat, help="default: the last full local day")
    parser.add_argument("--signup-offset", type=int, default=330, help="minutes added to signup times")
    parser.add_argument("--utc-offset", type=int, default=330, help="minutes that local dates are ahead of UTC")
    for what, default in CATEGORIES.items():
        parser.add_argument(f"--{what}", action="append", help=f"default: {', '.join(default)}")
    parser.add_argument(
        "--content-type", action="append", metavar="TYPE=STEM", help="content types and the stems of their columns"
    )
    parser.add_argument("--out", required=True, help="folder for the KPI tables")
    parser.add_argument("--sink", default="csv", choices=[*sorted(SINKS), SNAPSHOT])
    given = parser.parse_args(arguments)
    if given.database and given.format:
        parser.error("--format is for files, --database for catalog tables")
    names = dict(pair.split("=", 1) for pair in given.table)
    spark = SparkSession.builder.appName("kpiloom").config("spark.sql.session.timeZone", "UTC")
    # Checkpoints go when nothing refers to them any more.
    spark = spark.config("spark.cleaner.referenceTracking.cleanCheckpoints", "true").getOrCreate()
    tables = (
        bind_tables(spark, names, given.database) if given.database else read_tables(spark, names, given.format or "parquet")
    )
    scope, main_categories, wide = (tuple(getattr(given, c.replace("-", "_")) or d) for c, d in CATEGORIES.items())
    types = dict(pair.split("=", 1) for pair in given.content_type) if given.content_type else CONTENT_TYPES
    kpis = kpi_tables(
        spark,
        tables,
        Rules(given.floor, given.utc_offset, scope),
        given.ref_date or yesterday(given.utc_offset, now),
        types,
        main_categories,
        wide,
        given.signup_offset,
    )
    if given.sink == SNAPSHOT:
        publish_kpi_csv(kpis, given.out)
    else:
        write_kpi_tables(kpis, given.out, SINKS[given.sink])


if __name__ == "__main__":
    main()
