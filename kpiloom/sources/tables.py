"""Reading and binding the base tables."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession

from kpiloom.sources.schemas import TABLES

Tables = Mapping[str, DataFrame]

CSV_OPTIONS = {"header": "true", "enforceSchema": "false", "mode": "FAILFAST"}
JSON_OPTIONS = {"mode": "FAILFAST"}


def read_table(spark: SparkSession, role: str, path: str, fmt: str = "parquet", **options: str) -> DataFrame:
    """One base table from files (``parquet``, ``orc``, ``csv`` or ``json``), never with an inferred schema.

    Files laid out in ``day=...`` folders are pruned by the date floors of the operators. What can't be read as
    declared is an error: a column that Parquet or ORC files don't have, at once; a broken line or value of CSV
    or JSON, when it is read. A key that is absent from a JSON line is NULL.
    """
    spec = TABLES[role]
    reader = spark.read.schema(spec.stored_schema)
    if fmt in ("csv", "json"):
        reader = reader.options(**(CSV_OPTIONS if fmt == "csv" else JSON_OPTIONS))
    else:
        found = {name.lower() for name in spark.read.options(**options).format(fmt).load(path).columns}
        missing = [name for name in spec.stored_schema.names if name.lower() not in found]
        if missing:
            raise ValueError(f"{role}: {path} has no column {', '.join(missing)}")
    return spec.rename(reader.options(**options).format(fmt).load(path))


def read_tables(spark: SparkSession, paths: Mapping[str, str], fmt: str = "parquet", **options: str) -> Tables:
    """Several base tables, given as ``{role: path}``."""
    return {role: read_table(spark, role, path, fmt, **options) for role, path in paths.items()}


def bind_tables(spark: SparkSession, names: Mapping[str, str], database: str | None = None) -> Tables:
    """Catalog tables, given as ``{role: table name}``, optionally all in one database.

    Types are checked, not only cast: a column that is missing, wider than declared or of another kind is an error,
    which names all of them in all tables. Narrower whole numbers are widened; columns not declared are left out.
    """
    prefix = f"{database}." if database else ""
    found = {role: spark.table(prefix + name) for role, name in names.items()}
    wrong = [f"{role}: {', '.join(said)}" for role, df in found.items() if (said := TABLES[role].mismatches(df.schema))]
    if wrong:
        raise ValueError("; ".join(wrong))
    return {role: TABLES[role].rename(df) for role, df in found.items()}


def require(tables: Tables, roles: Iterable[str]) -> list[DataFrame]:
    """The tables of the given roles, or an error that names the ones that are missing."""
    missing = [role for role in roles if role not in tables]
    if missing:
        raise KeyError(f"tables not bound: {', '.join(missing)}")
    return [tables[role] for role in roles]
