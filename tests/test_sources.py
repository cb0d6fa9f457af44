from __future__ import annotations

import json
from datetime import date

import pytest

from kpiloom.operators.cleaning import Rules, paid_purchases
from kpiloom.plans import reports
from kpiloom.sources import (
    publish_kpi_csv,
    TABLES,
    bind_tables,
    read_table,
    read_tables,
    write_base_table,
    write_kpi_csv,
    write_kpi_parquet,
)

RULES = Rules(date(2025, 1, 2))


@pytest.fixture
def purchases(make):
    return make(
        "purchases",
        *(
            {"user_id": n % 3, "at": f"2025-01-0{1 + n % 4} 10:00:00", "transaction_id": f"t{n}", "amount": n}
            for n in range(12)
        ),
    )


def rows(df):
    return sorted(map(tuple, df.collect()))


def stored(df, role):
    return df.selectExpr(*(f"{name} AS {kept}" for kept, name, _ in TABLES[role].columns))


@pytest.mark.parametrize("fmt", ["parquet", "orc", "csv", "json"])
def test_formats_round_trip(spark, purchases, tmp_path, fmt):
    options = {"header": True} if fmt == "csv" else {}
    stored(purchases, "purchases").write.options(**options).format(fmt).save(str(tmp_path / "p"))
    back = read_table(spark, "purchases", str(tmp_path / "p"), fmt)
    assert back.schema == TABLES["purchases"].schema
    assert rows(back) == rows(purchases)


def test_csv_columns_are_checked(spark, tmp_path):
    (tmp_path / "p.csv").write_text("user_id,transaction_id\n1,t\n")
    with pytest.raises(Exception, match="(?i)csv"):
        read_table(spark, "purchases", str(tmp_path / "p.csv"), "csv").collect()


def test_narrow_key_in_files_is_widened(spark, purchases, tmp_path):
    narrow = stored(purchases.withColumn("user_id", purchases.user_id.cast("int")), "purchases")
    narrow.write.parquet(str(tmp_path / "p"))
    assert rows(read_table(spark, "purchases", str(tmp_path / "p"))) == rows(purchases)


def test_partitions_before_the_floor_are_not_read(spark, purchases, tmp_path):
    path = str(tmp_path / "p")
    write_base_table(purchases, "purchases", path)
    assert sorted(p.name for p in (tmp_path / "p").glob("day=*")) == [f"day=2025-01-0{n}" for n in (1, 2, 3, 4)]
    tables = read_tables(spark, {"purchases": path})
    assert rows(tables["purchases"]) == rows(purchases)
    paid = paid_purchases(tables["purchases"], RULES)
    plan = paid._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(day" in plan and "2025-01-02" in plan
    assert paid.count() == 9


def test_users_are_not_partitioned(spark, make, tmp_path):
    users = make("users", {"user_id": 1, "category": "SSC", "signup_ts": "2025-01-01 08:00:00", "signup_date": "2025-01-01"})
    write_base_table(users, "users", str(tmp_path / "u"))
    assert rows(read_table(spark, "users", str(tmp_path / "u"))) == rows(users)


def test_catalog_binding(spark, purchases):
    spark.sql("CREATE DATABASE IF NOT EXISTS shop")
    try:
        stored(purchases, "purchases").write.mode("overwrite").saveAsTable("shop.sales")
        bound = bind_tables(spark, {"purchases": "sales"}, "shop")
        assert rows(bound["purchases"]) == rows(purchases)
    finally:
        spark.sql("DROP DATABASE shop CASCADE")


def test_kpi_csv(spark, tmp_path):
    df = spark.sql("SELECT 'a' AS kpi, 12.5D AS pct UNION ALL SELECT 'b', NULL ORDER BY kpi")
    write_kpi_csv(df, str(tmp_path / "k"))
    (part,) = (tmp_path / "k").glob("part-*")
    assert part.read_bytes() == b"kpi,pct\r\na,12.5\r\nb,\r\n"
    write_kpi_parquet(df, str(tmp_path / "q"))
    assert rows(spark.read.parquet(str(tmp_path / "q")).na.fill(-1.0)) == [("a", 12.5), ("b", -1.0)]


def test_reports_from_files(spark, make, tmp_path):
    """Written as day-partitioned parquet and read back, the tables give the same report."""
    given = {
        "users": make("users", {"user_id": 1, "category": "SSC"}),
        "purchases": make("purchases", {"user_id": 1, "at": "2025-01-05 10:00:00"}),
        "live_sessions": make("live_sessions", {"user_id": 1, "at": "2025-01-06 10:00:00"}),
        "video_events": make("video_events", {"user_id": 2, "at": "2025-01-06 10:00:00"}),
        "test_attempts": make("test_attempts", {"user_id": 1, "at": "2025-01-07 10:00:00"}),
    }
    paths = {}
    for role, df in given.items():
        paths[role] = str(tmp_path / role)
        write_base_table(df, role, paths[role])
    expected = [(date(2025, 1, 5), "Sunday", "2025-W00", "2025-01", 1, 1, 100.0, 0, 0.0)]
    assert rows(reports.activation_daily(read_tables(spark, paths), RULES)) == expected


@pytest.mark.parametrize("fmt", ["parquet", "orc"])
def test_missing_columns_are_an_error(spark, purchases, tmp_path, fmt):
    """Not read as NULL, which would be no purchases at all."""
    without = stored(purchases, "purchases").drop("double_transaction_amount_257")
    without.write.format(fmt).save(str(tmp_path / "p"))
    with pytest.raises(ValueError, match="double_transaction_amount_257"):
        read_table(spark, "purchases", str(tmp_path / "p"), fmt)


def test_partition_folders_count_as_columns(spark, purchases, tmp_path):
    stored(purchases, "purchases").write.partitionBy("day").parquet(str(tmp_path / "p"))
    assert rows(read_table(spark, "purchases", str(tmp_path / "p"))) == rows(purchases)


@pytest.mark.parametrize("line", ['{"user_id": 1, "transaction', '{"user_id": 1, "double_transaction_amount_257": 5.5}'])
def test_broken_json_is_an_error(spark, tmp_path, line):
    (tmp_path / "p.json").write_text('{"user_id": 1, "double_transaction_amount_257": 5}\n' + line + "\n")
    with pytest.raises(Exception, match="(?i)malformed|FAILFAST"):
        read_table(spark, "purchases", str(tmp_path / "p.json"), "json").collect()


def test_absent_json_keys_are_null(spark, tmp_path):
    (tmp_path / "p.json").write_text('{"user_id": 1}\n')
    assert read_table(spark, "purchases", str(tmp_path / "p.json"), "json").first().amount is None


def test_catalog_types_are_checked(spark):
    """Narrower whole numbers are widened; all that is wider, of another kind or missing is named in one error."""
    spark.sql("CREATE DATABASE IF NOT EXISTS typed")
    columns = {stored: kind.simpleString() for stored, _, kind in TABLES["purchases"].columns}
    narrow = columns | {"user_id": "int", "double_transaction_amount_257": "smallint", "server_time": "timestamp"}
    wrong = columns | {"double_transaction_amount_257": "bigint", "day": "string", "server_time": "date"}
    del wrong["payment_mode"]
    for name, kinds in (("narrow", narrow), ("wrong", wrong)):
        spark.sql(f"DROP TABLE IF EXISTS typed.{name}")
        made = spark.range(1).selectExpr(*(f"cast(NULL AS {kind}) AS {column}" for column, kind in kinds.items()))
        made.selectExpr("*", "1 AS extra").write.saveAsTable(f"typed.{name}")
    users = spark.range(1).selectExpr("'x' AS user_id", "cast(NULL AS timestamp_ntz) AS signup_ts")
    users.createOrReplaceTempView("typed_users")
    bound = bind_tables(spark, {"purchases": "narrow"}, "typed")["purchases"]
    assert bound.schema == TABLES["purchases"].schema and bound.count() == 1
    with pytest.raises(ValueError) as error:
        bind_tables(spark, {"purchases": "typed.wrong", "users": "typed_users"})
    said = str(error.value)
    for part in (
        "purchases: ",
        "double_transaction_amount_257 is bigint, not int",
        "day is string, not date",
        "server_time is date, not timestamp_ntz",
        "no column payment_mode",
        "users: user_id is string, not bigint",
        "no column signup_date",
    ):
        assert part in said
    assert "signup_ts is" not in said and "extra" not in said


def published(folder):
    return {p.name: p.read_bytes() for p in folder.iterdir() if not p.name.startswith(".")}


def test_snapshot_of_single_files(spark, tmp_path):
    kpis = {
        "kpi_days": spark.range(1000).repartition(7).orderBy("id").selectExpr("id", "nullif(id % 2, 1) AS pct"),
        "kpi_none": spark.range(0).selectExpr("id", "'x' AS name"),
    }
    publish_kpi_csv(kpis, str(tmp_path / "out"))
    files = published(tmp_path / "out")
    assert sorted(files) == ["kpi_days.csv", "kpi_none.csv", "manifest.json"]
    lines = files["kpi_days.csv"].decode().split("\r\n")
    assert lines[:3] == ["id,pct", "0,0", "1,"] and lines[-2:] == ["999,", ""] and len(lines) == 1002
    manifest = json.loads(files["manifest.json"])
    assert [(t["name"], t["file"], t["rows"], t["columns"]) for t in manifest["tables"]] == [
        ("kpi_days", "kpi_days.csv", 1000, ["id", "pct"]),
        ("kpi_none", "kpi_none.csv", 0, ["id", "name"]),
    ]
    publish_kpi_csv({"kpi_days": spark.range(1).selectExpr("id")}, str(tmp_path / "out"))
    again = published(tmp_path / "out")
    assert again["kpi_days.csv"] == b"id\r\n0\r\n" and again["kpi_none.csv"] == files["kpi_none.csv"]
    assert [t["name"] for t in json.loads(again["manifest.json"])["tables"]] == ["kpi_days"]


def test_a_snapshot_that_fails_leaves_the_one_before(spark, tmp_path):
    """The second table breaks off after some rows: nothing that was published changes, nothing is left behind."""
    good = {name: spark.range(5).selectExpr("id") for name in ("a", "b")}
    publish_kpi_csv(good, str(tmp_path))
    before = published(tmp_path)
    broken = spark.range(100).selectExpr("if(id = 90, raise_error('stop'), id) AS id")
    with pytest.raises(Exception, match="stop"):
        publish_kpi_csv({"a": spark.range(9).selectExpr("id"), "b": broken}, str(tmp_path))
    assert published(tmp_path) == before
    with pytest.raises(ValueError):
        publish_kpi_csv({}, str(tmp_path))
