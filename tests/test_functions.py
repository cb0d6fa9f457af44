from __future__ import annotations

from datetime import UTC, date, datetime, timedelta
from decimal import ROUND_HALF_UP, Decimal

import pytest

from kpiloom.functions import FlagSet, one_of, pct, pct_delta, round_ratio, week_label, whole_div
from kpiloom.operators.calendar import date_dim
from kpiloom.operators.periods import WINDOWS, add_months, report_windows, yesterday


def value(spark, expression):
    return spark.range(1).selectExpr(f"{expression} AS x").collect()[0].x


@pytest.mark.parametrize(
    "part, whole, expected",
    [("87", "160", 54.38), ("65", "154", 42.21), ("0", "5", 0.0), ("3", "0", None), ("2", "1", 200.0)],
)
def test_pct_rounds_ties_up(spark, part, whole, expected):
    assert value(spark, pct(part, whole)) == expected


def test_ratio_against_decimal(spark):
    pairs = [(n, d) for n in range(0, 40, 3) for d in range(1, 41, 3)]
    for digits in (0, 1, 2):
        got = spark.createDataFrame(pairs, "n bigint, d bigint").selectExpr(
            "n", "d", f"{round_ratio('n', 'd', digits)} AS x"
        )
        for row in got.collect():
            exact = (Decimal(row.n) / Decimal(row.d)).quantize(Decimal(1).scaleb(-digits), ROUND_HALF_UP)
            assert row.x == float(exact)


def test_delta_is_rounded_once_and_away_from_zero(spark):
    assert value(spark, pct_delta("1L", "3L", "2L", "3L")) == -33.33
    assert value(spark, pct_delta("1L", "800L", "0L", "1L")) == 0.13
    assert value(spark, pct_delta("0L", "1L", "1L", "800L")) == -0.13
    assert value(spark, pct_delta("1L", "0L", "1L", "3L")) is None
    big = "900000000000L"
    assert value(spark, pct_delta(big, big, "0L", big)) == 100.0


def test_whole_division_truncates(spark):
    assert value(spark, whole_div("100", "3")) == 33
    assert value(spark, whole_div("100", "0")) is None
    assert value(spark, round_ratio(whole_div("100", "3"), "60", 1)) == 0.6


def test_week_label_of_every_day(spark):
    days = [(date(2019, 12, 25) + timedelta(days=n),) for n in range(2600)]
    for row in spark.createDataFrame(days, "d date").selectExpr("d", f"{week_label('d')} AS w").collect():
        assert row.w == row.d.strftime("%Y-W%W")
    assert value(spark, week_label("DATE '2025-01-01'")) == "2025-W00"
    assert value(spark, week_label("DATE '2025-01-06'")) == "2025-W01"


def test_empty_list_matches_nothing(spark):
    assert value(spark, f"count_if({one_of('id', ())})") == 0
    assert value(spark, "coalesce(NOT " + one_of("id", ()) + ", true)") is True


def test_flag_set_beyond_one_word(spark):
    conditions = {f"n{i}": f"v = {i}" for i in range(130)}
    flags = FlagSet("f", conditions)
    rows = [(user, v) for user in range(3) for v in range(0, 130, user + 1)]
    df = spark.createDataFrame(rows, "u bigint, v int")
    counts = df.groupBy("u").agg(*map(_expr, flags.seen())).selectExpr(*flags.counts()).collect()[0]
    for i in range(130):
        assert counts[f"n{i}"] == sum(i % (user + 1) == 0 for user in range(3))


def _expr(text):
    from pyspark.sql import functions as F

    return F.expr(text)


def test_month_arithmetic_clamps():
    assert add_months(date(2025, 3, 31), -1) == date(2025, 2, 28)
    assert add_months(date(2024, 2, 29), -12) == date(2023, 2, 28)
    assert add_months(date(2025, 1, 15), -1) == date(2024, 12, 15)


def test_window_cases():
    assert report_windows(date(2025, 3, 31))["LM_MTD"] == (date(2025, 2, 1), date(2025, 2, 28))
    assert report_windows(date(2024, 2, 29))["LY_MTD"] == (date(2023, 2, 1), date(2023, 2, 28))
    sunday = report_windows(date(2025, 4, 13))
    assert sunday["LY_WTD"] == (date(2024, 4, 8), date(2024, 4, 14))
    assert sunday["LY_LW"] == (date(2024, 4, 1), date(2024, 4, 7))


def test_windows_of_every_reference_date(spark):
    refs = [date(2023, 1, 1) + timedelta(days=n) for n in range(4 * 366)]
    for ref in refs:
        windows = report_windows(ref)
        assert tuple(windows) == WINDOWS
        assert all(first <= last <= ref for first, last in windows.values())
        assert windows["LY_WTD"][0].weekday() == 0 and windows["LY_LW"][0].weekday() == 0
        assert (windows["LY_LW"][1] - windows["LY_LW"][0]).days == 6
    spark_side = spark.createDataFrame([(r,) for r in refs], "r date").selectExpr(
        "r",
        "add_months(r, -1) AS lm",
        "add_months(r, -12) AS ly",
        "date_sub(trunc(r, 'week'), 364) AS monday",
        "add_months(trunc(r, 'year'), -12) AS year_start",
        "add_months(trunc(r, 'month'), -13) AS ly_lm",
    )
    for row in spark_side.collect():
        windows = report_windows(row.r)
        assert windows["LM_MTD"][1] == row.lm and windows["LY_MTD"][1] == row.ly
        assert windows["LY_WTD"][0] == row.monday and windows["LY_full"][0] == row.year_start
        assert windows["LY_LM"][0] == row.ly_lm


def test_date_dim(spark):
    dates = date_dim(spark, date(2025, 1, 1), date(2025, 4, 14))
    assert dates.columns == ["date", "year", "month", "week", "day_of_week", "is_weekend"]
    rows = dates.collect()
    assert len(rows) == 104
    assert rows[3] == (date(2025, 1, 4), 2025, "2025-01", "2025-W00", "Saturday", True)


def test_values_with_one_column_name_are_refused():
    from kpiloom.functions import column_names

    assert column_names(["IIT JEE", "SSC"]) == {"IIT JEE": "iit_jee", "SSC": "ssc"}
    assert column_names(["SSC", "SSC"]) == {"SSC": "ssc"}
    with pytest.raises(ValueError, match="IIT"):
        column_names(["IIT JEE", "IIT-JEE"])


def test_the_reference_date_is_the_last_full_local_day():
    """At 20:00 UTC it is the next day already 330 minutes east, and the same day in the west."""
    now = datetime(2025, 3, 10, 20, 0, tzinfo=UTC)
    assert yesterday(330, now) == date(2025, 3, 10)
    assert yesterday(0, now) == yesterday(-300, now) == date(2025, 3, 9)
    assert yesterday(330, datetime(2025, 3, 10, 18, 29, tzinfo=UTC)) == date(2025, 3, 9)
    assert yesterday(-300, datetime(2025, 3, 1, 4, 59, tzinfo=UTC)) == date(2025, 2, 27)
    with pytest.raises(ValueError):
        yesterday(330, datetime(2025, 3, 10))
    assert yesterday() in {(datetime.now(UTC) - timedelta(days=n)).date() for n in (1, 2)}
