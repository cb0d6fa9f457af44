"""Purchase outcomes against brute force, by both ways of computing them."""

from __future__ import annotations

import random
from collections import Counter
from datetime import date, timedelta

import pytest

from kpiloom.operators import outcomes
from kpiloom.operators.outcomes import Outcome, around, purchase_outcomes, within

START = date(2024, 2, 20)


def day(n: int) -> date:
    return START + timedelta(days=n)


def expected(purchases, activity, wanted):
    pairs = Counter((u, d) for u, d in purchases if u is not None)
    found = set()
    for (u, d), n in pairs.items():
        hits = tuple(
            any(
                (u, d + timedelta(days=o)) in activity[kind] for kind in outcome.kinds for o in outcome.offsets
            )
            for outcome in wanted.values()
        )
        found.add((u, d, n, *hits))
    return found


@pytest.mark.parametrize("max_offsets", [0, 62], ids=["ranges", "offsets"])
@pytest.mark.parametrize("seed", range(4))
def test_against_brute_force(spark, monkeypatch, max_offsets, seed):
    monkeypatch.setattr(outcomes, "MAX_OFFSETS", max_offsets)
    rng = random.Random(seed)

    def rows(n):
        # User 0 has a third of all rows.
        return [(0 if rng.random() < 0.33 else rng.randrange(12), day(rng.randrange(60))) for _ in range(n)]

    purchases = rows(120) + [(None, day(3))]
    activity = {"live": rows(150), "video": rows(60), "test": rows(40)}
    wanted = {
        "lv": within(1, "live", "video"),
        "test": within(1, "test"),
        "d7": around(7, 1, "live", "video", "test"),
        "d30": around(30, 1, "live", "video", "test"),
        "before": Outcome(("video",), -2, -1),
    }
    frames = {k: spark.createDataFrame(v, "user_id bigint, activity_date date") for k, v in activity.items()}
    bought = spark.createDataFrame(purchases, "user_id bigint, purchase_date date")
    got = purchase_outcomes(bought, frames, wanted, spark.range(12).selectExpr("id AS user_id", "'X' AS category"))
    got = got.drop("category").collect()
    assert len(got) == len({(r.user_id, r.purchase_date) for r in got})
    sets = {k: set(v) for k, v in activity.items()}
    assert {tuple(r) for r in got} == expected(purchases, sets, wanted)


def test_long_horizon_takes_ranges(spark):
    bought = spark.createDataFrame([(1, day(0)), (2, day(0))], "user_id bigint, purchase_date date")
    seen = spark.createDataFrame([(1, day(400)), (2, day(401))], "user_id bigint, activity_date date")
    got = purchase_outcomes(bought, {"live": seen}, {"year": within(400, "live")}).collect()
    assert {(r.user_id, r.year) for r in got} == {(1, True), (2, False)}


@pytest.mark.parametrize("max_offsets", [0, 62], ids=["ranges", "offsets"])
def test_repeated_members_and_unknown_users_change_nothing(spark, monkeypatch, max_offsets):
    monkeypatch.setattr(outcomes, "MAX_OFFSETS", max_offsets)
    bought = spark.createDataFrame([(1, day(0)), (1, day(0)), (None, day(0))], "user_id bigint, purchase_date date")
    seen = spark.createDataFrame([(1, day(1)), (None, day(0))], "user_id bigint, activity_date date")
    users = spark.createDataFrame([(1,), (1,), (1,)], "user_id bigint")
    for members in (users, None, users.selectExpr("*", "'SSC' AS category")):
        got = purchase_outcomes(bought, {"live": seen}, {"lv": within(1, "live")}, members).collect()
        assert [(r.user_id, r.transactions, r.lv) for r in got] == [(1, 2, True)]


def test_members_filter_and_category(spark):
    bought = spark.createDataFrame([(1, day(0)), (2, day(0))], "user_id bigint, purchase_date date")
    seen = spark.createDataFrame([(1, day(0))], "user_id bigint, activity_date date")
    users = spark.createDataFrame([(1, "SSC")], "user_id bigint, category string")
    (row,) = purchase_outcomes(bought, {"live": seen}, {"lv": within(1, "live")}, users).collect()
    assert (row.user_id, row.category, row.transactions, row.lv) == (1, "SSC", 1, True)


@pytest.mark.parametrize("days", [31, 32, 33, 62, 63, 64, 70, 130])
def test_many_offsets_by_both_ways(spark, days):
    """Bits beyond those of an int and of a long: activity at the far end and just beyond it."""
    rng = random.Random(days)
    purchases = [(rng.randrange(6), day(rng.randrange(200))) for _ in range(60)]
    seen = {(u, d + timedelta(days=n)) for u, d in purchases[:20] for n in rng.choices([0, 30, 31, 32, days - 1, days], k=2)}
    wanted = {"all": within(days - 1, "live"), "end": Outcome(("live",), days - 1, days - 1), "d31": Outcome(("live",), 31, 31)}
    bought = spark.createDataFrame(purchases, "user_id bigint, purchase_date date")
    frames = {"live": spark.createDataFrame(list(seen), "user_id bigint, activity_date date")}
    right = expected(purchases, {"live": seen}, wanted)
    assert any(r[4] for r in right) and not all(r[3] for r in right)
    for most in (0, 200):
        assert {tuple(r) for r in purchase_outcomes(bought, frames, wanted, max_offsets=most).collect()} == right


def pruned_plan(spark, tmp_path, buyers: int, max_buyers: int):
    path = str(tmp_path / f"activity-{buyers}-{max_buyers}")
    rows = [(u, day(u % 50)) for u in range(2000)]
    spark.createDataFrame(rows, "user_id bigint, activity_date date").write.mode("overwrite").parquet(path)
    bought = spark.createDataFrame([(u, day(0)) for u in range(buyers)], "user_id bigint, purchase_date date")
    return purchase_outcomes(bought, {"live": spark.read.parquet(path)}, {"lv": within(3, "live")}, max_buyers=max_buyers)


def shuffled_rows(df) -> int:
    """Rows written by the exchange that activity goes through."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan()
    written = []

    def walk(node):
        if node.nodeName() == "Exchange":
            written.append(node.metrics().apply("shuffleRecordsWritten").value())
        if node.nodeName() == "AdaptiveSparkPlan":
            walk(node.executedPlan())
        if hasattr(node, "plan") and "QueryStage" in node.nodeName():
            walk(node.plan())
        for i in range(node.children().size()):
            walk(node.children().apply(i))

    walk(plan)
    return sum(written)


def test_activity_of_others_is_not_shuffled(spark, tmp_path):
    few, all_ = pruned_plan(spark, tmp_path, 5, 100), pruned_plan(spark, tmp_path, 5, 0)
    assert "LeftSemi" in few._jdf.queryExecution().executedPlan().toString()
    assert sorted(map(tuple, few.collect())) == sorted(map(tuple, all_.collect()))
    assert shuffled_rows(few) < 200 < 2000 < shuffled_rows(all_)
    many = pruned_plan(spark, tmp_path, 101, 100)
    assert "LeftSemi" not in many._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("seed", range(2))
def test_pruned_against_brute_force(spark, seed):
    rng = random.Random(seed)
    purchases = [(rng.choice([None, *range(20)]), day(rng.randrange(40))) for _ in range(40)]
    seen = {(rng.randrange(60), day(rng.randrange(60))) for _ in range(400)}
    wanted = {"lv": within(2, "live"), "d7": around(7, 1, "live")}
    bought = spark.createDataFrame(purchases, "user_id bigint, purchase_date date")
    frames = {"live": spark.createDataFrame(list(seen), "user_id bigint, activity_date date")}
    users = spark.range(0, 20, 2).selectExpr("id AS user_id")
    got = purchase_outcomes(bought, frames, wanted, users, max_buyers=1000).collect()
    assert {tuple(r) for r in got} == expected([p for p in purchases if (p[0] or 1) % 2 == 0 or p[0] == 0], {"live": seen}, wanted)


def test_a_purchase_is_no_row_per_day_waited_on(spark):
    """Ninety-one offsets reach three blocks of days at most, so that few rows are shuffled for a purchase."""
    bought = spark.createDataFrame([(u, day(u % 70)) for u in range(300)], "user_id bigint, purchase_date date")
    seen = spark.createDataFrame([(u, day(u % 70 + 90)) for u in range(300)], "user_id bigint, activity_date date")
    got = purchase_outcomes(bought, {"live": seen}, {"lv": within(90, "live"), "d89": around(89, 1, "live")}, max_offsets=128)
    assert shuffled_rows(got) <= 300 * (3 + 1 + 1) + 300 * 2
    assert {(r.user_id, r.transactions, r.lv, r.d89) for r in got.collect()} == {(u, 1, True, True) for u in range(300)}


@pytest.mark.parametrize("start", [date(1969, 9, 1), date(2024, 2, 20)], ids=["before 1970", "now"])
def test_days_far_apart_and_before_1970(spark, start):
    """Offsets that reach blocks far apart and behind, from every day of a block."""
    rng = random.Random(3)
    purchases = [(rng.randrange(4), start + timedelta(days=n)) for n in range(130)] * 2
    offsets = (-200, -62, -1, 0, 61, 62, 3000)
    wanted = {f"o{n}": Outcome(("live", "test"), o, o) for n, o in enumerate(offsets)}
    wanted |= {"wide": Outcome(("test",), -70, 70), "none": Outcome(("live",), 3, 2)}
    activity = {
        kind: {(u, d + timedelta(days=rng.choice(offsets) + rng.randrange(2))) for u, d in rng.sample(purchases, 60)}
        for kind in ("live", "video", "test")
    }
    bought = spark.createDataFrame(purchases, "user_id bigint, purchase_date date")
    frames = {k: spark.createDataFrame(list(v), "user_id bigint, activity_date date") for k, v in activity.items()}
    right = expected(purchases, activity, wanted)
    assert all(len({r[3 + n] for r in right}) == 2 for n in range(len(offsets)))
    assert {tuple(r) for r in purchase_outcomes(bought, frames, wanted, max_offsets=999).collect()} == right


@pytest.mark.parametrize("max_offsets", [0, 62], ids=["ranges", "offsets"])
def test_unknown_days_meet(spark, max_offsets):
    """Purchases of unknown days stay, and only activity of unknown days follows them."""
    bought = spark.createDataFrame([(1, None), (1, None), (1, day(0)), (2, None)], "user_id bigint, purchase_date date")
    live = spark.createDataFrame([(1, None), (3, None), (2, day(0))], "user_id bigint, activity_date date")
    test = spark.createDataFrame([(1, day(1))], "user_id bigint, activity_date date")
    wanted = {"lv": within(1, "live"), "test": within(1, "test")}
    got = purchase_outcomes(bought, {"live": live, "test": test}, wanted, max_offsets=max_offsets).collect()
    assert sorted(map(tuple, got), key=str) == sorted(
        [(1, None, 2, True, False), (1, day(0), 1, False, True), (2, None, 1, False, False)], key=str
    )
