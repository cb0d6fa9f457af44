"""Stored outcomes: every refresh equals a full run, and reads the late days only."""

from __future__ import annotations

import random
from dataclasses import replace
from datetime import date, datetime, timedelta

import pytest

from kpiloom.operators.cleaning import Rules
from kpiloom.operators.outcomes import Outcome, around, within
from kpiloom.plans import history, refresh, reports

RULES = Rules(date(2025, 1, 1))
START = datetime(2024, 12, 31, 12)
WANTED = {"lv": within(1, "live", "video"), "d7": around(7, 1, "live", "video", "test")}


@pytest.fixture
def tables(make):
    rng = random.Random(4)

    def events(role, n, **more):
        return make(role, *({"user_id": rng.randrange(15), "at": str(START + timedelta(minutes=rng.randrange(40 * 1440))), **more} for _ in range(n)))

    return {
        "users": make("users", *({"user_id": u, "category": "SSC"} for u in range(12))),
        "purchases": events("purchases", 120),
        "live_sessions": events("live_sessions", 150),
        "video_events": events("video_events", 80),
        "test_attempts": events("test_attempts", 60),
    }


def rows(df):
    return sorted(map(tuple, df.collect()))


def full(tables, through, wanted=WANTED, rules=RULES):
    cut = {k: df.where(f"cast(server_time + INTERVAL {rules.utc_offset_minutes} MINUTES AS date) <= '{through}'") if k != "users" else df for k, df in tables.items()}
    return rows(reports.buyer_facts(cut, rules, wanted))


def since(tables, day):
    """Only what came in on the local days from ``day`` on."""
    return {k: df.where(f"cast(server_time + INTERVAL 330 MINUTES AS date) >= '{day}'") if k != "users" else df for k, df in tables.items()}


def test_each_refresh_equals_a_full_run(spark, tables, tmp_path):
    """Also with days left out, a day refreshed twice, and an earlier day refreshed again."""
    for through in [date(2025, 1, n) for n in (5, 6, 7, 8, 15, 15, 31, 10)] + [date(2025, 3, 1)]:
        got = history.stored_facts(spark, tables, RULES, WANTED, str(tmp_path), through)
        assert rows(got) == full(tables, through), through


@pytest.mark.parametrize("early", [0, -2])
def test_old_days_are_not_needed(spark, tables, tmp_path, early):
    """A refresh finds the same if purchases and activity of settled days are gone."""
    wanted = WANTED | ({"before": Outcome(("video",), early, early)} if early else {})
    history.stored_facts(spark, tables, RULES, wanted, str(tmp_path), date(2025, 1, 20))
    first = date(2025, 1, 20) + timedelta(days=1 - 8)
    late = since(tables, first + timedelta(days=early)) | {"purchases": since(tables, first)["purchases"]}
    got = history.stored_facts(spark, late, RULES, wanted, str(tmp_path), date(2025, 1, 21))
    assert rows(got) == full(tables, date(2025, 1, 21), wanted)


def test_a_refresh_reads_late_partitions_only(spark, tables, tmp_path):
    cut = history._since(tables, RULES, WANTED, date(2025, 1, 20), date(2025, 1, 25))
    days = {r.day for role in ("purchases", "live_sessions") for r in cut[role].collect()}
    assert min(days) >= date(2025, 1, 19) and max(days) <= date(2025, 1, 26)
    plan = cut["purchases"]._jdf.queryExecution().optimizedPlan().toString()
    assert "day#" in plan and "server_time#" in plan


def test_late_rows(spark, tables, make, tmp_path):
    """Rows that come two days late are found if the refresh allows for them."""
    row = {"user_id": 2, "at": "2025-01-19 10:00"}
    early = tables | {"purchases": tables["purchases"].union(make("purchases", row))}
    early["live_sessions"] = tables["live_sessions"].where("NOT (user_id = 2 AND day BETWEEN '2025-01-18' AND '2025-01-20')")
    tables = early | {"live_sessions": early["live_sessions"].union(make("live_sessions", row))}
    for days, same in ((2, True), (0, False)):
        folder = str(tmp_path / str(days))
        history.stored_facts(spark, early, RULES, {"lv": within(0, "live")}, folder, date(2025, 1, 20), days)
        got = history.stored_facts(spark, tables, RULES, {"lv": within(0, "live")}, folder, date(2025, 1, 22), days)
        assert (rows(got) == full(tables, date(2025, 1, 22), {"lv": within(0, "live")})) == same


def test_other_rules_start_anew(spark, tables, tmp_path):
    through = date(2025, 1, 20)
    history.stored_facts(spark, tables, RULES, WANTED, str(tmp_path), through - timedelta(days=1))
    other = replace(RULES, free_pattern="%home%")
    got = history.stored_facts(spark, tables, other, WANTED, str(tmp_path), through)
    assert rows(got) == full(tables, through, rules=other) != full(tables, through)


def test_a_refresh_that_fails_changes_nothing(spark, tables, tmp_path, monkeypatch):
    days = [date(2025, 1, 18), date(2025, 1, 24), date(2025, 1, 30)]
    history.stored_facts(spark, tables, RULES, WANTED, str(tmp_path), days[0])
    with monkeypatch.context() as broken:
        broken.setattr(history, "STATE", "through INT")
        with pytest.raises(Exception, match="."):
            history.stored_facts(spark, tables, RULES, WANTED, str(tmp_path), days[1])
    assert history._last(spark, f"{tmp_path}/{history._name(RULES, WANTED, 0)}", days[2]).through == days[0]
    assert rows(history.stored_facts(spark, tables, RULES, WANTED, str(tmp_path), days[2])) == full(tables, days[2])


def test_many_parts_become_one(spark, tables, tmp_path, monkeypatch):
    monkeypatch.setattr(history, "MOST_PARTS", 3)
    for n in range(10, 18):
        got = history.stored_facts(spark, tables, RULES, WANTED, str(tmp_path), date(2025, 1, n))
        state = history._last(spark, f"{tmp_path}/{history._name(RULES, WANTED, 0)}", date(2025, 2, 1))
        assert len(state.settled) < 3
    assert rows(got) == full(tables, date(2025, 1, 17))


def test_refresh_from_stored_outcomes(spark, tables, make, tmp_path):
    """The KPI tables are the same from stored outcomes and from the base tables."""
    through = date(2025, 2, 20)
    content = make("content_events", {"user_id": 1, "at": "2025-01-05 10:00", "category": "SSC"})
    tables = {**tables, "content_events": content}
    for day in (date(2025, 1, 15), through):
        facts = history.stored_facts(spark, tables, RULES, refresh.refresh_outcomes(), str(tmp_path), day)
    stored, plain = refresh.kpi_tables(spark, tables, RULES, through, facts=facts), refresh.kpi_tables(spark, tables, RULES, through)
    for name in ("kpi_activation_windows", "kpi_activation_daily", "kpi_retention", "kpi_journey_funnel", "kpi_summary_snapshot"):
        assert [tuple(map(str, r)) for r in stored[name].collect()] == [tuple(map(str, r)) for r in plain[name].collect()], name
