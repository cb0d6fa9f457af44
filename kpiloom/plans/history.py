"""Outcomes of purchases, stored and refreshed a day at a time.

Last year's windows need two years of purchases, yet what followed a purchase is settled once the longest outcome is
over. So the outcomes of settled purchase days are stored, a row per buyer and day, and a refresh reads purchases and
activity of the days since then only.

Below the folder there is one part for each set of rules and outcomes (a change of either starts anew), with

* ``settled/<day>-<id>``: outcomes of the purchase days before <day> that weren't settled by the refresh before,
* ``open/<day>-<id>``: those of the days up to the refresh that later activity may still change,
* ``state``: a row for each refresh, appended last, with the names of its files.

Files are never changed, and only those that a state names count; so a refresh that fails leaves the one before as it was
and can be run again, and refreshing an earlier day again is possible at any time.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Mapping
from datetime import date, timedelta

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Row, SparkSession

from kpiloom.functions import date_literal, local_date, local_date_from
from kpiloom.operators.cleaning import Rules
from kpiloom.operators.outcomes import MAX_BUYERS, Outcome
from kpiloom.plans import reports
from kpiloom.sources.tables import Tables, require

STATE = "through DATE, settled_before DATE, settled ARRAY<STRING>, opened STRING"
# Files of settled days, from which on a refresh joins them into one.
MOST_PARTS = 32
ACTIVITY = ("live_sessions", "video_events", "test_attempts")


def stored_facts(
    spark: SparkSession,
    tables: Tables,
    rules: Rules,
    wanted: Mapping[str, Outcome],
    folder: str,
    through: date,
    late_days: int = 0,
) -> DataFrame:
    """``buyer_facts`` of all purchases up to the local day ``through``, with the activity up to that day.

    The first refresh reads everything. A later one reads purchases and activity from the first purchase day on
    that wasn't settled when the refresh before it ended (and as much earlier as outcomes before a purchase
    ask for). ``late_days``: so many days before a refresh its rows may still arrive. Scope is the users' as they are
    at the refresh: settled days of users who join or leave it later aren't changed.
    """
    base = f"{folder.rstrip('/')}/{_name(rules, wanted, late_days)}"
    before = _last(spark, base, through)
    first_day = before.settled_before if before else None
    facts = reports.buyer_facts(_since(tables, rules, wanted, first_day, through), rules, wanted, max_buyers=MAX_BUYERS)
    if first_day:
        facts = facts.where(f"purchase_date >= {date_literal(first_day)}")
    settled_before = through + timedelta(days=1 - late_days - max(0, *(o.last_day for o in wanted.values())))
    if first_day:
        settled_before = max(settled_before, first_day)

    mark = f"{through}-{uuid.uuid4().hex}"
    opened = f"{base}/open/{mark}"
    facts.write.parquet(opened)
    facts = spark.read.schema(facts.schema).parquet(opened)
    settled = list(before.settled) if before else []
    new = facts.where(f"purchase_date < {date_literal(settled_before)}")
    if len(settled) + 1 >= MOST_PARTS:
        new, settled = _read(spark, settled, facts).unionByName(new), []
    part = f"{base}/settled/{mark}"
    new.write.parquet(part)
    settled.append(part)
    state = Row(through=through, settled_before=settled_before, settled=settled, opened=opened)
    spark.createDataFrame([state], STATE).coalesce(1).write.mode("append").parquet(f"{base}/state")
    rest = facts.where(f"purchase_date >= {date_literal(settled_before)}")
    return _read(spark, settled, facts).unionByName(rest)


def _name(rules: Rules, wanted: Mapping[str, Outcome], late_days: int) -> str:
    """A name for what the stored outcomes depend on besides the tables."""
    said = repr((rules, sorted(wanted.items()), late_days))
    return hashlib.sha256(said.encode()).hexdigest()[:16]


def _last(spark: SparkSession, base: str, through: date) -> Row | None:
    """The state of the last refresh of an earlier day."""
    try:
        states = spark.read.schema(STATE).parquet(f"{base}/state")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None
    return states.where(f"through < {date_literal(through)}").orderBy("through", "opened", ascending=False).first()


def _read(spark: SparkSession, parts: list[str], like: DataFrame) -> DataFrame:
    return spark.read.schema(like.schema).parquet(*parts)


def _since(
    tables: Tables, rules: Rules, wanted: Mapping[str, Outcome], first_day: date | None, through: date
) -> dict[str, DataFrame]:
    """The tables with purchases of the local days from ``first_day`` to ``through`` and the activity that these need.

    A local day lies in two partitions by UTC date at most, its own and one beside it.
    """
    earliest = min(0, *(o.first_day for o in wanted.values()))
    offset = rules.utc_offset_minutes

    def cut(df: DataFrame, start: date | None) -> DataFrame:
        df = df.where(f"{local_date('server_time', offset)} <= {date_literal(through)}")
        df = df.where(f"day <= {date_literal(through + timedelta(days=1))}")
        if start is None:
            return df
        return df.where(f"day >= {date_literal(start - timedelta(days=1))} AND {local_date_from('server_time', start, offset)}")

    out = dict(tables)
    (out["purchases"],) = (cut(df, first_day) for df in require(tables, ["purchases"]))
    for role in ACTIVITY:
        if role in tables:
            out[role] = cut(tables[role], first_day and first_day + timedelta(days=earliest))
    return out
