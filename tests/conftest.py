from __future__ import annotations

import sys
from datetime import date, datetime
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from kpiloom.session import local_session  # noqa: E402
from kpiloom.sources import TABLES  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = local_session(
        4,
        "tests",
        **{
            "spark.sql.shuffle.partitions": "4",
            "spark.driver.memory": "6g",
            "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse")),
        },
    )
    session.sparkContext.setCheckpointDir(str(tmp_path_factory.mktemp("checkpoint")))
    yield session
    session.stop()


DEFAULTS = {
    "users": {"signup_ts": None, "signup_date": None, "category_selected_date": None, "platform": "web", "city": "Pune"},
    "purchases": {"transaction_id": "t", "product_id": "p", "amount": 100, "payment_mode": "upi"},
    "live_sessions": {"session_id": "s", "screen": "home", "content_id": "c"},
    "video_events": {"engagement_id": "e", "video_id": "v", "watch_duration_seconds": 60},
    "test_attempts": {"test_attempt_id": "a", "title": "Mock 1", "action": "finished", "score": 5, "max_score": 10},
    "content_events": {"consumption_id": "c", "content_type": "notes", "content_id": "c", "duration_seconds": 60},
}


@pytest.fixture
def make(spark):
    """A base table from rows that name only what matters; ``at`` is the UTC time."""

    def build(role: str, *rows: dict):
        full = []
        for row in rows:
            row = {**DEFAULTS[role], **row}
            if "at" in row:
                row["server_time"] = datetime.fromisoformat(row.pop("at"))
                row.setdefault("day", row["server_time"].date())
            for name in ("signup_ts",):
                if isinstance(row.get(name), str):
                    row[name] = datetime.fromisoformat(row[name])
            for name in ("signup_date", "category_selected_date", "day"):
                if isinstance(row.get(name), str):
                    row[name] = date.fromisoformat(row[name])
            full.append(tuple(row.get(name) for _, name, _ in TABLES[role].columns))
        return spark.createDataFrame(full, TABLES[role].schema)

    return build
