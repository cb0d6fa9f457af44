"""The six base tables: stored columns, their types and the names used in this package."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import types as T


# Types that are read as another one without loss. A timestamp with a zone is read in the session's, which is UTC.
READ_AS: dict[type[T.DataType], tuple[type[T.DataType], ...]] = {
    T.LongType: (T.ByteType, T.ShortType, T.IntegerType),
    T.IntegerType: (T.ByteType, T.ShortType),
    T.StringType: (T.VarcharType, T.CharType),
    T.TimestampNTZType: (T.TimestampType,),
}


@dataclass(frozen=True)
class TableSpec:
    """Stored columns of one table, as ``(stored name, name here, type)``."""

    columns: tuple[tuple[str, str, T.DataType], ...]
    partition_column: str | None = None

    @property
    def stored_schema(self) -> T.StructType:
        return T.StructType([T.StructField(stored, kind, True) for stored, _, kind in self.columns])

    @property
    def schema(self) -> T.StructType:
        return T.StructType([T.StructField(name, kind, True) for _, name, kind in self.columns])

    def mismatches(self, found: T.StructType) -> list[str]:
        """What of the stored schema is missing or can't be read without loss; narrower whole numbers can."""
        kinds = {field.name.lower(): field.dataType for field in found}
        said = []
        for stored, _, kind in self.columns:
            has = kinds.get(stored.lower())
            if has is None:
                said.append(f"no column {stored}")
            elif type(has) is not type(kind) and type(has) not in READ_AS.get(type(kind), ()):
                said.append(f"{stored} is {has.simpleString()}, not {kind.simpleString()}")
        return said

    def rename(self, df: DataFrame) -> DataFrame:
        """Stored table to the names and types used here; columns not listed are left out."""
        return df.selectExpr(
            *(f"cast({stored} as {kind.simpleString()}) AS {name}" for stored, name, kind in self.columns)
        )


LONG, INT, TEXT, DAY, TIME = T.LongType(), T.IntegerType(), T.StringType(), T.DateType(), T.TimestampNTZType()

# Column names and types of the data dictionary. `server_time` is UTC, `signup_ts` is
# local time, `day` is the UTC partition date.
TABLES: dict[str, TableSpec] = {
    "users": TableSpec(
        (
            ("user_id", "user_id", LONG),
            ("signup_ts", "signup_ts", TIME),
            ("signup_date", "signup_date", DAY),
            ("string_examcategory_selected_525", "category", TEXT),
            ("category_selected_date", "category_selected_date", DAY),
            ("platform", "platform", TEXT),
            ("city", "city", TEXT),
        )
    ),
    "purchases": TableSpec(
        (
            ("transaction_id", "transaction_id", TEXT),
            ("user_id", "user_id", LONG),
            ("server_time", "server_time", TIME),
            ("day", "day", DAY),
            ("string_product_id_551", "product_id", TEXT),
            ("double_transaction_amount_257", "amount", INT),
            ("payment_mode", "payment_mode", TEXT),
            ("string_examcategory_selected_525", "product_category", TEXT),
        ),
        partition_column="day",
    ),
    "live_sessions": TableSpec(
        (
            ("session_id", "session_id", TEXT),
            ("user_id", "user_id", LONG),
            ("server_time", "server_time", TIME),
            ("day", "day", DAY),
            ("string_source_screen_172", "screen", TEXT),
            ("content_id", "content_id", TEXT),
            ("string_examcategory_selected_525", "category", TEXT),
        ),
        partition_column="day",
    ),
    "video_events": TableSpec(
        (
            ("engagement_id", "engagement_id", TEXT),
            ("user_id", "user_id", LONG),
            ("server_time", "server_time", TIME),
            ("day", "day", DAY),
            ("video_id", "video_id", TEXT),
            ("watch_duration_seconds", "watch_duration_seconds", INT),
            ("string_examcategory_selected_525", "category", TEXT),
        ),
        partition_column="day",
    ),
    "test_attempts": TableSpec(
        (
            ("test_attempt_id", "test_attempt_id", TEXT),
            ("user_id", "user_id", LONG),
            ("server_time", "server_time", TIME),
            ("day", "day", DAY),
            ("string_content_title_878", "title", TEXT),
            ("string_user_action_105", "action", TEXT),
            ("score", "score", INT),
            ("max_score", "max_score", INT),
            ("string_examcategory_selected_525", "category", TEXT),
        ),
        partition_column="day",
    ),
    "content_events": TableSpec(
        (
            ("consumption_id", "consumption_id", TEXT),
            ("user_id", "user_id", LONG),
            ("server_time", "server_time", TIME),
            ("day", "day", DAY),
            ("content_type", "content_type", TEXT),
            ("content_id", "content_id", TEXT),
            ("duration_seconds", "duration_seconds", INT),
            ("string_examcategory_selected_525", "category", TEXT),
        ),
        partition_column="day",
    ),
}

# The exam categories in scope, in report order.
EXAM_CATEGORIES: tuple[str, ...] = (
    "BANKING",
    "SSC",
    "RAILWAYS",
    "DEFENCE",
    "CTET",
    "UPSC",
    "ENGINEERING",
    "GATE",
    "IIT JEE",
    "NEET",
    "UTTAR PRADESH",
    "BIHAR",
    "RAJASTHAN",
    "MAHARASHTRA",
    "MADHYA PRADESH",
    "HARYANA",
    "GUJARAT",
    "PUNJAB_STATE_EXAMS",
    "TAMIL_NADU",
    "KERALA",
    "WEST_BENGAL",
)

# Categories with a column of their own in the narrow and in the wide reports.
MAIN_CATEGORIES: tuple[str, ...] = ("BANKING", "SSC", "RAILWAYS", "DEFENCE", "UPSC")
WIDE_CATEGORIES: tuple[str, ...] = (
    "BANKING",
    "SSC",
    "RAILWAYS",
    "DEFENCE",
    "CTET",
    "UPSC",
    "ENGINEERING",
    "GATE",
    "IIT JEE",
    "NEET",
    "UTTAR PRADESH",
    "BIHAR",
    "RAJASTHAN",
    "MAHARASHTRA",
    "MADHYA PRADESH",
    "HARYANA",
    "GUJARAT",
)

# Content types and the column stem of each in the narrow report.
CONTENT_TYPES: dict[str, str] = {
    "live_class": "live_class",
    "recorded_video": "video",
    "test": "test",
    "notes": "notes",
    "practice_quiz": "quiz",
}
# The wide report uses the type itself as the stem.
WIDE_CONTENT_TYPES: dict[str, str] = {kind: kind for kind in CONTENT_TYPES}
