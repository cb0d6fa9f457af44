"""Secrets in texts, found once for every distinct text and kept in a ledger.

Texts are content-addressed: a blob is the SHA-256 of a text. The ledger is a Parquet folder of rows (blob,
rules, findings): these rules, each named with its version, have been run over the blob and gave these spans.
A scan looks up which pairs of blob and rule the ledger lacks, reads one text for each such blob, runs only the
rules that are missing, appends to the ledger, and joins the findings back to every row that has the text. New
versions of a document cost a scan only where its text is new; a new rule is run over all blobs, the old
rules over none of them again.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LEDGER = "blob STRING, rules ARRAY<STRING>, findings ARRAY<STRUCT<rule: STRING, start: INT, end: INT>>"
FINDINGS = "ARRAY<STRUCT<kind: STRING, start: INT, end: INT>>"


@dataclass(frozen=True)
class Rule:
    """All leftmost matches that don't overlap, but those whose group (0: all of it) is shorter than ``least``.

    ``version`` has to change with anything else. ASCII letters of a rule without case stand for either case.
    """

    kind: str
    pattern: str
    least: int = 1
    group: int = 0
    any_case: bool = False
    version: int = 1

    @property
    def name(self) -> str:
        return f"{self.kind}@{self.version}"

    def spans(self, text: str) -> Iterator[tuple[int, int]]:
        for match in re.finditer(self.pattern, text, re.ASCII | (re.IGNORECASE if self.any_case else 0)):
            if match.end(self.group) - match.start(self.group) >= self.least:
                yield match.span()


# The three kinds every scan has. A run of the characters of the last two that is long enough is
# found by its length, which gives the same matches as dropping the short ones.
BASE = (
    Rule(
        "assign",
        r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        least=6,
        group=2,
        any_case=True,
    ),
    Rule("access", r"AKIA[A-Z0-9]{16,}"),
    Rule("hex", r"[0-9a-f]{24,}+"),
)

# A private key up to its END line, or without one over the lines of base64 that follow.
PRIVATE_KEY = (
    r"-----BEGIN (?:[A-Z]+ )*PRIVATE KEY-----"
    r"(?:(?:(?!-----)[A-Za-z0-9+/=\s\\:,.-])*+-----END (?:[A-Z]+ )*PRIVATE KEY-----"
    r"|(?:[ \t]*\r?\n[ \t]*(?:(?:Proc-Type|DEK-Info):[^\n]*(?:\r?\n)?|[A-Za-z0-9+/=]+)(?=[ \t]*(?:\r?\n|\Z)))*)"
)

# Well-known forms of keys and tokens.
MORE = (
    Rule("private_key", PRIVATE_KEY, version=2),
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("google", r"AIza[A-Za-z0-9_-]{35}"),
    Rule("stripe", r"[rs]k_live_[A-Za-z0-9]{24,}"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{10,}\.eyJ[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}"),
)


def scanned(
    rows: DataFrame, ledger: str, key: str = "doc_id", text: str = "text", rules: tuple[Rule, ...] = BASE + MORE
) -> DataFrame:
    """``rows`` with blob and findings: spans (kind, start, end in code points, end exclusive) by start and rule.

    ``ledger`` is the folder of the ledger, made if it isn't there. A null text counts as empty. Keys may be
    null or repeated: they only say where a text can be read again (rows that repeat key and text are all read). Columns named blob or findings are replaced.
    """
    spark = rows.sparkSession
    names = [rule.name for rule in rules]
    spark.createDataFrame([], LEDGER).write.mode("append").parquet(ledger)
    book = spark.read.schema(LEDGER).parquet(ledger)
    paths = rows.select(F.col(key).alias("key"), F.sha2(F.coalesce(F.col(text), F.lit("")), 256).alias("blob"))
    done = book.groupBy("blob").agg(F.flatten(F.collect_set("rules")).alias("done"))
    wanted = F.array(*map(F.lit, names))
    unseen = (
        paths.groupBy("blob")
        .agg(F.min("key").alias("at"))
        .join(done, "blob", "left")
        .withColumn("missing", F.coalesce(F.array_except(wanted, "done"), wanted))
        .where(F.size("missing") > 0)
        .select("at", F.col("blob").alias("unseen"), "missing")
    )
    texts = rows.select(F.col(key).alias("key"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    texts = texts.join(unseen, F.col("key").eqNullSafe(F.col("at"))).where(F.sha2("text", 256) == F.col("unseen"))
    _scan(texts.select("unseen", "missing", "text"), rules).write.mode("append").parquet(ledger)

    book = spark.read.schema(LEDGER).parquet(ledger)
    listed = f"array({', '.join(f"'{name}'" for name in names)})"
    by_start = F.expr(
        "array_sort(array_distinct(flatten(collect_list(findings))), (a, b) -> CASE "
        "WHEN a.start < b.start THEN -1 WHEN a.start > b.start THEN 1 "
        f"ELSE int(array_position({listed}, a.rule) - array_position({listed}, b.rule)) END)"
    )
    found = (
        book.withColumn("findings", F.expr(f"filter(findings, x -> array_contains({listed}, x.rule))"))
        .where(F.size("findings") > 0)
        .groupBy("blob")
        .agg(by_start.alias("findings"))
        .withColumn(
            "findings",
            F.expr(
                "transform(findings, x -> named_struct("
                "'kind', substring_index(x.rule, '@', 1), 'start', x.start, 'end', x.end))"
            ),
        )
    )
    kept = rows.drop("blob", "findings").withColumn("blob", F.sha2(F.coalesce(F.col(text), F.lit("")), 256))
    return kept.join(found, "blob", "left").withColumn("findings", F.coalesce("findings", F.array().cast(FINDINGS)))


def _scan(texts: DataFrame, rules: tuple[Rule, ...]) -> DataFrame:
    """Ledger rows for rows of (blob, names of rules, text)."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("rule", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))
        for batch in batches:
            blobs, missing, texts = batch.columns
            wanted = missing.to_pylist()
            found = [
                [
                    {"rule": rule.name, "start": start, "end": end}
                    for rule in rules
                    if rule.name in names
                    for start, end in rule.spans(text.as_py())
                ]
                for names, text in zip(wanted, texts, strict=True)
            ]
            yield pa.RecordBatch.from_arrays([blobs, missing, pa.array(found, kind)], names=["blob", "rules", "findings"])

    return texts.mapInArrow(scan, LEDGER)


def masked(rows: DataFrame, text: str = "text", mask: str = "[secret]") -> DataFrame:
    """``rows`` of ``scanned`` with every finding in the text replaced by ``mask``; overlapping ones count as one.

    A text without findings stays as it is, a null text stays null.
    """

    def replace(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, spans = batch.schema.get_field_index(text), batch.column(batch.schema.get_field_index("findings"))
            changed = [
                _masked(value.as_py(), found.as_py(), mask) if len(found) else value.as_py()
                for value, found in zip(batch.column(at), spans, strict=True)
            ]
            yield batch.set_column(at, batch.schema.field(at), pa.array(changed, batch.schema.field(at).type))

    return rows.mapInArrow(replace, rows.schema)


def _masked(text: str, findings: list[dict], mask: str) -> str:
    parts, done = [], 0
    for span in findings:
        if span["start"] >= done:
            parts += [text[done : span["start"]], mask]
        done = max(done, span["end"])
    return "".join([*parts, text[done:]])
