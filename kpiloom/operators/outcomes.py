"""What buyers did after a purchase.

Every activation and retention metric asks the same question: for a purchase of a user on a day, was
there activity of some kinds between ``first_day`` and ``last_day`` days later? ``purchase_outcomes``
answers it for any number of such questions over one pass of the activity tables.

The activity tables are by far the largest input. They are shuffled once, as one small row per user
and block of days that is combined before the shuffle. Days a purchase is waiting for (the purchase
day plus each offset) are grouped along with them, as bits of the same blocks, so there is no join and
no sort of the activity, and a user or a day that holds a large part of all rows shrinks to a row per
task before it moves.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kpiloom.functions import aggregate, rows
from kpiloom.functions.flags import WORD_BITS
from kpiloom.session import use_checkpoint_dir

# Up to this many days per purchase are waited on one by one, as bits; a purchase is a row to shuffle for each block
# of days that they reach. The other way shuffles the activity days a second time.
MAX_OFFSETS = 16
# Up to this many buyers are sent to all executors (some 100 MB there), if asked for.
MAX_BUYERS = 4_000_000


@dataclass(frozen=True)
class Outcome:
    """Activity of any of ``kinds``, ``first_day`` to ``last_day`` days after the purchase, ends included."""

    kinds: tuple[str, ...]
    first_day: int
    last_day: int

    @property
    def offsets(self) -> range:
        return range(self.first_day, self.last_day + 1)


def within(horizon_days: int, *kinds: str) -> Outcome:
    """Activity on the purchase day or in the ``horizon_days`` days after it."""
    return Outcome(kinds, 0, horizon_days)


def around(day: int, tolerance: int, *kinds: str) -> Outcome:
    """Activity on a day after the purchase, or up to ``tolerance`` days before or after that day."""
    return Outcome(kinds, day - tolerance, day + tolerance)


def activity_days(activity: Mapping[str, DataFrame]) -> DataFrame:
    """One row per user and day with activity: (user_id, activity_date, one boolean column per kind)."""
    seen = [f"{_has('bit_or(kinds)', _bits(activity, kind))} AS {kind}" for kind in activity]
    return aggregate(_labelled(activity), ["user_id", "activity_date"], seen)


def purchase_outcomes(
    purchases: DataFrame,
    activity: Mapping[str, DataFrame],
    outcomes: Mapping[str, Outcome],
    members: DataFrame | None = None,
    max_offsets: int | None = None,
    max_buyers: int = 0,
) -> DataFrame:
    """One row per user and purchase day, with a boolean column per outcome.

    ``purchases``: (user_id, purchase_date), any number of rows per user and day.
    ``activity``: per kind, (user_id, activity_date), any number of rows per user and day.
    ``members``: the users in scope; purchases of others are left out. If it has a category, with one row
    per user, so has the result. None keeps all purchases.
    ``max_offsets``: up to so many days after a purchase are waited on one by one, more are looked up by range
    frames (see ``MAX_OFFSETS``, the default). Both ways give the same rows.
    ``max_buyers``: if at most so many users in scope bought anything, only their activity is shuffled. They are
    counted and written to the shared folder when the plan is made. With more of them, or 0, all activity is.

    Result: (user_id, purchase_date[, category], transactions, <outcomes>).
    """
    known = "user_id IS NOT NULL"
    purchases = purchases.where(known)
    activity = {kind: df.where(known) for kind, df in activity.items()}
    if max_buyers:
        activity = _of_buyers(activity, purchases, members, max_buyers)
    offsets = sorted({offset for outcome in outcomes.values() for offset in outcome.offsets})
    if len(offsets) <= (MAX_OFFSETS if max_offsets is None else max_offsets):
        hits = _hits_by_offset(purchases, activity, outcomes, offsets)
    else:
        hits = _hits_by_range(purchases, activity, outcomes)
    # One shuffle by user serves the join, the grouping here and any grouping of the result by user.
    hits = hits.repartition("user_id")
    keys = ["user_id", "purchase_date"]
    if members is not None:
        with_category = "category" in members.columns
        hits = hits.join(members, "user_id", "inner" if with_category else "left_semi")
        keys += ["category"] if with_category else []
    return aggregate(
        hits, keys, ["max(transactions) AS transactions", *(f"bool_or({name}) AS {name}" for name in outcomes)]
    )


def _of_buyers(
    activity: Mapping[str, DataFrame], purchases: DataFrame, members: DataFrame | None, most: int
) -> Mapping[str, DataFrame]:
    """The activity of users who bought, if these are at most so many, and else all of it."""
    use_checkpoint_dir(purchases.sparkSession)
    buyers = purchases.select("user_id").distinct()
    if members is not None:
        buyers = buyers.join(members, "user_id", "left_semi")
    buyers = buyers.limit(most + 1).checkpoint()
    if buyers.count() > most:
        return activity
    return {kind: df.join(F.broadcast(buyers), "user_id", "left_semi") for kind, df in activity.items()}


def _bits(activity: Mapping[str, DataFrame], *kinds: str) -> int:
    order = list(activity)
    return sum(1 << order.index(kind) for kind in set(kinds))


def _has(mask: str, bits: int) -> str:
    return f"({mask} & {bits}) != 0"


def _labelled(activity: Mapping[str, DataFrame], *columns: str) -> DataFrame:
    labelled = [
        df.selectExpr("user_id", "activity_date", f"{_bits(activity, kind)} AS kinds", *columns)
        for kind, df in activity.items()
    ]
    return reduce(DataFrame.unionAll, labelled)


def _hits_by_offset(
    purchases: DataFrame,
    activity: Mapping[str, DataFrame],
    outcomes: Mapping[str, Outcome],
    offsets: list[int],
) -> DataFrame:
    """A row per purchase day with the number of its purchases, and rows with the outcomes that activity fulfils.

    Days are cut into blocks of ``WORD_BITS``. A purchase waits once for each block that an offset leads to, however
    many do: ``waiting_<n>`` has bit i set where the user bought on day i of the block ``reach[n]`` blocks earlier,
    and ``active_<n>`` where there was activity of the n-th kind on day i of the block. Rows without a block have a
    purchase day and how many bought on it. Unknown days have no block, and unknown days of activity meet those of
    purchases.
    """
    reach = sorted({(day + offset) // WORD_BITS for offset in offsets for day in range(WORD_BITS)}) or [0]
    words = [f"waiting_{n}" for n in range(len(reach))]
    active = [f"active_{n}" for n in range(len(activity))]

    def block(day: str) -> str:
        return f"floor(unix_date({day}) / {WORD_BITS})"

    def bit(day: str) -> str:
        return f"shiftleft(1L, pmod(unix_date({day}), {WORD_BITS}))"

    def leading(ahead: int) -> int:
        """The days of a block, as bits, from which an offset leads so many blocks ahead."""
        days = (d for d in range(WORD_BITS) if any((d + offset) // WORD_BITS == ahead for offset in offsets))
        return sum(1 << d for d in days)

    def row(block: str, day: str, transactions: str, **bits: str) -> list[str]:
        return [
            "user_id",
            f"cast({block} AS BIGINT) AS block",
            f"cast({day} AS DATE) AS day",
            f"{transactions} AS transactions",
            *(f"{bits.get(name, '0L')} AS {name}" for name in words + active),
        ]

    counted = row("NULL", "purchase_date", "1L")
    ahead = [
        row(f"{block('purchase_date')} + {k}", "NULL", "0L", **{word: f"{bit('purchase_date')} & {leading(k)}L"})
        for word, k in zip(words, reach, strict=True)
    ]
    waits = " OR ".join(f"{word} != 0" for word in words)
    waiting = rows(purchases, (f"struct({', '.join(fields)})" for fields in [counted, *ahead])).where(
        f"transactions > 0 OR {waits}"
    )
    marks = {
        name: f"if({_has('kinds', _bits(activity, kind))}, coalesce({bit('activity_date')}, 1L), 0L)"
        for name, kind in zip(active, activity, strict=True)
    }
    done = _labelled(activity).selectExpr(*row(block("activity_date"), "NULL", "0L", **marks))
    days = aggregate(
        waiting.unionAll(done),
        ["user_id", "day", "block"],
        ["sum(transactions) AS transactions", *(f"bit_or({name}) AS {name}" for name in words + active)],
    ).where(f"transactions > 0 OR {waits}")
    # A row per word with purchases, then one per purchase day in it: its day from the beginning of the block on.
    ahead_of = f"element_at(array({', '.join(map(str, reach))}), position + 1)"
    by_day = (
        days.selectExpr("*", f"posexplode(array({', '.join(words)})) AS (position, word)")
        .where("word != 0 OR (position = 0 AND transactions > 0)")
        .selectExpr("*", f"posexplode(array({', '.join(f'{1 << d}L' for d in range(WORD_BITS))})) AS (bit, mask)")
        .where("(word & mask) != 0 OR (bit = 0 AND transactions > 0)")
        .selectExpr("*", f"bit - {WORD_BITS} * {ahead_of} AS at")
    )

    def fulfilled(outcome: Outcome) -> str:
        if not outcome.offsets:
            return "false"
        kinds = " | ".join(name for name, kind in zip(active, activity, strict=True) if kind in outcome.kinds)
        first, last = f"greatest(0, at + {outcome.first_day})", f"least({WORD_BITS - 1}, at + {outcome.last_day})"
        between = f"if({first} <= {last}, shiftleft(1L, {last} + 1) - shiftleft(1L, {first}), 0L)"
        return f"(({kinds or '0L'}) & if(block IS NULL, 1L, {between})) != 0"

    return by_day.selectExpr(
        "user_id",
        f"coalesce(day, date_from_unix_date(int(block * {WORD_BITS} + at))) AS purchase_date",
        "transactions",
        *(f"{fulfilled(outcome)} AS {name}" for name, outcome in outcomes.items()),
    ).where(" OR ".join(["transactions > 0", *outcomes]))


def _hits_by_range(
    purchases: DataFrame, activity: Mapping[str, DataFrame], outcomes: Mapping[str, Outcome]
) -> DataFrame:
    """The same for horizons too long to wait on day by day: range frames over the days of each user.

    A user has at most one row per calendar day here, however many events there were.
    """
    bought = purchases.selectExpr("user_id", "purchase_date", "0 AS kinds", "1L AS transactions")
    days = aggregate(
        bought.unionAll(_labelled(activity, "0L AS transactions")),
        ["user_id", "purchase_date"],
        ["bit_or(kinds) AS kinds", "sum(transactions) AS transactions"],
    )

    def seen(outcome: Outcome) -> str:
        def bound(days: int) -> str:
            return f"{abs(days)} {'FOLLOWING' if days >= 0 else 'PRECEDING'}"

        frame = f"RANGE BETWEEN {bound(outcome.first_day)} AND {bound(outcome.last_day)}"
        over = f"bit_or(kinds) OVER (PARTITION BY user_id ORDER BY unix_date(purchase_date) {frame})"
        return _has(f"coalesce({over}, 0)", _bits(activity, *outcome.kinds))

    return days.selectExpr(
        "user_id",
        "purchase_date",
        "transactions",
        *(f"{seen(outcome)} AS {name}" for name, outcome in outcomes.items()),
    ).where("transactions > 0")
