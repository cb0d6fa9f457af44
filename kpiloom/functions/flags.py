"""Many conditional distinct counts in two plain aggregations.

``count(distinct case when <condition> then user end)`` once per condition makes Spark copy every
input row once per condition. A ``FlagSet`` packs the conditions into bits instead: the first
aggregation, per user, ORs them together (small, combined before the shuffle), and the second adds up
the bits. The counts are exact.
"""

from __future__ import annotations

from collections.abc import Mapping

WORD_BITS = 62


class FlagSet:
    """Named SQL conditions, kept as bits of one or more bigint columns called ``<prefix>_<n>``.

    A condition that is NULL counts as not met.
    """

    def __init__(self, prefix: str, conditions: Mapping[str, str]):
        self.prefix = prefix
        self.conditions = dict(conditions)

    def seen(self, where: str | None = None, prefix: str | None = None) -> list[str]:
        """First aggregation: the conditions that held on any row (on any row with ``where``)."""
        conditions = list(self.conditions.values())
        columns = []
        for start in range(0, len(conditions), WORD_BITS):
            word = conditions[start : start + WORD_BITS]
            mask = " | ".join(f"if({condition}, {1 << bit}L, 0L)" for bit, condition in enumerate(word))
            if where is not None:
                mask = f"if({where}, {mask}, 0L)"
            columns.append(f"bit_or({mask}) AS {prefix or self.prefix}_{start // WORD_BITS}")
        return columns

    def counts(self, prefix: str | None = None, name: str = "{}") -> list[str]:
        """Second aggregation: per condition, the number of first-level rows on which it was seen."""
        columns = []
        for position, condition in enumerate(self.conditions):
            word = f"{prefix or self.prefix}_{position // WORD_BITS}"
            total = f"sum(shiftright({word}, {position % WORD_BITS}) & 1)"
            columns.append(f"coalesce({total}, 0L) AS `{name.format(condition)}`")
        return columns
