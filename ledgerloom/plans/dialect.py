"""The few spellings in which Spark SQL and the checking engine differ.

The provider exports used by the registered queries are derived from the given tables by one SQL text
that both engines run, so the checks start from equal inputs; everything after that is separate.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

# kind of text -> the checking engine's pattern, and Spark's pattern where it is a date alone
_PATTERNS = {
    "iso": ("%Y-%m-%d %H:%M:%S", None),
    "iso_z": ("%Y-%m-%dT%H:%M:%SZ", None),
    "clock": ("%H:%M:%S", None),
    "mdy": ("%m/%d/%Y", "MM/dd/yyyy"),
    "dmy": ("%d/%m/%Y", "dd/MM/yyyy"),
    "worded": ("%b %-d, %Y", "MMM d, yyyy"),
}


def pick(index: str, values: Sequence[str]) -> str:
    arms = " ".join(f"WHEN {i} THEN '{v}'" for i, v in enumerate(values))
    return f"CASE {index} {arms} END"


@dataclass(frozen=True)
class Dialect:
    spark: bool

    @property
    def string(self) -> str:
        return "STRING" if self.spark else "VARCHAR"

    def naive(self, ts: str) -> str:
        return f"CAST({ts} AS {'TIMESTAMP_NTZ' if self.spark else 'TIMESTAMP'})"

    def plus_seconds(self, ts: str, n: str) -> str:
        return f"timestampadd(SECOND, {n}, {ts})" if self.spark else f"({ts} + to_seconds({n}))"

    def div(self, a: str, b: str) -> str:
        return f"(({a}) div ({b}))" if self.spark else f"(({a}) // ({b}))"

    def show(self, ts: str, kind: str) -> str:
        theirs, of_date = _PATTERNS[kind]
        if not self.spark:
            return f"strftime({ts}, '{theirs}')"
        if of_date:
            return f'date_format(CAST({ts} AS DATE), "{of_date}")'
        # the text of a zone-less time; date_format would take it through the session time zone
        text = f"CAST({ts} AS STRING)"
        if kind == "iso":
            return f"substring({text}, 1, 19)"
        clock = f"substring({text}, 12, 8)"
        return clock if kind == "clock" else f"concat(substring({text}, 1, 10), 'T', {clock}, 'Z')"

    def in_zone(self, ts: str, zone: str) -> str:
        if self.spark:
            return f"convert_timezone('UTC', '{zone}', {ts})"
        return f"timezone('{zone}', timezone('UTC', {ts}))"

    def each(self, *items: str) -> str:
        """One output row per item; the next step drops the nulls."""
        listed = ", ".join(items)
        return f"explode(array({listed}))" if self.spark else f"unnest([{listed}])"

    def weekend(self, day: str) -> str:
        return f"dayofweek({day}) IN ({'1, 7' if self.spark else '0, 6'})"

    def money(self, cents: str) -> str:
        return f"CAST(CAST({cents} AS DECIMAL(18,0)) * 0.01 AS DECIMAL(18,2))"

    def money_text(self, cents: str) -> str:
        return f"CAST({self.money(cents)} AS {self.string})"

    def month_start(self, ts: str) -> str:
        return f"CAST(date_trunc('month', {ts}) AS DATE)"


SPARK = Dialect(spark=True)
CHECK = Dialect(spark=False)
