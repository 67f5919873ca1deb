"""Secret scan: one combined automaton over the bytes of every text.

All rules are compiled into one minimal automaton that reads a text backwards and tells at each byte which rules have
a match that begins there: one pass, whatever the number of rules. A second automaton, not searching but anchored,
then reads forward from such a place, which gives the longest match and whether it is to be kept; it only ever reads
the bytes of matches. Matches of a kind are leftmost, longest and don't overlap each other; kinds don't hide each
other.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.automaton import Automaton, compile_rules
from ledgerloom.llm.common import utf8



@dataclass(frozen=True)
class Rule:
    """What consumes text, and, where not every such match counts, the expression that a kept one also satisfies."""

    kind: str
    pattern: str
    keeps: str | None = None


def either_case(pattern: str) -> str:
    return "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in pattern)


_ASSIGN = (f"({either_case('password|passwd|secret|token|api_?key')})[\"']?\\x20*[:=]\\x20*[\"']?"
           "[A-Za-z0-9+/_.=-]")

# The base kinds, in their order. A shorter run of hexadecimal digits is a whole match that would be
# dropped and that no other overlaps, so only long runs are sought.
BASE = (
    Rule("assign", _ASSIGN + "+", keeps=_ASSIGN + "{8,}"),
    Rule("access", "AKIA[A-Z0-9]+", keeps="AKIA[A-Z0-9]{12,}"),
    Rule("hex", "[0-9a-f]{32,}"),
)

# Public forms of credentials.
FURTHER = (
    Rule("private_key", "-----BEGIN\\x20([A-Z]+\\x20)*PRIVATE\\x20KEY-----"),
    Rule("github", "gh[opsur]_[A-Za-z0-9]+", keeps="gh[opsur]_[A-Za-z0-9]{36,}"),
    Rule("google", "AIza[A-Za-z0-9_-]+", keeps="AIza[A-Za-z0-9_-]{35,}"),
    Rule("slack", "xox[abprs]-[A-Za-z0-9-]+", keeps="xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("stripe", "[prs]k_(live|test)_[A-Za-z0-9]+", keeps="[prs]k_(live|test)_[A-Za-z0-9]{16,}"),
    Rule("web_token", "eyJ[A-Za-z0-9_-]+\\.eyJ[A-Za-z0-9_-]+\\.[A-Za-z0-9_-]+"),
    Rule("login_url", "://[A-Za-z0-9._%-]+:[A-Za-z0-9._%!$&*+~-]+@"),
)

RULES = BASE + FURTHER


class Scanner:
    """Finds the spans of some rules with their two automata."""

    def __init__(self, n_rules: int, starts: Automaton, forward: Automaton):
        self.n_rules, self.starts, self.forward = n_rules, starts, forward
        self._back, self._back_classes = _as_lists(self.starts), self.starts.classes.astype(np.uint8).tobytes()
        self._ahead, self._ahead_classes = _as_lists(self.forward), self.forward.classes.tolist()

    def spans(self, text: bytes) -> list[tuple[int, int, int]]:
        """The spans ``(start, rule, end)`` of a text in bytes, sorted."""
        begins = self._begins(text)
        return self._longest(text, begins) if begins else []

    def _begins(self, text: bytes) -> list[tuple[int, int]]:
        """Places at which matches begin, last place first, and the rules that do."""
        row, width, hits, last = self._back[0], self.starts.width, [], len(text) - 1
        for step, kind in enumerate(reversed(text.translate(self._back_classes))):
            row = row[kind]
            if row[width]:
                hits.append((last - step, row[width]))
        return hits

    def _longest(self, text: bytes, begins: list[tuple[int, int]]) -> list[tuple[int, int, int]]:
        n, free, spans = self.n_rules, [0] * self.n_rules, []
        classes, width, dead = self._ahead_classes, self.forward.width, self._ahead[self.forward.dead]
        for start, rules in reversed(begins):
            due = sum(1 << k for k in range(n) if rules >> k & 1 and free[k] <= start)
            if not due:
                continue
            ends, kept, row = {}, 0, self._ahead[0]
            for at in range(start, len(text)):
                row = row[classes[text[at]]]
                if row is dead:
                    break
                if here := row[width] & due:
                    kept = kept & ~here | (row[width] >> n) & here
                    ends.update({k: at + 1 for k in range(n) if here >> k & 1})
            for k, end in ends.items():
                free[k] = end
                if kept >> k & 1:
                    spans.append((start, k, end))
        return sorted(spans)


def _as_lists(auto: Automaton) -> list[list]:
    """A row for each state: the row after each class of bytes, and behind them the rules that end."""
    rows: list[list] = [[] for _ in auto.ends]
    table = auto.moves.reshape(len(auto.ends), auto.width)
    for row, after, end in zip(rows, table.tolist(), auto.ends.tolist(), strict=True):
        row.extend([rows[k] for k in after])
        row.append(end)
    return rows


@functools.lru_cache(maxsize=4)
def compiled(rules: tuple[Rule, ...]) -> tuple[Automaton, Automaton]:
    """The automaton that tells, from a text's end, where matches begin, and the one that reads on from there.

    Bit k of an end is rule k; of the second one, bit n + k says that the match is to be kept.
    """
    patterns = [rule.pattern for rule in rules]
    return (compile_rules(patterns, backwards=True, anywhere=True),
            compile_rules(patterns + [rule.keeps or rule.pattern for rule in rules]))


def _in_characters(text: bytes, spans: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """Spans in code points: bytes that go on a character are not counted."""
    if not spans or text.isascii():
        return spans
    places = np.concatenate([[0], np.cumsum((np.frombuffer(text, np.uint8) & 0xC0) != 0x80)])
    return [(int(places[a]), k, int(places[b])) for a, k, b in spans]


SPANS = "array<struct<kind: string, rule: int, start: long, end: long>>"


def scan(docs: DataFrame, rules: Sequence[Rule] = RULES) -> DataFrame:
    """``doc_id``, ``text`` and ``spans`` of every row: ``kind, rule, start, end`` in code points, end exclusive.

    Spans stand by start and then in the order of the rules. Matches of one kind are leftmost, longest and don't
    overlap; those whose rule ``keeps`` another expression and that don't satisfy it use up their text and are
    dropped. A null or empty text has no spans; a very long one is read in one pass in memory of a few times its
    size; two rules that match at one place both count; repeated rows are each scanned; an empty table gives none.
    Null ids are ids like others and other columns are not read.
    """
    rules = tuple(rules)
    kind = pa.struct([("kind", pa.string()), ("rule", pa.int32()), ("start", pa.int64()), ("end", pa.int64())])
    schema = pa.schema([("doc_id", pa.int64()), ("text", pa.string()), ("spans", pa.list_(kind))])

    automata = compiled(rules)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(len(rules), *automata)
        for batch in batches:
            spans = [[{"kind": rules[k].kind, "rule": k, "start": a, "end": b}
                      for a, k, b in _in_characters(text, scanner.spans(text))] for text in utf8(batch.column(1))]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).cast(pa.int64()), batch.column(1).cast(pa.string()), pa.array(spans, schema.field(2).type)],
                schema=schema)

    return (docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
            .mapInArrow(run, f"doc_id long, text string, spans {SPANS}"))


def redacted(docs: DataFrame, rules: Sequence[Rule] = RULES) -> DataFrame:
    """``doc_id`` and ``text`` with every span found replaced by its kind in angle brackets.

    Spans of different kinds that overlap are replaced together by the kind that begins first. A null text stays
    null; all else as in ``scan``.
    """
    # Fold over the spans in order: what is written so far, and where the next character to copy stands.
    start = F.struct(F.array().cast("array<string>").alias("parts"), F.lit(0).cast("long").alias("at"))

    def step(state: Column, span: Column) -> Column:
        before = F.col("text").substr((state["at"] + 1).cast("int"), (span["start"] - state["at"]).cast("int"))
        mark = F.concat(F.lit("<"), span["kind"], F.lit(">"))
        return F.when(span["start"] >= state["at"], F.struct(
            F.concat(state["parts"], F.array(before, mark)).alias("parts"), span["end"].alias("at"))).otherwise(
            F.struct(state["parts"].alias("parts"), F.greatest(state["at"], span["end"]).alias("at")))

    rest = F.lit(2147483647)
    text = F.aggregate("spans", start, step, lambda s: F.concat(
        F.array_join(s["parts"], ""), F.col("text").substr((s["at"] + 1).cast("int"), rest)))
    return scan(docs, rules).select("doc_id", F.when(F.size("spans") > 0, text).otherwise(F.col("text")).alias("text"))


def written(spans: Column) -> Column:
    """Spans as ``kind:start:end``, joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def _oracle() -> str:
    """The same in DuckDB: texts of matches and what lies between them give the places."""
    def found(k: int, rule: Rule) -> str:
        pattern = rule.pattern.replace("'", "''")
        keeps = "" if rule.keeps is None else f" where regexp_full_match(m, '{rule.keeps.replace(chr(39), chr(39) * 2)}')"
        return f"""
            select doc_id, {k} as rule, '{rule.kind}' as kind, s, s + length(m) as e from (
              select doc_id, row, unnest(ms) as m,
                     unnest(list_transform(range(1, len(ms) + 1), lambda i:
                       list_sum(list_transform(gaps[1:i], lambda g: length(g)))
                       + coalesce(list_sum(list_transform(ms[1:i - 1], lambda g: length(g))), 0)))::bigint as s
              from (select doc_id, row, regexp_extract_all(t, '{pattern}') as ms, regexp_split_to_array(t, '{pattern}') as gaps
                    from texts where regexp_matches(t, '{pattern}'))){keeps}"""

    union = " union all ".join(found(k, rule).replace("select doc_id, ", "select row, ", 1) for k, rule in enumerate(RULES))
    base = len(BASE)
    counts = ", ".join(f"count(*) filter (rule = {k})::bigint as n_{rule.kind}" for k, rule in enumerate(BASE))
    order = "order by s, rule"
    one = "kind || ':' || s || ':' || e"
    return f"""
        with texts as (select row_number() over () as row, doc_id, coalesce(text, '') as t from documents),
             spans as ({union})
        select t.doc_id, {', '.join(f'coalesce(n_{r.kind}, 0) as n_{r.kind}' for r in BASE)},
               sha256(coalesce(base, '')) as base_sha256, coalesce(spans, '') as spans
        from texts t left join (
          select row, {counts}, string_agg({one}, ',' {order}) filter (rule < {base}) as base,
                 string_agg({one}, ',' {order}) as spans
          from spans group by row) s using (row)"""


ORACLE_SQL = _oracle()
