"""Records of delimited text whose quoted fields hold line breaks.

A file is split wherever its blocks end, so a line can't know by itself whether it begins inside a quoted field. Each
line is read as a function of that one bit: what it leaves behind if it begins outside, and if it begins inside. Most
lines keep the bit, a line with one unpaired quote turns it, and some set it whatever came before. Functions of this
kind are put together by running sums, in each block and then over the blocks of a file (one row each), so files of any
size are read in many tasks. Lines that are a record by themselves are never grouped.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.sources.workspace import settle

# Paths looked up by broadcast; beyond that by shuffle.
MOST_BROADCAST_FILES = 100_000


def _field_patterns(sep: str, quote: str) -> tuple[str, str]:
    """Lines that leave a quoted field open: if they begin outside of one, and if they begin inside.

    A field is quoted only if the quote is its first character; two quotes inside stand for one. Possessive
    repetition keeps very long lines from being tried twice.
    """
    s, q = re.escape(sep), re.escape(quote)
    inside = f"(?:[^{q}]++|{q}{q})*+"
    closed = f"{q}{inside}{q}[^{s}]*+"
    plain = f"(?:[^{q}{s}][^{s}]*+)?+"
    fields = f"(?:(?:{closed}|{plain}){s})*+"
    return f"^{fields}{q}{inside}$", f"^{inside}(?:{q}[^{s}]*+{s}{fields}{q}{inside})?+$"


def with_state(lines: DataFrame, sep: str = ",", quote: str = '"') -> DataFrame:
    """``lines`` with ``sets`` (the bit a line leaves whatever came before, else null) and ``turns`` (1 if it turns it)."""
    from_outside, from_inside = _field_patterns(sep, quote)
    quoted = F.contains("line", F.lit(quote))
    opens, stays = quoted & F.col("line").rlike(from_outside), ~quoted | F.col("line").rlike(from_inside)
    return lines.withColumns({"__opens": opens, "__stays": stays}).withColumns({
        "__sets": F.when(F.col("__opens") == F.col("__stays"), F.col("__opens").cast("int")),
        "__turns": (F.col("__opens") & ~F.col("__stays")).cast("long")}).drop("__opens", "__stays")


def _state(window, sets: Column, turns: Column) -> tuple[Column, Column]:
    """What rows up to the window's end do together: the bit last set, and the turns since then."""
    last = F.last(F.when(sets.isNotNull(), F.struct(sets.alias("bit"), turns.alias("turns"))), ignorenulls=True).over(window)
    return last["bit"], F.pmod(turns - F.coalesce(last["turns"], F.lit(0)), F.lit(2))


def joined_records(lines: DataFrame, sep: str = ",", quote: str = '"') -> DataFrame:
    """``lines`` (``path, block, at, line`` and others) with every record that spans lines as one row.

    Its parts are joined by a line feed and it takes the place, ``block`` and ``at``, of its first line, and the other
    columns from there; lines of a block stand in the order of ``at``. A quote that is never closed takes in the rest of
    its file. One scan finds the files in which a line opens a field; the others are passed on as they are, and only
    files with such lines are sorted, by block.
    """
    names = [c for c in lines.columns if c not in ("path", "block", "at")]
    state = with_state(lines, sep, quote)
    # A file begins outside, so without a line that opens a field there is nothing to join.
    broken = settle(state.filter("__turns = 1 or __sets = 1").select("path").distinct(), "quoted_breaks")
    count = broken.count()
    if not count:
        return lines
    broken = broken if count > MOST_BROADCAST_FILES else F.broadcast(broken)
    own = state.join(broken, "path", "left_semi")
    whole = lines.join(broken, "path", "left_anti")

    in_block = Window.partitionBy("path", "block").orderBy("at")
    so_far = in_block.rowsBetween(Window.unboundedPreceding, 0)
    own = own.withColumn("__turned", F.sum("__turns").over(so_far))
    bit, turned = _state(so_far, F.col("__sets"), F.col("__turned"))
    own = own.withColumns({"__bit": bit, "__odd": turned})
    # What each block does as a whole, and from that the bit at its beginning.
    blocks = own.groupBy("path", "block").agg(F.max_by(F.struct("__bit", "__odd"), "at").alias("s")).select(
        "path", "block", F.col("s.__bit").alias("__b"), F.col("s.__odd").alias("__o"))
    of_file = Window.partitionBy("path").orderBy("block")
    up_to = of_file.rowsBetween(Window.unboundedPreceding, 0)
    blocks = blocks.withColumn("__all", F.sum(F.when(F.col("__b").isNull(), F.col("__o")).otherwise(0)).over(up_to))
    # After a block that sets the bit, only turns of later blocks count, and its own since it was set.
    marked = F.when(F.col("__b").isNotNull(), F.struct((F.col("__b") + F.col("__o")).alias("bit"), F.col("__all").alias("turns")))
    last = F.last(marked, ignorenulls=True).over(up_to)
    after = F.pmod(F.coalesce(last["bit"], F.lit(0)) + F.col("__all") - F.coalesce(last["turns"], F.lit(0)), F.lit(2))
    blocks = blocks.withColumn("__after", after).select(
        "path", "block", F.coalesce(F.lag("__after").over(of_file), F.lit(0)).alias("__begin"))
    own = own.join(blocks, ["path", "block"])
    ends_inside = F.pmod(F.coalesce("__bit", "__begin") + F.col("__odd"), F.lit(2)) == 1
    own = own.withColumn("__inside", ends_inside).withColumn(
        "__goes_on", F.coalesce(F.lag("__inside").over(in_block), F.col("__begin") == 1))
    # The line each one belongs to: the last that begins a record, in this block or an earlier one.
    heads = own.withColumn("__head", F.last(F.when(~F.col("__goes_on"), F.struct("block", "at")), ignorenulls=True).over(so_far))
    last_heads = heads.groupBy("path", "block").agg(F.max("__head").alias("__h")).withColumn(
        "__before", F.last("__h", ignorenulls=True).over(of_file.rowsBetween(Window.unboundedPreceding, -1))).drop("__h")
    alone = heads.filter(~F.col("__goes_on") & ~F.col("__inside")).select(*lines.columns)
    parts = (heads.filter(F.col("__goes_on") | F.col("__inside")).join(last_heads, ["path", "block"])
             .withColumn("__head", F.coalesce("__head", "__before")))
    row = F.struct("block", "at", *[f"`{c}`" for c in names])
    spans = (parts.groupBy("path", "__head").agg(F.sort_array(F.collect_list(row)).alias("rows"))
             .select("path", F.get("rows", F.lit(0)).alias("first"), F.array_join("rows.line", "\n").alias("__text")))
    spans = spans.select("path", "first.*", "__text").withColumn("line", F.col("__text")).select(*lines.columns)
    return whole.unionByName(alone).unionByName(spans)
