"""Line dedup by a deletion-neighbourhood join, in DataFrame functions only.

Two lines are duplicates if their word sequences differ by at most one edit (a word put in, taken out or
exchanged). A line emits itself and all its variants with one word deleted as hashed keys; duplicates share a
key: exchanged words give the same variant at the same place, and a word more or less gives a variant of one
line that is the other line. Lines that meet are verified word by word.

Two filters that lose nothing keep the emission small. Equal lines are first collapsed to one. And since one
edit leaves one half of the common variant untouched, only lines that share such a half with another line emit
variants at all.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import packed, same, text_hash
from ledgerloom.operators.ordering import ranked
from ledgerloom.sources.workspace import settle

# Lines without a letter or digit (blank lines, brackets, rules) are left alone.
COUNTED = r"[\p{L}\p{N}]"
# One edit in fewer words than this is under 0.8 similarity; such lines are duplicates only if equal.
MIN_WORDS = 5
# Lines that emit variants are looked up by broadcast up to this many (about 50 bytes each), by shuffle beyond.
BROADCAST_ROWS = 500_000


def _words(line: Column) -> Column:
    return F.array_remove(F.split(F.lower(line), r"\s+"), "")


def _counts(line: Column) -> Column:
    return F.rlike(line, F.lit(COUNTED))


def _lines(docs: DataFrame) -> DataFrame:
    """Every line that counts, with its row's id and hash and its place in the text."""
    return (docs.select(F.col("doc_id").cast("long"), text_hash(F.col("text")).alias("text_hash"),
                        F.posexplode(F.split("text", "\n")).alias("line_no", "line"))
            .where(_counts(F.col("line")))
            .select("doc_id", "text_hash", "line_no", _words(F.col("line")).alias("words"))
            .withColumn("n", F.size("words")))


def _variant_key(length: Column, *parts: Column) -> Column:
    """The hash of a word sequence; parts in a row hash like the whole."""
    return F.xxhash64(length, *parts)


def _halves() -> list[Column]:
    """The halves by which a line can meet another: of itself, and of its variants with one word deleted."""
    found = []
    for length in (F.col("n"), F.col("n") - 1):
        front = F.floor(length / 2).cast("int")
        back = length - front
        found.append(_variant_key(length, F.lit("front"), F.slice("words", F.lit(1), front)))
        found.append(_variant_key(length, F.lit("back"), F.slice("words", F.col("n") - back + 1, back)))
    return [F.when(F.col("n") >= MIN_WORDS, half) for half in found]


def _distinct_lines(docs: DataFrame) -> DataFrame:
    """One row for each different line: its 128-bit key, its first place and the halves by which it can meet."""
    lines = _lines(docs)
    keyed = lines.select(F.struct("doc_id", "text_hash", "line_no").alias("place"),
                         _variant_key(F.col("n"), F.col("words")).alias("key"),
                         F.xxhash64(F.lit("line"), F.col("words")).alias("second_key"),
                         *[half.alias(f"half{k}") for k, half in enumerate(_halves())])
    return keyed.groupBy("key", "second_key").agg(F.min("place").alias("place"),
                                                  *[F.min(f"half{k}").alias(f"half{k}") for k in range(4)])


def _meeting(lines: DataFrame) -> DataFrame:
    """The lines that share a half with another line; ``met`` has a bit for each half that does."""
    halves = lines.select("key", "second_key", F.posexplode(F.array(*[f"half{k}" for k in range(4)]))
                          .alias("kind", "half")).where(F.col("half").isNotNull())
    shared = halves.groupBy("half").agg(F.count("*").alias("lines")).where("lines > 1").select("half")
    met = (halves.join(shared, "half").groupBy("key", "second_key")
           .agg(F.bit_or(F.call_function("shiftleft", F.lit(1), F.col("kind"))).alias("met")))
    return lines.select("key", "second_key", "place").join(met, ["key", "second_key"])


def _variants(lines: DataFrame) -> DataFrame:
    """``variant``, the place ``gap`` of the deleted word (-1: none) and the line's ``rank``."""
    rest = F.col("n") - 1
    front = F.floor(rest / 2).cast("int")
    gap = F.col("gap")
    deleted_here = ((gap >= front) & (F.col("met").bitwiseAND(4) != 0)) | (
        (gap <= front) & (F.col("met").bitwiseAND(8) != 0))
    itself = (gap == -1) & (F.col("met").bitwiseAND(3) != 0)
    gaps = lines.select("rank", "met", "words", F.size("words").alias("n"),
                        F.explode_outer(F.sequence(F.lit(-1), F.size("words") - 1)).alias("gap"))
    return (gaps.where(itself | ((gap >= 0) & deleted_here))
            .select(F.when(gap == -1, _variant_key(F.col("n"), F.col("words")))
                    .otherwise(_variant_key(rest, F.slice("words", F.lit(1), F.greatest(gap, F.lit(0))),
                                            F.slice("words", F.greatest(gap, F.lit(0)) + 2, F.col("n"))))
                    .alias("variant"), "gap", "rank"))


def _within_one_edit(a: Column, b: Column) -> Column:
    """Whether two word arrays differ by at most one edit."""
    longer = F.when(F.size(a) >= F.size(b), a).otherwise(b)
    shorter = F.when(F.size(a) >= F.size(b), b).otherwise(a)
    exchanged = F.size(F.filter(F.zip_with(a, b, lambda x, y: ~x.eqNullSafe(y)), lambda differs: differs)) <= 1
    taken_out = F.exists(F.sequence(F.lit(0), F.size(longer) - 1), lambda gap: F.concat(
        F.slice(longer, F.lit(1), gap), F.slice(longer, gap + 2, F.size(longer))) == shorter)
    return F.when(F.size(a) == F.size(b), exchanged).when(F.abs(F.size(a) - F.size(b)) == 1, taken_out).otherwise(False)


def _near_duplicates(docs: DataFrame, lines: DataFrame) -> DataFrame:
    """Keys of the different lines that are within one edit of an earlier line."""
    meeting = ranked(_meeting(lines), [F.col("place")], "rank", "line_rank")
    place = meeting.select("place.*", "met", "rank")
    if meeting.count() <= BROADCAST_ROWS:
        place = F.broadcast(place)
    found = _lines(docs)
    worded = settle(found.join(place, same(found, place, "doc_id", "text_hash", "line_no"))
                    .select("rank", "met", "words").distinct(), "line_words")
    variants = _variants(worded)
    heads = variants.groupBy("variant", "gap").agg(F.min("rank").alias("earlier"))
    heads = heads.withColumnRenamed("gap", "head_gap")
    pairs = (variants.join(heads, "variant")
             .where("earlier < rank and (gap = head_gap or gap = -1 or head_gap = -1)")
             .select("rank", "earlier").distinct())
    earlier = worded.select(F.col("rank").alias("earlier"), F.col("words").alias("earlier_words"))
    near = (pairs.join(worded.select("rank", "words"), "rank").join(earlier, "earlier")
            .where(_within_one_edit(F.col("words"), F.col("earlier_words"))).select("rank").distinct())
    return meeting.join(near, "rank", "left_semi").select("key", "second_key")


def cleaned(docs: DataFrame) -> DataFrame:
    """What ``dedup_lines`` finds, with the columns of ``docs`` in one struct ``row``: ``row, text, n_lines, n_dropped``."""
    lines = settle(_distinct_lines(docs), "lines")
    kept = lines.join(_near_duplicates(docs, lines), ["key", "second_key"], "left_anti").select("place.*")
    kept = kept.groupBy("doc_id", F.col("text_hash").alias("_text_hash")).agg(F.collect_list("line_no").alias("kept"))
    rows = packed(docs)
    joined = rows.join(kept, same(rows, kept, "doc_id", "_text_hash"), "left").select("row", "kept")
    split = joined.withColumn("lines", F.split("row.text", "\n"))
    every = F.sequence(F.lit(0), F.size("lines") - 1)
    counting = F.filter(every, lambda k: _counts(F.get("lines", k)))
    dropped = F.array_except(counting, F.coalesce("kept", F.array().cast("array<int>")))
    told = F.col("row.text").isNotNull()
    marked = split.withColumn("dropped", F.when(told, dropped))
    rest = F.transform(F.array_except(every, F.col("dropped")), lambda k: F.get("lines", k))
    return marked.select("row", F.when(told, F.array_join(rest, "\n")).alias("text"),
                         F.when(told, F.size("lines")).alias("n_lines"),
                         F.when(told, F.size("dropped")).alias("n_dropped"))


def dedup_lines(docs: DataFrame) -> DataFrame:
    """``docs`` with the lines taken out that repeat an earlier line, and ``n_lines`` and ``n_dropped``.

    Lines are split at line feeds; a line counts if it has a letter or digit, others stay. Words are split at white
    space and compared in lower case. Earlier means a smaller doc_id (null first), then the text's hash, then the
    place in the text. A line goes if an equal line stands earlier, or if some earlier different line of five
    words or more is within one edit, whether that line itself stays or not. Rows with equal doc_id and text are
    copies of one row and lose the same lines. A null text stays null with null counts; an empty one has one line.
    Documents all of whose lines go keep an empty text. Texts of any length are read whole; an empty table gives an
    empty result. All other columns pass unchanged whatever their names, but for columns named like the two counts,
    which the counts replace (``cleaned`` keeps them).
    """
    counts = ["n_lines", "n_dropped"]
    return (cleaned(docs).select(F.col("row").withField("text", F.col("text")).alias("row"), *[F.col(c).alias(f"_{c}") for c in counts])
            .select(*[F.col("row").getField(c).alias(c) for c in docs.columns if c not in counts],
                    *[F.col(f"_{c}").alias(c) for c in counts]))


# The same by plain equality of strings: a line's variants are spelt out with the place of the missing word.
ORACLE_SQL = """
with all_lines as (
  select doc_id, unnest(string_split(text, chr(10))) as line, generate_subscripts(string_split(text, chr(10)), 1) as no
  from documents where text is not null),
worded as (
  select *, list_filter(regexp_split_to_array(lower(line), '[ \\t\\n\\x0B\\f\\r]+'), lambda w: w <> '') as words,
    regexp_matches(line, '[\\p{L}\\p{N}]') as counts
  from all_lines),
firsts as (
  select words, min((doc_id, no)) as place from worded where counts group by words),
long_lines as (select row_number() over () as id, *, len(words) as n from firsts where len(words) >= 5),
variants as (
  select id, place, -1 as gap, n, array_to_string(words, ' ') as variant from long_lines
  union all
  select id, place, gap, n - 1,
    array_to_string(list_concat(list_slice(words, 1, gap), list_slice(words, gap + 2, n)), ' ')
  from (select *, unnest(range(n)) as gap from long_lines)),
near as (
  select distinct l.id from variants l join variants e
    on l.variant = e.variant and l.n = e.n and (l.gap = e.gap or l.gap = -1 or e.gap = -1) and e.place < l.place),
kept as (
  select place from firsts where words not in (select words from long_lines join near using (id))),
marked as (
  select w.*, not counts or (doc_id, no) in (select place from kept) as stays from worded w)
select doc_id, count(*) as n_lines, count(*) filter (not stays) as n_dropped,
  coalesce(string_agg(line, chr(10) order by no) filter (stays), '') as text
from marked group by doc_id
"""
