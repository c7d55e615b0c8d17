"""Line dedup with a tree of log templates.

Lines with a digit in a word have that word replaced by a mark. The tree has a fixed depth:
the number of words, then the first ``depth`` of them, lead to a leaf: at most half the words, so
that short lines have room for a field, but both or the only word of the shortest, which have
none. Within a leaf a word is fixed where ``min_docs`` texts or more have it at that place; any
other word is a variable field and becomes a mark, too. Of a template's words a share of ``1 -
fixed`` may be such fields, or one in lines of three or four words; words with digits are not
fixed either. At least half its words, and two where there are three or more, must be fixed, so
rows of numbers are no template. Lines of one template recur if ``min_docs`` different texts hold
them. Recurring lines are dropped from all texts but the first (by smallest key) that holds the
template, so no content disappears altogether.

Texts are compared, not rows: copies of a text count once, and all copies of the first text
keep the line. Leaves with fewer lines than ``min_docs`` are left out before any line moves,
which loses nothing, and equal lines are one row from there on.

Only DataFrame functions are used.

Defined results: a null text stays null; blank lines always stay; a text of any length is split
whole, in one row's memory; an empty table gives no rows; repeated rows get the same decision; a
null key counts as the smallest; of two texts with the smallest key the one with the lesser digest
is first; further columns are carried whatever their names, but for one named ``lines_dropped``,
which is replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from replyloom.llm.common import SPACES, text_key, words
from replyloom.session import materialize

DEPTH = 3
MIN_DOCS = 5
FIXED = 0.8
#: Lines of so few words are their own leaf and have no field.
WHOLE = 2
#: Lines of so few words may have one field, whatever the share of fixed words asked for.
ONE_FIELD = 4
MARK = "<*>"
#: A word with a digit: tried at starts of words only and without backtracking.
DIGIT_WORD = r"(?<![^\x20\x09-\x0D])[^0-9\x20\x09-\x0D]*+[0-9][^\x20\x09-\x0D]*+"


def masked(line: Column) -> Column:
    return F.when(line.rlike("[0-9]"), F.regexp_replace(line, DIGIT_WORD, MARK)).otherwise(line)


def lead_size(n: Column, depth: int) -> Column:
    """How many words of a line lead to its leaf."""
    return F.when(n <= WHOLE, n).otherwise(F.least(F.lit(depth), F.floor(n / 2).cast("int")))


def is_template(n: Column, known: Column, fields: Column, fixed: float) -> Column:
    """Whether a line of ``n`` words may recur of which ``known`` are fixed and ``fields`` vary."""
    most = F.when(n <= WHOLE, 0.0).when(n <= ONE_FIELD, 1.0).otherwise(n * F.lit(1 - fixed) + 1e-9)
    return (fields <= most) & (known * 2 >= n) & (known >= F.least(F.lit(2), n - 1)) & (known >= 1)


def tree_lines(docs: DataFrame, text: str, key: str, depth: int) -> DataFrame:
    """``text_id, key, pos, line`` and the leaf ``(n, lead)`` of every line that is not blank."""
    # One chain per text and one generator: nothing is pushed below it and computed again.
    raw = F.split(F.coalesce(F.col(text), F.lit("")), "\n", -1)
    split = F.transform(F.transform(raw, masked), lambda x: F.struct(x.alias("line"), words(x).alias("words")))
    placed = F.transform(
        split,
        lambda x: F.struct(
            x["line"].alias("line"),
            F.size(x["words"]).alias("n"),
            F.xxhash64(F.slice(x["words"], F.lit(1), lead_size(F.size(x["words"]), depth))).alias("lead"),
        ),
    )
    rows = docs.select(
        text_key(F.col(text)).alias("text_id"), F.col(key).alias("key"), F.posexplode(placed).alias("pos", "x")
    )
    return rows.where(F.col("x.n") > 0).select("text_id", "key", "pos", "x.line", "x.n", "x.lead")


def dropped_lines(
    docs: DataFrame,
    text: str = "text",
    key: str = "doc_id",
    depth: int = DEPTH,
    min_docs: int = MIN_DOCS,
    fixed: float = FIXED,
) -> DataFrame:
    """``(text_id, dropped)``: positions of the lines to drop, for texts with any."""
    lines = tree_lines(docs, text, key, depth)
    leaf = ["n", "lead"]
    full = lines.groupBy(*leaf).count().where(F.col("count") >= min_docs).select(*leaf)
    words_only = F.array_join(words(F.col("line")), " ")
    held = materialize(lines.join(full, leaf, "left_semi").withColumn("line", words_only), "lines")

    # Equal lines once, with the number of texts that hold them.
    by_text = held.groupBy(*leaf, "line", "text_id").agg(F.min("key").alias("key"))
    distinct = materialize(by_text.groupBy(*leaf, "line").agg(F.count("*").alias("texts")), "distinct")
    placed = distinct.select(
        *leaf, F.md5("line").alias("line_id"), "texts", F.posexplode(F.split("line", " ")).alias("at", "word")
    )
    common = (
        placed.groupBy(*leaf, "at", "word")
        .agg(F.sum("texts").alias("texts"))
        .where(F.col("texts") >= min_docs)
        .select(*leaf, "at", "word", F.lit(True).alias("common"))
    )
    number = F.col("word") == MARK
    general = placed.join(common, [*leaf, "at", "word"], "left").select(
        *leaf, "line_id", "at", F.when(F.col("common") | number, F.col("word")).alias("word"), number.alias("number")
    )
    templates = (
        general.groupBy(*leaf, "line_id")
        .agg(
            F.sort_array(F.collect_list(F.struct("at", F.coalesce("word", F.lit(MARK)).alias("word")))).alias("words"),
            F.count_if(F.col("word").isNotNull() & ~F.col("number")).alias("known"),
            F.count_if(F.col("word").isNull()).alias("fields"),
        )
        .where(is_template(F.col("n"), F.col("known"), F.col("fields"), fixed))
        .select(*leaf, "line_id", F.md5(F.array_join(F.col("words.word"), " ")).alias("template"))
    )
    member = ["n", "lead", "template"]
    marked = materialize(
        held.select(*leaf, F.md5("line").alias("line_id"), "text_id", "key", "pos")
        .join(templates, [*leaf, "line_id"])
        .select(*member, "text_id", "key", "pos"),
        "marked",
    )
    recurring = (
        marked.groupBy(*member, "text_id")
        .agg(F.min(F.struct("key", "text_id")).alias("first"))
        .groupBy(*member)
        .agg(F.count("*").alias("texts"), F.min("first").alias("first"))
        .where(F.col("texts") >= min_docs)
        .select(*member, F.col("first.text_id").alias("kept_in"))
    )
    return (
        marked.join(recurring, member)
        .where("text_id <> kept_in")
        .groupBy("text_id")
        .agg(F.collect_set("pos").alias("dropped"))
    )


def drop_lines(docs: DataFrame, text: str = "text", key: str = "doc_id", **options) -> DataFrame:
    """``docs`` with recurring lines taken out of ``text``, and ``lines_dropped`` (long)."""
    dropped = materialize(dropped_lines(docs, text, key, **options), "dropped")
    whole = docs.select(F.struct("*").alias("row"), text_key(F.col(text)).alias("text_id"))
    joined = whole.join(dropped, "text_id", "left")
    lines = F.split(F.col("row")[text], "\n", -1)
    left = F.array_join(F.filter(lines, lambda line, i: ~F.array_contains("dropped", i)), "\n")
    kept = F.when(F.col("dropped").isNull(), F.col("row")[text]).otherwise(left)
    names = [c for c in docs.columns if c != "lines_dropped"]
    return joined.select(
        *[kept.alias(c) if c == text else F.col("row")[c].alias(c) for c in names],
        F.coalesce(F.size("dropped"), F.lit(0)).cast("long").alias("lines_dropped"),
    )
