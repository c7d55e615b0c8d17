"""Quality rules as a ledger of bits.

Every text is measured once; each rule leaves one bit in ``failed`` (1: the text fails it).
A policy is a named set of rules, so that a new version of a policy, or the effect of leaving
one rule out, is an integer operation on the ledger and never reads a text again.

Defined results: a null text has no words and fails ``few_words``; an empty table gives an
empty ledger and no ablation rows; rows are measured one by one, so repeated rows, null or
repeated ids and further columns change nothing; a text of any length is measured whole.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from replyloom.llm.common import SPACE_BYTES, map_rows

SYMBOLS = b"#*$%&|<>"
UPPER = bytes(range(65, 91))
LETTERS = UPPER + bytes(range(97, 123))
CONTINUATION = bytes(range(0x80, 0xC0))

MEASURES = (
    "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
    "n_lines", "n_upper", "n_letters", "n_exclaims", "top_word",
)

#: Name and condition of failing, over the measurements; the position is the bit. Rules are
#: only ever appended, so that stored ledgers keep their meaning.
RULES: tuple[tuple[str, str], ...] = (
    ("few_words", "n_words < 50"),
    ("repeated_windows", "100 * n_repeat_words > 50 * n_words"),
    ("short_words", "word_chars < 2 * n_words"),
    ("long_words", "word_chars > 20 * n_words"),
    ("symbols", "10 * n_symbols > n_words"),
    ("repeated_lines", "2 * n_dup_lines > n_lines"),
    ("shouting", "2 * n_upper > n_letters and n_letters > 0"),
    ("exclaiming", "10 * n_exclaims > 3 * n_words"),
    ("one_word", "10 * top_word > 4 * n_words"),
)

BASE = ("few_words", "repeated_windows")
POLICIES: dict[str, tuple[str, ...]] = {
    "base": BASE,
    "v1": (*BASE, "short_words", "long_words", "symbols", "repeated_lines", "shouting"),
    "v2": tuple(name for name, _ in RULES),
}


def mask(rules: tuple[str, ...]) -> int:
    names = [name for name, _ in RULES]
    return sum(1 << names.index(rule) for rule in rules)


def measure(text: bytes | None) -> tuple[int, ...]:
    """The measurements of one text, in the order of :data:`MEASURES`."""
    text = text or b""
    n = len(text)
    found = text.split()
    spaces = n - len(text.translate(None, SPACE_BYTES))
    points = len(text.translate(None, CONTINUATION))
    lines = [line for line in text.split(b"\n") if line.strip()]
    upper = n - len(text.translate(None, UPPER))
    ids: dict[bytes, int] = {}
    coded = np.fromiter((ids.setdefault(w, len(ids)) for w in found), np.int64, len(found))
    return (
        len(found),
        points - spaces,
        n - len(text.translate(None, SYMBOLS)),
        len(lines) - len(set(lines)),
        _in_repeated_windows(coded),
        len(lines),
        upper,
        n - len(text.translate(None, LETTERS)),
        text.count(b"!"),
        int(np.bincount(coded).max()) if len(coded) else 0,
    )


def _in_repeated_windows(coded: np.ndarray) -> int:
    """Words within three-word windows that occur twice or more."""
    if len(coded) < 4:
        return 0
    distinct = int(coded.max()) + 1
    # Number the pairs first, so that the codes of windows stay small for any vocabulary.
    pairs = np.unique(coded[:-1] * distinct + coded[1:], return_inverse=True)[1].astype(np.int64)
    _, inverse, counts = np.unique(pairs[:-1] * distinct + coded[2:], return_inverse=True, return_counts=True)
    again = counts[inverse] > 1
    covered = np.zeros(len(coded), bool)
    for shift in range(3):
        covered[shift : shift + len(again)] |= again
    return int(covered.sum())


def ledger(docs: DataFrame, text: str = "text", keys: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keys``, the measurements and ``failed``: one row per row of ``docs``, in one scan."""
    types = dict(docs.dtypes)
    schema = ", ".join([*(f"`{k}` {types[k]}" for k in keys), *(f"{m} bigint" for m in MEASURES)])

    def run(rows: Iterator[dict]) -> Iterator[tuple]:
        for row in rows:
            yield *(row[f"key{i}"] for i in range(len(keys))), *measure(row["text"])

    chosen = docs.select(
        *[F.col(k).alias(f"key{i}") for i, k in enumerate(keys)], F.col(text).cast("binary").alias("text")
    )
    bits = [F.when(F.expr(rule), F.lit(1 << i)).otherwise(F.lit(0)) for i, (_, rule) in enumerate(RULES)]
    failed = bits[0]
    for bit in bits[1:]:
        failed = failed.bitwiseOR(bit)
    return map_rows(chosen, run, schema).withColumn("failed", failed.cast("long"))


def passes(policy: str, failed: str = "failed") -> Column:
    return F.col(failed).bitwiseAND(F.lit(mask(POLICIES[policy]))) == 0


def ablations(ledger: DataFrame, policy: str = "v2") -> DataFrame:
    """Per rule of a policy: ``rule``, rows that fail it, rows that fail nothing else of the
    policy (``only``, what the policy would keep without the rule), and all rows kept.

    Rows are counted per pattern of bits first: at most two to the number of rules of them.
    """
    chosen = mask(POLICIES[policy])
    patterns = ledger.groupBy(F.col("failed").bitwiseAND(F.lit(chosen)).alias("bits")).count()
    rules = F.explode(F.array(*[
        F.struct(F.lit(name).alias("rule"), F.lit(1 << i).cast("long").alias("bit"))
        for i, (name, _) in enumerate(RULES)
        if chosen >> i & 1
    ])).alias("r")
    rows = patterns.select("bits", "count", rules).select("bits", "count", "r.rule", "r.bit")

    def counted(condition: Column) -> Column:
        return F.coalesce(F.sum(F.when(condition, F.col("count"))), F.lit(0))

    return rows.groupBy("rule").agg(
        counted(F.col("bits").bitwiseAND(F.col("bit")) != 0).alias("fail"),
        counted(F.col("bits") == F.col("bit")).alias("only"),
        counted(F.col("bits") == 0).alias("kept"),
    )
