"""String columns: stripping, lengths and think markup (all JVM-side)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import fixed_values as fixed


def spaced(pattern: str) -> str:
    """Replace the stand-in ``W`` of a fixed pattern by the Unicode whitespace class."""
    return pattern.replace("W", fixed.WHITESPACE_CLASS)


def py_strip(col: Column) -> Column:
    """Strip Unicode whitespace from both ends, like ``str.strip``."""
    return F.trim(col, F.lit(fixed.WHITESPACE))


def norm_role(col: Column) -> Column:
    """Role name lower-cased and stripped."""
    return F.lower(py_strip(col))


def compact_len(col: Column) -> Column:
    """Number of characters that are not whitespace."""
    return F.length(F.regexp_replace(col, fixed.WHITESPACE_CLASS + "+", ""))


def after_last(col: Column, mark: str) -> Column:
    """Text after the last ``mark``; the whole text when there is none."""
    return F.substring_index(col, mark, -1)


def up_to_last(col: Column, mark: str) -> Column:
    """Text up to and including the last ``mark``; empty when there is none.

    A pattern that ends in ``mark`` matches nowhere else. Searched in this part only, its
    lazy repeats always find an end, so that no opening without one makes them run through
    the text in vain, again and again.
    """
    return F.left(col, F.length(col) - F.length(after_last(col, mark)))


def remove(col: Column, pattern: str, needle: str) -> Column:
    """Remove every match of ``pattern``; texts without ``needle`` are not searched."""
    return F.when(F.contains(col, F.lit(needle)), F.regexp_replace(col, pattern, "")).otherwise(col)


def remove_blocks(col: Column, pattern: str, opening: str, closing: str) -> Column:
    """Remove every match of a ``pattern`` from an opening to the next closing mark."""
    both = F.contains(col, F.lit(opening)) & F.contains(col, F.lit(closing))
    head = F.regexp_replace(up_to_last(col, closing), pattern, "")
    return F.when(both, F.concat(head, after_last(col, closing))).otherwise(col)


def strip_think_tokens(col: Column) -> Column:
    """Remove think blocks and stray think tokens, then strip."""
    blocks, tokens = fixed.THINK_MARKUP[0::2], fixed.THINK_MARKUP[1::2]
    for block, token, opening, closing in zip(blocks, tokens, fixed.THINK_OPENINGS, fixed.THINK_CLOSINGS):
        col = F.regexp_replace(remove_blocks(col, block, opening, closing), token, "")
    return py_strip(col)


def drop_to_last_blank_line(col: Column) -> Column:
    """Text after the last blank line, for :func:`clean_think_blocks`.

    Blank lines are newline pairs counted from the left, so an odd run of newlines
    leaves one behind. One anchored greedy match does it in time linear in the text.
    """
    return remove(col, r"(?s)^(?:.*[^\n])?(?:\n\n)+", "\n\n")


def clean_think_blocks(col: Column) -> Column:
    """Remove think blocks, then everything up to the last blank line."""
    for marks in zip(fixed.THINK_BLOCKS, fixed.THINK_OPENINGS, fixed.THINK_CLOSINGS):
        col = remove_blocks(col, *marks)
    return drop_to_last_blank_line(col)


def after_last_think(col: Column) -> Column:
    """Text after the last ``</think>``; the whole text when there is none."""
    return F.substring_index(col, "</think>", -1)
