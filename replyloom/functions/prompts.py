"""Prompt texts as columns."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import fixed_values as fixed
from .text import compact_len, py_strip

Template = tuple[str, str] | Callable[[Column], Column] | None


def fill_slots(template: str, /, **slots: Column) -> Column:
    """``template`` with each ``{name}`` replaced by a column, as one ``concat``.

    The slots are found in the constant, never in the data, so an answer that
    happens to contain ``{question}`` stays as it is.
    """
    parts = re.split(r"\{(" + "|".join(slots) + r")\}", template)
    return F.concat(*[slots[p] if i % 2 else F.lit(p) for i, p in enumerate(parts)])


def judge_prompt(question: Column, reference_answer: Column, model_answer: Column) -> Column:
    return fill_slots(
        fixed.JUDGE_RUBRIC,
        question=question,
        reference_answer=reference_answer,
        model_answer=model_answer,
    )


def rewrite_prompt(question: Column, cleaned: Column, src_len: Column) -> Column:
    """Instruction to rewrite a text without thinking.

    ``cleaned`` is the text without think markup, ``src_len`` its :func:`compact_len`.
    """
    requirements = fill_slots(fixed.REWRITE_REQUIREMENTS, src_len=src_len.cast("string"))
    return F.concat(
        F.lit(fixed.REWRITE_TASK),
        requirements,
        F.lit(fixed.REWRITE_FIRST_CLOSING),
        fill_slots(fixed.REWRITE_BODY, question=question, text=cleaned),
        requirements,
        F.lit(fixed.REWRITE_LAST_CLOSING),
    )


def apply_chat_template(prompt: Column, template: Template = None) -> Column:
    """Wrap a prompt: (prefix, suffix), a function of a column, or the raw prompt.

    A function may be any ``Column -> Column``, for instance a pandas UDF around a
    tokenizer's own template.
    """
    if template is None:
        return prompt
    if callable(template):
        return template(prompt)
    prefix, suffix = template
    return F.concat(F.lit(prefix), prompt, F.lit(suffix))


def length_gate(
    response: Column,
    source: Column,
    ratio: float = fixed.MIN_LENGTH_RATIO,
    floor: int = fixed.MIN_LENGTH_FLOOR,
    fallback: bool = True,
) -> Column:
    """``response``, or ``source`` where the response came out too short."""
    if not fallback:
        return response
    return F.when(is_short(response, source, ratio, floor), source).otherwise(response)


def is_short(response: Column, source: Column, ratio: float, floor: int) -> Column:
    """Shorter than ``max(floor, int(ratio * source length))``, with a source to fall back on."""
    wanted = F.greatest(
        F.lit(floor).cast("bigint"), (compact_len(source) * F.lit(float(ratio))).cast("bigint")
    )
    return (source != "") & (compact_len(response) < wanted)


def stripped_text(col: Column) -> Column:
    return F.coalesce(py_strip(col), F.lit(""))
