"""Columns over a conversation: ``ARRAY<STRUCT<from STRING, value STRING>>``."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import fixed_values as fixed
from .text import norm_role, py_strip

CONVERSATION = "array<struct<`from`:string,value:string>>"


def message(role: Column, value: Column) -> Column:
    return F.struct(role.alias("from"), value.alias("value"))


def _of(conv: Column) -> Column:
    return F.coalesce(conv, F.array().cast(CONVERSATION))


def _has_role(msg: Column, roles: Sequence[str]) -> Column:
    return norm_role(msg["from"]).isin(*roles)


def last_message(conv: Column, roles: Sequence[str]) -> Column:
    """Stripped value of the last message with one of ``roles``, ``''`` if none."""
    found = F.filter(conv, lambda m: _has_role(m, roles))
    return F.coalesce(py_strip(F.try_element_at(found, F.lit(-1))["value"]), F.lit(""))


def last_question(conv: Column) -> Column:
    return last_message(conv, fixed.QUESTION_ROLES)


def last_answer(conv: Column) -> Column:
    return last_message(conv, fixed.ANSWER_ROLES)


def last_exact(conv: Column, role: str) -> Column:
    """Value of the last message whose role is spelled exactly ``role``."""
    found = F.filter(conv, lambda m: m["from"] == role)
    return F.coalesce(F.try_element_at(found, F.lit(-1))["value"], F.lit(""))


def keep_prompt_roles(conv: Column) -> Column:
    """Only system and human messages; ``user`` is renamed, other spellings stay."""
    kept = F.filter(_of(conv), lambda m: _has_role(m, fixed.PROMPT_ROLES))
    return F.transform(
        kept,
        lambda m: message(
            F.when(norm_role(m["from"]) == "user", F.lit("human")).otherwise(m["from"]),
            m["value"],
        ),
    )


def replace_last_assistant(conv: Column, text: Column) -> Column:
    """Put ``text`` into the last answer, or append an answer if there is none."""
    whole = _of(conv)
    answers = F.transform(whole, lambda m, i: F.when(_has_role(m, fixed.ANSWER_ROLES), i))
    spot = F.coalesce(F.array_max(answers), F.size(whole))
    role = F.coalesce(F.get(whole, spot)["from"], F.lit("gpt"))
    return F.concat(
        F.slice(whole, F.lit(1), spot),
        F.array(message(role, text)),
        F.slice(whole, spot + 2, F.size(whole)),
    )


def delivery_conversations(conv: Column, text: Column) -> Column:
    """System and human messages with plain role names, followed by one answer."""
    kept = F.filter(_of(conv), lambda m: _has_role(m, fixed.PROMPT_ROLES))
    prompts = F.transform(
        kept,
        lambda m: message(
            F.when(norm_role(m["from"]) == "system", F.lit("system")).otherwise(F.lit("human")),
            F.coalesce(m["value"], F.lit("")),
        ),
    )
    return F.concat(prompts, F.array(message(F.lit("gpt"), text)))
