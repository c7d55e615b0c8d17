"""Chat requests and model replies as columns."""

from __future__ import annotations

from collections.abc import Mapping
from typing import Any

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import py_strip

MESSAGES = "array<struct<role:string,content:string>>"
USAGE = "struct<prompt:bigint,completion:bigint,total:bigint>"
_REPLY = (
    "struct<text:string,"
    "choices:array<struct<message:struct<content:string,reasoning:string,reasoning_content:string>>>,"
    "meta_info:map<string,string>,usage:map<string,string>>"
)


def read_reply(reply: Column) -> Column:
    """JSON text of a model reply as a struct."""
    return F.from_json(reply, _REPLY)


def parse_envelope(parsed: Column) -> Column:
    """``STRUCT<response, thinking>`` of a chat reply read by :func:`read_reply`.

    ``reasoning_content`` counts only where ``reasoning`` is absent; blank thinking is null.
    """
    msg = F.try_element_at(parsed["choices"], F.lit(1))["message"]
    thinking = py_strip(F.coalesce(msg["reasoning"], msg["reasoning_content"]))
    return F.struct(
        F.coalesce(msg["content"], F.lit("")).alias("response"),
        F.nullif(thinking, F.lit("")).alias("thinking"),
    )


def token_stats(parsed: Column) -> Column:
    """Token counts of a reply read by :func:`read_reply`; zero counts as missing."""
    counts = F.when(F.size(parsed["meta_info"]) > 0, parsed["meta_info"]).otherwise(parsed["usage"])

    def first_of(*names: str) -> Column:
        read = [F.nullif(counts[n].try_cast("bigint"), F.lit(0).cast("bigint")) for n in names]
        return F.coalesce(*read, F.lit(0).cast("bigint"))

    prompt = first_of("prompt_tokens", "input_tokens")
    completion = first_of("completion_tokens", "output_tokens")
    return F.struct(
        prompt.alias("prompt"),
        completion.alias("completion"),
        (prompt + completion).alias("total"),
    )


def build_messages(prompt: Column, messages: Column | None = None, system_prompt: str = "") -> Column:
    """Request messages: ``messages`` where not empty, else optional system text + prompt."""

    def turn(role: str, content: Column) -> Column:
        return F.struct(F.lit(role).alias("role"), content.alias("content"))

    turns = [turn("system", F.lit(system_prompt))] if system_prompt else []
    built = F.array(*turns, turn("user", F.coalesce(prompt, F.lit(""))))
    if messages is None:
        return built
    return F.when(F.size(messages) > 0, messages).otherwise(built)


def sampling_params(defaults: Mapping[str, Any], overrides: Mapping[str, Column]) -> Column:
    """Struct of request parameters: a row's own value, else the default."""
    names = [*defaults, *[n for n in overrides if n not in defaults]]
    fields = []
    for name in names:
        choices = [overrides[name]] if name in overrides else []
        if defaults.get(name) is not None:
            choices.append(F.lit(defaults[name]))
        if choices:
            fields.append(F.coalesce(*choices).alias(name))
    return F.struct(*fields)
