"""Score objects inside free text: find, parse strictly, validate.

Steps that a later step reads more than once are separate columns, added one
projection at a time by the operators in ``operators/scoring.py``; Catalyst then
evaluates each of them once.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import fixed_values as fixed
from .text import clean_think_blocks, spaced, up_to_last

SCORE = (
    "struct<correctness:double,logic:double,clarity:double,completeness:double,"
    "total_score:double,brief_comment:string>"
)
_END = "␞end␞"


def json_envelope(text: Column) -> Column:
    """Parse ``[text, end mark]``: the end mark survives only if ``text`` is one JSON value.

    ``try_parse_json(text)`` alone stops after the first value and accepts whatever
    follows it.
    """
    whole = F.concat(F.lit("["), text, F.lit(f',"{_END}"]'))
    return F.when(text != "", F.try_parse_json(whole))


def open_envelope(envelope: Column) -> Column:
    """The VARIANT inside a :func:`json_envelope`, null when the text was not strict JSON."""
    return F.when(
        F.try_variant_get(envelope, "$[1]", "string") == _END,
        F.try_variant_get(envelope, "$[0]", "variant"),
    )


def strict_json(text: Column) -> Column:
    """Text as VARIANT, null unless it is exactly one JSON value."""
    return open_envelope(json_envelope(text))


def field(obj: Column, name: str) -> Column:
    return F.try_variant_get(obj, f"$.{name}", "variant")


def has_score_key(obj: Column) -> Column:
    return field(obj, "correctness").isNotNull() | field(obj, "total_score").isNotNull()


# -- strict extraction ---------------------------------------------------------


def search(text: Column, needle: str, pattern: str, group: int) -> Column:
    """First match of ``pattern``; ``''`` or null if there is none.

    Only texts with ``needle`` are searched.
    """
    return F.when(F.contains(text, F.lit(needle)), F.regexp_extract(text, pattern, group))


def strict_tag(text: Column) -> Column:
    """JSON text of the first result tag.

    Searched up to the last brace that a closing tag follows, see :func:`up_to_last`.
    """
    ended = F.regexp_extract(up_to_last(text, "</result>"), spaced(r"(?s)^.*\}W*</result>"), 0)
    return F.when(F.contains(text, F.lit("<result>")), F.regexp_extract(ended, spaced(fixed.STRICT_TAG), 1))


def flat_objects(text: Column) -> Column:
    """All runs from an opening to a closing brace with no other between, in one pass."""
    return F.regexp_extract_all(text, F.lit(r"\{[^{}]*+\}"), 0)


def strict_bare(text: Column) -> Column:
    """The first flat object with the first and last score field, in this order
    (:data:`fixed.STRICT_BARE`)."""
    first, last = '"correctness"', '"total_score"'

    def both(found: Column) -> Column:
        after = F.substr(found, F.instr(found, first) + len(first))
        return F.contains(found, F.lit(first)) & F.contains(after, F.lit(last))

    objects = F.filter(flat_objects(text), both)
    return F.when(F.contains(text, F.lit(last)), F.try_element_at(objects, F.lit(1)))


def strict_candidate(text: Column) -> Column:
    """What the strict way parses: the tagged text, else the bare object."""
    tagged = strict_tag(text)
    return F.when(tagged != "", tagged).otherwise(strict_bare(text))


def extract_score_strict(text: Column) -> Column:
    """Score object as VARIANT; a bad tagged object is not replaced by a bare one."""
    return strict_json(strict_candidate(text))


# -- robust extraction ---------------------------------------------------------


def tag_candidate(text: Column) -> Column:
    """JSON text of the first result tag (:data:`fixed.ROBUST_TAG`): to the next closing tag,
    without the whitespace before it."""
    head = up_to_last(text, "</result>")
    found = search(head, "<result>", spaced(r"(?s)<result>W*+(\{.*?)</result>"), 1)
    return F.rtrim(found, F.lit(fixed.WHITESPACE))


def brace_candidate(cleaned: Column) -> Column:
    """From the first ``{`` to the last ``}``, in one anchored match that stays linear."""
    return search(cleaned, "{", fixed.OUTER_BRACES, 1)


def scan_candidates(cleaned: Column) -> Column:
    """First well-formed score object among all that look like one."""
    # What fixed.ROBUST_TOTAL finds are the flat objects with its field.
    found = F.concat(
        F.regexp_extract_all(up_to_last(cleaned, "}"), F.lit(spaced(fixed.ROBUST_CORRECTNESS)), 0),
        F.filter(flat_objects(cleaned), lambda x: F.contains(x, F.lit('"total_score"'))),
    )
    parsed = F.transform(F.transform(found, json_envelope), open_envelope)
    good = F.filter(parsed, has_score_key)
    return F.try_element_at(good, F.lit(1))


def robust_object(tagged: Column, braced: Column, cleaned: Column) -> Column:
    """First success of: tagged object, outermost braces, scan. Arguments are parsed columns."""
    return F.coalesce(tagged, F.when(has_score_key(braced), braced), scan_candidates(cleaned))


def extract_score_robust(text: Column) -> Column:
    """Score object as VARIANT, tried in several places."""
    cleaned = clean_think_blocks(text)
    return robust_object(
        strict_json(tag_candidate(text)), strict_json(brace_candidate(cleaned)), cleaned
    )


# -- validation ----------------------------------------------------------------


def score_fields(obj: Column) -> dict[str, Column]:
    """The raw score fields of an object, as VARIANT columns by name."""
    return {name: field(obj, name) for name in fixed.SCORE_RANGES}


def numeric(value: Column) -> Column:
    """A VARIANT as DOUBLE, null unless it is a JSON number or boolean."""
    kind = F.schema_of_variant(value)
    return F.when(
        kind.rlike("^(BIGINT|DECIMAL|DOUBLE|FLOAT|BOOLEAN)"), F.try_variant_get(value, "$", "double")
    )


def _shown(value: Column) -> Column:
    """A value as it appears in a strict error text."""
    kind = F.schema_of_variant(value)
    return (
        F.when(kind == "VOID", F.lit("None"))
        .when(kind == "BOOLEAN", F.initcap(F.try_variant_get(value, "$", "string")))
        .otherwise(F.coalesce(F.try_variant_get(value, "$", "string"), F.to_json(value)))
    )


def first_error(
    obj: Column, values: Mapping[str, Column], numbers: Mapping[str, Column], strict: bool = False
) -> Column:
    """What is wrong with an object; null if nothing is.

    ``values`` are its :func:`score_fields`, ``numbers`` the same made :func:`numeric`.
    Required fields come first, then type and range field by field. ``strict`` words the
    errors with value and range.
    """
    absent = F.lit(fixed.NO_SCORE_STRICT if strict else fixed.NO_SCORE_ROBUST)
    missing = [
        F.when(value.isNull(), F.lit(fixed.MISSING_FIELD.format(name=name))) for name, value in values.items()
    ]
    checks = []
    for name, (low, high) in fixed.SCORE_RANGES.items():
        not_number = F.lit(fixed.NOT_A_NUMBER.format(name=name))
        outside = F.lit(fixed.OUT_OF_RANGE.format(name=name))
        if strict:
            shown = _shown(values[name])
            not_number = F.concat(not_number, F.lit(fixed.SEEN_VALUE), shown)
            outside = F.concat(outside, F.lit(fixed.RANGE_AND_VALUE.format(low=low, high=high)), shown)
        number = numbers[name]
        checks.append(
            F.when(number.isNull(), not_number).when(~number.between(low, high), outside)
        )
    return F.coalesce(F.when(obj.isNull(), absent), *missing, *checks)


def validate_scores(obj: Column, strict: bool = False) -> Column:
    """``STRUCT<ok, error>`` of a score object, see :func:`first_error`."""
    values = score_fields(obj)
    numbers = {name: numeric(value) for name, value in values.items()}
    error = first_error(obj, values, numbers, strict)
    return F.struct(error.isNull().alias("ok"), error.alias("error"))


def score_struct(obj: Column, numbers: Mapping[str, Column]) -> Column:
    """Typed score struct of an object and its :func:`numeric` fields."""
    comment = F.coalesce(F.try_variant_get(obj, "$.brief_comment", "string"), F.lit(""))
    fields = [number.alias(name) for name, number in numbers.items()]
    return F.struct(*fields, comment.alias("brief_comment"))
