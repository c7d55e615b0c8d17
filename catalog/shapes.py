"""Expressions that turn the given tables into inputs of the operators.

They are written in the SQL that Spark and DuckDB share, so both sides of a comparison
start from the same rows: every row and the whole text of ``conversations`` and
``documents``. Numbers derived from ids choose a *form* for a row, they never leave one out.
"""

from __future__ import annotations

NEWLINE = "chr(10)"

# conversations -> messages
PLAIN_ROLE = "CASE role WHEN 'user' THEN 'human' WHEN 'assistant' THEN 'gpt' ELSE role END"
_SPELLED = (
    "CASE WHEN role = 'user' AND conv_id % 3 = 0 THEN 'user' WHEN role = 'user' THEN 'human'"
    " WHEN role = 'assistant' AND turn % 3 = 0 THEN 'assistant'"
    " WHEN role = 'assistant' THEN 'gpt' ELSE role END"
)
MESSY_ROLE = (
    f"CASE WHEN (conv_id + turn) % 7 = 0 THEN upper({_SPELLED})"
    f" WHEN (conv_id + turn) % 7 = 1 THEN ' ' || {_SPELLED} || chr(9) ELSE {_SPELLED} END"
)
MESSY_VALUE = (
    "CASE (conv_id + turn) % 5 WHEN 0 THEN chr(160) || text || chr(9)"
    " WHEN 1 THEN chr(28) || text || chr(10) ELSE text END"
)
CONV_ID = "'c' || CAST(conv_id AS STRING)"

# documents -> candidates: ten answers to each question
CANDIDATES = 10
ORIGINAL_IDX = f"CAST(floor(doc_id / {CANDIDATES}) AS BIGINT)"
OUTPUT_IDX = f"CAST(doc_id % {CANDIDATES} AS INT)"

# documents -> judge responses in fourteen forms around the whole text
_C, _L = "(doc_id * 7) % 51", "(doc_id * 5) % 26"
_K, _M = "(doc_id * 3) % 16", "(doc_id * 2) % 11"
_TOTAL = f"({_C} + {_L} + {_K} + {_M})"


def _number(expression: str) -> str:
    return f"' || CAST({expression} AS STRING) || '"


def _score(**changed: str | None) -> str:
    """SQL string expression of a score object; ``None`` leaves a field out."""
    fields = {
        "correctness": _number(_C),
        "logic": _number(_L),
        "clarity": _number(_K),
        "completeness": _number(_M),
        "total_score": _number(_TOTAL),
        "brief_comment": '"doc ' + _number("doc_id") + '"',
        **changed,
    }
    body = ", ".join(f'"{k}": {v}' for k, v in fields.items() if v is not None)
    return "('{" + body + "}')"


_JSON = _score()
_FORMS = (
    f"text || {NEWLINE} || '<result>' || {_JSON} || '</result>'",
    f"text || {NEWLINE} || {_JSON}",
    f"'<think>x {{y}} ' || text || '</think>' || {NEWLINE} || {NEWLINE} || '<result> ' || {_JSON} || {NEWLINE} || '</result>'",
    "text",
    f"text || {_score(correctness='51')}",
    f"text || {_score(clarity=None)}",
    f"text || {_score(logic=chr(34) + '20' + chr(34))}",
    f"text || {_JSON} || text",
    f"{_JSON} || text || {_score(correctness='1')}",
    f"text || {_score(logic='true')}",
    f"text || '<result>{{\"correctness\": }}</result>' || {_JSON}",
    f"text || {_score(total_score=_number(f'CAST({_TOTAL} AS DOUBLE) / 2'))}",
    f"{_score(brief_comment=chr(34) + 'a {b} c' + chr(34))} || text",
    f"text || {NEWLINE} || {NEWLINE} || {_JSON} || {NEWLINE} || {NEWLINE} || text",
)
RESPONSE = (
    "CASE doc_id % 14 "
    + " ".join(f"WHEN {i} THEN {form}" for i, form in enumerate(_FORMS))
    + " END"
)

# a conversation's last question and answer -> rewriting responses in four forms
STAGE2_RESPONSE = (
    "CASE conv_id % 4"
    " WHEN 0 THEN '<think>' || answer || '</think>' || chr(10) || question"
    " WHEN 1 THEN answer || '</think>'"
    " WHEN 2 THEN '<think>' || question || '</think>' || chr(160)"
    " ELSE '<|begin_of_thought|>' || question || '<|end_of_thought|>' || answer || ' ' || question END"
)

# conversations -> shard rows: one pseudo-file per role, ids repeated by every turn
SHARD_FILE = "role || '.jsonl'"
SHARD_ID = "CASE WHEN role = 'system' THEN '' ELSE 'c' || CAST(conv_id AS STRING) END"

# Empty ids, ids that several conversations share, and ids of their own.
REPEATED_ID = """CASE WHEN conv_id % 4 = 0 THEN '' WHEN conv_id % 4 = 1 THEN 'again-' || CAST(conv_id % 10 AS STRING)
  ELSE 'own-' || CAST(conv_id AS STRING) END"""
