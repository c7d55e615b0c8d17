"""The registered queries as DuckDB SQL over the given tables."""

from __future__ import annotations

from replyloom.functions import fixed_values as fixed

from . import shapes
from .queries import TEMPLATE

# Whitespace as a regular expression class and as a set of characters to trim.
W = (
    r"[\x{09}-\x{0d}\x{1c}-\x{20}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}"
    r"\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
)
DIMS = fixed.DIMENSIONS
FIELDS = tuple(fixed.SCORE_RANGES)


def quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def strip(sql: str) -> str:
    return f"trim({sql}, {quoted(fixed.WHITESPACE)})"


def filled(template: str, /, **slots: str) -> str:
    """SQL for a text with slots: constants and expressions joined by ``||``."""
    sql = quoted(template)
    for name, expression in slots.items():
        sql = sql.replace("{" + name + "}", f"' || {expression} || '")
    return f"({sql})"


def replaced(sql: str, *patterns: str) -> str:
    for pattern in patterns:
        sql = f"regexp_replace({sql}, {quoted(pattern)}, '', 'g')"
    return sql


def spaced(pattern: str) -> str:
    return quoted(pattern.replace("W", W))


# -- common table expressions -------------------------------------------------------

TURNS = f"""turns AS (SELECT {shapes.CONV_ID} AS id, conv_id, turn, {shapes.PLAIN_ROLE} AS role, text AS value
  FROM conversations)"""
MESSY = f"""turns AS (SELECT {shapes.CONV_ID} AS id, conv_id, turn, {shapes.MESSY_ROLE} AS role,
  {shapes.MESSY_VALUE} AS value FROM conversations)"""
NORMAL = f"""normal AS (SELECT *, lower({strip('role')}) AS norm, {strip('value')} AS stripped FROM turns)"""
QUESTION = "arg_max(stripped, turn) FILTER (WHERE norm IN ('human', 'user'))"
ANSWER = "arg_max(stripped, turn) FILTER (WHERE norm IN ('gpt', 'assistant'))"
LAST = f"""last AS (SELECT id, conv_id, coalesce({QUESTION}, '') AS question, coalesce({ANSWER}, '') AS answer
  FROM normal GROUP BY ALL)"""
CONTEXT = f"""exact AS (SELECT id, conv_id, coalesce(arg_max(value, turn) FILTER (WHERE role = 'system'), '') AS sys,
    coalesce(arg_max(value, turn) FILTER (WHERE role = 'human'), '') AS human,
    coalesce(arg_max(value, turn) FILTER (WHERE role = 'gpt'), '') AS reference_answer
  FROM turns GROUP BY ALL),
context AS (SELECT id, conv_id AS original_idx, reference_answer,
    CASE WHEN sys <> '' THEN {filled(fixed.QUESTION_WITH_SYSTEM, system='sys', question='human')} ELSE human END AS question
  FROM exact WHERE human <> '')"""
RESPONSES = f"""responses AS (SELECT doc_id, {shapes.ORIGINAL_IDX} AS original_idx, {shapes.OUTPUT_IDX} AS output_idx,
  text AS model_answer, {shapes.RESPONSE} AS response FROM documents)"""


def messages(value: str = "role || ':' || value") -> str:
    return f"count(*) AS messages, md5(string_agg({value}, chr(10) ORDER BY turn)) AS conversations_md5"


_CLEAN = replaced("response", *fixed.THINK_BLOCKS, r"(?s).*?\n\n")
_KEYED = "(json_exists({0}, '$.correctness') OR json_exists({0}, '$.total_score'))"
_FOUND = f"""list_filter(list_concat(
    regexp_extract_all(clean, {spaced(fixed.ROBUST_CORRECTNESS)}), regexp_extract_all(clean, {spaced(fixed.ROBUST_TOTAL)})),
    lambda x: CASE WHEN json_valid(x) THEN {_KEYED.format('x')} ELSE false END)[1]"""
ROBUST_OBJECT = f"""found AS (SELECT *, {_CLEAN} AS clean,
    regexp_extract(response, {spaced(fixed.ROBUST_TAG)}, 1) AS tagged FROM responses),
braces AS (SELECT *, regexp_extract(clean, '(?s)\\{{.*\\}}') AS braced FROM found),
objects AS (SELECT *, CASE WHEN json_valid(tagged) THEN tagged
    WHEN CASE WHEN json_valid(braced) THEN {_KEYED.format('braced')} ELSE false END THEN braced
    ELSE {_FOUND} END AS obj FROM braces)"""
STRICT_OBJECT = f"""found AS (SELECT *, regexp_extract(response, {spaced(fixed.STRICT_TAG)}, 1) AS tagged,
    regexp_extract(response, {spaced(fixed.STRICT_BARE)}) AS bare FROM responses),
objects AS (SELECT *, CASE WHEN tagged <> '' THEN CASE WHEN json_valid(tagged) THEN tagged END
    WHEN json_valid(bare) THEN bare END AS obj FROM found)"""


def _number(name: str) -> str:
    text = f"json_extract_string(obj, '$.{name}')"
    return f"CASE {text} WHEN 'true' THEN 1.0::DOUBLE WHEN 'false' THEN 0.0::DOUBLE ELSE TRY_CAST({text} AS DOUBLE) END"


def _scored(strict: bool) -> str:
    absent = fixed.NO_SCORE_STRICT if strict else fixed.NO_SCORE_ROBUST
    cases = [f"WHEN obj IS NULL THEN '{absent}'"]
    cases += [f"WHEN NOT json_exists(obj, '$.{n}') THEN 'Missing field: {n}'" for n in FIELDS]
    for name, (low, high) in fixed.SCORE_RANGES.items():
        seen = f" || ': ' || json_extract_string(obj, '$.{name}')" if strict else ""
        span = f" [{low}, {high}]" if strict else ""
        cases.append(
            f"WHEN json_type(obj, '$.{name}') NOT IN ('UBIGINT', 'BIGINT', 'DOUBLE', 'BOOLEAN')"
            f" THEN '{name} is not a number'{seen}"
        )
        cases.append(
            f"WHEN NOT ({_number(name)} BETWEEN {low} AND {high}) THEN '{name} out of range{span}'{seen}"
        )
    numbers = ", ".join(f"{_number(n)} AS v_{n}" for n in FIELDS)
    kept = ", ".join(f"CASE WHEN error IS NULL THEN v_{n} END AS {n}" for n in FIELDS)
    return f"""{STRICT_OBJECT if strict else ROBUST_OBJECT},
checked AS (SELECT *, CASE {' '.join(cases)} END AS error, {numbers},
    coalesce(json_extract_string(obj, '$.brief_comment'), '') AS v_comment FROM objects),
scored AS (SELECT * EXCLUDE (v_comment, {', '.join('v_' + n for n in FIELDS)}), {kept},
    CASE WHEN error IS NULL THEN v_comment END AS brief_comment FROM checked),
ok AS (SELECT * FROM scored WHERE error IS NULL)"""


ROBUST, STRICT = _scored(False), _scored(True)
SPREAD = """spread AS (SELECT original_idx, count(*) AS num_answers, max(total_score) AS max_score,
    min(total_score) AS min_score, max(total_score) - min(total_score) AS variance,
    avg(total_score) AS mean_score, stddev_pop(total_score) AS std_score
  FROM ok GROUP BY original_idx HAVING count(*) >= 2)"""
RUNS = """runs AS (SELECT original_idx, string_agg(CAST(total_score AS STRING) || 'x' || CAST(n AS STRING), ',' ORDER BY total_score DESC) AS all_scores
  FROM (SELECT original_idx, total_score, count(*) AS n FROM ok GROUP BY ALL) GROUP BY original_idx)"""
STATS = """stats AS (SELECT count(*) AS total_questions, avg(variance) AS mean_variance, median(variance) AS median_variance,
    stddev_pop(variance) AS std_variance, min(variance) AS min_variance, max(variance) AS max_variance,
    quantile_cont(variance, 0.25) AS p25, quantile_cont(variance, 0.5) AS p50, quantile_cont(variance, 0.75) AS p75,
    quantile_cont(variance, 0.9) AS p90, quantile_cont(variance, 0.95) AS p95, quantile_cont(variance, 0.99) AS p99
  FROM spread)"""
OUTPUTS = f"""outputs AS (SELECT 'output_' || output_idx AS output_name, count(*) AS samples, avg(total_score) AS mean_total,
    median(total_score) AS median_total, stddev_pop(total_score) AS std_total, max(total_score) AS max_total,
    min(total_score) AS min_total,
    {', '.join(f'avg({d}) AS mean_{d}, stddev_pop({d}) AS std_{d}' for d in DIMS)}
  FROM ok GROUP BY output_idx)"""
STAGE2_PAIRS = f"""pairs AS (SELECT id, question, answer, {shapes.STAGE2_RESPONSE} AS response
  FROM last WHERE question <> '' AND answer <> '')"""


def unthink(sql: str) -> str:
    return strip(replaced(sql, *fixed.THINK_MARKUP))


def compact(sql: str) -> str:
    return f"length(regexp_replace({sql}, '{W}+', '', 'g'))"


def is_short(response: str, source: str) -> str:
    wanted = f"greatest({fixed.MIN_LENGTH_FLOOR}, CAST(floor({compact(source)} * {fixed.MIN_LENGTH_RATIO}::DOUBLE) AS BIGINT))"
    return f"({source} <> '' AND {compact(response)} < {wanted})"


def rewrite(question: str, text: str) -> str:
    needs = filled(fixed.REWRITE_REQUIREMENTS, src_len=f"CAST({compact(text)} AS STRING)")
    body = filled(fixed.REWRITE_BODY, question=question, text=text)
    parts = [
        quoted(fixed.REWRITE_TASK), needs, quoted(fixed.REWRITE_FIRST_CLOSING),
        body, needs, quoted(fixed.REWRITE_LAST_CLOSING),
    ]
    return " || ".join(parts)


def templated(sql: str) -> str:
    return f"{quoted(TEMPLATE[0])} || {sql} || {quoted(TEMPLATE[1])}"


def judge_prompt() -> str:
    return filled(
        fixed.JUDGE_RUBRIC,
        question="question",
        reference_answer="reference_answer",
        model_answer="model_answer",
    )


JUDGED = "judged AS (SELECT * FROM ok JOIN context USING (original_idx))"
PREPARED = f"""prepared AS (SELECT original_idx, output_idx, question, reference_answer, model_answer,
    {judge_prompt()} AS raw_prompt
  FROM responses JOIN context USING (original_idx) WHERE model_answer <> '')"""


def hexed(start: int, length: int, modulo: int, digest: str) -> str:
    return f"CAST(('0x' || substr({digest}, {start}, {length}))::UBIGINT % {modulo} AS BIGINT)"


_DIGEST_SCORES = ", ".join(
    f"{hexed(1 + 4 * i, 4, high + 1, 'digest')} AS {name}"
    for i, (name, (_, high)) in enumerate(list(fixed.SCORE_RANGES.items())[:4])
)
VERDICTS = f"""prompts AS (SELECT *, {templated('raw_prompt')} AS prompt FROM prepared),
verdicts AS (SELECT *, md5(prompt) AS digest FROM prompts),
given AS (SELECT *, {_DIGEST_SCORES} FROM verdicts)"""
ASKED = "asked AS (SELECT id, question AS prompt FROM last WHERE question <> '')"
ENRICH = f"""docs AS (SELECT doc_id AS doc, {shapes.ORIGINAL_IDX} AS q, len(string_split(text, ' ')) % 5 AS form FROM documents),
keyed AS (SELECT doc, CASE WHEN form = 0 THEN -q - 1 WHEN form <> 1 THEN q END AS original_idx FROM docs),
nested AS (SELECT conv_id AS original_idx, {messages()} FROM turns GROUP BY conv_id),
enriched AS (SELECT doc, keyed.original_idx, messages, conversations_md5
  FROM keyed LEFT JOIN nested ON keyed.original_idx = nested.original_idx)"""
EARLIER = f"""earlier AS (SELECT {shapes.CONV_ID} AS id, CASE WHEN turn = 1 THEN 'failed' ELSE 'success' END AS status
  FROM conversations WHERE role = 'assistant')"""
SHARDS = f"shards AS (SELECT {shapes.SHARD_ID} AS id, {shapes.SHARD_FILE} AS file, conv_id, turn, text FROM conversations)"
USAGE = """counts AS (SELECT conv_id, turn, length(text) AS size,
    CASE WHEN turn % 4 = 0 OR length(text) = 0 THEN CASE WHEN turn % 4 < 2 THEN length(text) + 1 ELSE 0 END ELSE length(text) END AS prompt,
    CASE WHEN turn % 4 <> 1 AND conv_id <> 0 THEN conv_id ELSE 7 END AS completion FROM conversations),
usage AS (SELECT conv_id, turn, CAST(prompt AS BIGINT) AS prompt, CAST(completion AS BIGINT) AS completion, CAST(prompt + completion AS BIGINT) AS total FROM counts)"""
_PROMPT_ROLES = "norm IN ('system', 'human', 'user')"
_KEPT = f"SELECT id, {messages('CASE WHEN norm = ' + quoted('user') + ' THEN ' + quoted('human') + ' ELSE role END || ' + quoted(':') + ' || value')} FROM normal WHERE {_PROMPT_ROLES} GROUP BY id"


def answered(answer: str, extra: str = "", source: str = "normal") -> str:
    """Prompt messages with plain roles followed by one answer, per id of ``answers``."""
    role = "CASE WHEN norm = 'system' THEN 'system' ELSE 'human' END"
    return f"""rows AS (SELECT id, turn, {role} || ':' || value AS line FROM {source} WHERE {_PROMPT_ROLES}
  UNION ALL SELECT id, 1000000, 'gpt:' || {answer} FROM answers),
built AS (SELECT id, count(*) AS messages, md5(string_agg(line, chr(10) ORDER BY turn)) AS conversations_md5
  FROM rows WHERE id IN (SELECT id FROM answers) GROUP BY id)"""


def bins(table: str, value: str, edges: tuple, labels: list[str]) -> str:
    """Counts per bin, empty bins included."""
    last = len(labels) - 1
    values = ", ".join(
        f"({i}, '{label}', {edges[i]}, {edges[i + 1]}, {'true' if i == last else 'false'})"
        for i, label in enumerate(labels)
    )
    return f"""SELECT bin, label, count({value}) AS n,
    round(count({value}) * 100.0::DOUBLE / (SELECT count(*) FROM {table}), 6) AS percent
  FROM (VALUES {values}) AS b(bin, label, low, high, closed)
  LEFT JOIN {table} ON {value} >= low AND ({value} < high OR (closed AND {value} = high)) GROUP BY bin, label"""


def rounded(*names: str) -> str:
    return ", ".join(f"round({n}, 6) AS {n}" for n in names)


def flat_best_worst() -> str:
    pick = "first(struct_pack(o := output_idx, t := total_score, a := md5(model_answer), q := md5(question), r := md5(reference_answer)) ORDER BY {})"
    return f"""{JUDGED}, {RUNS}, picked AS (SELECT original_idx, count(*) AS num_answers,
    {pick.format('total_score DESC, output_idx')} AS b, {pick.format('total_score, output_idx DESC')} AS w
  FROM judged GROUP BY original_idx)
SELECT original_idx, b.q AS question_md5, b.r AS reference_answer_md5, num_answers, b.o AS best_output_idx,
  b.t AS best_total, b.a AS best_answer_md5, w.o AS worst_output_idx, w.t AS worst_total, w.a AS worst_answer_md5,
  b.t - w.t AS score_range, all_scores FROM picked JOIN runs USING (original_idx)"""


_SCORE_COLUMNS = ", ".join((*FIELDS, "brief_comment"))
_SUMMARY = f"""WITH {RESPONSES}, {ROBUST}, q AS (SELECT max(total_score) AS b, min(total_score) AS w FROM ok GROUP BY original_idx)
SELECT count(*) AS total_questions, round(avg(b), 6) AS avg_best_score, round(avg(w), 6) AS avg_worst_score,
  round(avg(b - w), 6) AS avg_score_range FROM q"""
_SPREAD_LABELS = [f"{a}-{b}" for a, b in zip(fixed.SPREAD_EDGES, fixed.SPREAD_EDGES[1:])]
_SPLIT_ROW = "md5('system:' || chr(10) || 'human:' || question || chr(10) || 'gpt:' || CASE WHEN contains(response, '</think>') THEN list_last(string_split(response, '</think>')) ELSE response END)"


_GIVEN_SCORES = f"""WITH {TURNS}, {CONTEXT}, {RESPONSES}, {PREPARED}, {VERDICTS} SELECT original_idx, 'output_' || output_idx AS output_name,
  {', '.join(f'CAST({d} AS DOUBLE) AS {d}' for d in DIMS)}, CAST({' + '.join(DIMS)} AS DOUBLE) AS total_score, digest AS brief_comment
  FROM given WHERE digest[1] <> '0'"""


SAME_RESULT = {
    "preference_summary": "best_worst_summary",
    "preference_histogram": "score_histogram",
    "preference_report": "run_report",
    "multi_turn_rounds": "multi_turn_infer",
    "spread_stats_ranked": "spread_stats",
    "output_stats_ranked": "output_stats",
    "top_spread_ranked": "top_spread",
    "written_run_report": "run_report",
    "written_prepare_report": "prepare_report",
    "written_usage": "usage_totals",
    "stage1_prepared": "answer_stage1",
    "stage2_prepared": "answer_stage2",
    "stage2_merge_only": "answer_stage2",
}


def oracle_sql() -> dict[str, str]:
    sql = _sql()
    return sql | {name: sql[other] for name, other in SAME_RESULT.items()}


def _sql() -> dict[str, str]:
    return {
        "extract_strict": f"WITH {RESPONSES}, {STRICT} SELECT original_idx, output_idx, error, {_SCORE_COLUMNS} FROM scored",
        "extract_robust": f"WITH {RESPONSES}, {ROBUST} SELECT original_idx, output_idx, error, {_SCORE_COLUMNS} FROM scored",
        "failed_scores": f"""WITH {RESPONSES}, {ROBUST} SELECT original_idx, output_idx, error,
  CASE WHEN obj IS NULL THEN substr(response, 1, {fixed.PREVIEW_CHARS}) END AS response_preview,
  md5(response) AS raw_response_md5,
  json_extract_string(obj, '$.brief_comment') AS seen_comment FROM scored WHERE error IS NOT NULL""",
        "failed_prepared": f"""WITH {RESPONSES}, {STRICT} SELECT original_idx, output_idx, error, md5(response) AS raw_response_md5,
  md5(model_answer) AS model_answer_md5 FROM scored WHERE error IS NOT NULL""",
        "run_report": f"""WITH {RESPONSES}, {ROBUST} SELECT count(*) AS total, count(*) FILTER (WHERE error IS NULL) AS success,
  count(*) FILTER (WHERE error IS NOT NULL) AS failed,
  round(count(*) FILTER (WHERE error IS NULL) * 100.0::DOUBLE / count(*), 6) AS success_rate FROM scored""",
        "best_worst": f"WITH {TURNS}, {CONTEXT}, {RESPONSES}, {ROBUST}, {flat_best_worst()}",
        "preference_pairs": f"WITH {TURNS}, {CONTEXT}, {RESPONSES}, {ROBUST}, {flat_best_worst()}",
        "best_worst_summary": _SUMMARY,
        "stats_json": _SUMMARY,
        "score_histogram": f"""WITH {RESPONSES}, {ROBUST} SELECT CAST(floor(total_score / 10) * 10 AS BIGINT) AS bin, count(*) AS answers,
  round(count(*) * 100.0::DOUBLE / (SELECT count(*) FROM ok), 6) AS percent FROM ok GROUP BY 1""",
        "score_spread": f"""WITH {RESPONSES}, {ROBUST}, {SPREAD}, {RUNS} SELECT original_idx, num_answers, max_score, min_score, variance,
  {rounded('mean_score', 'std_score')}, all_scores FROM spread JOIN runs USING (original_idx)""",
        "spread_stats": f"""WITH {RESPONSES}, {ROBUST}, {SPREAD}, {STATS} SELECT total_questions,
  {rounded('mean_variance', 'median_variance', 'std_variance', 'min_variance', 'max_variance', 'p25', 'p50', 'p75', 'p90', 'p95', 'p99')} FROM stats""",
        "spread_histogram": f"WITH {RESPONSES}, {ROBUST}, {SPREAD} {bins('spread', 'variance', fixed.SPREAD_EDGES, _SPREAD_LABELS)}",
        "spread_verdict": f"""WITH {RESPONSES}, {ROBUST}, {SPREAD}, {STATS} SELECT {rounded('mean_variance')},
  CASE WHEN mean_variance < 10 THEN 'low' WHEN mean_variance < 20 THEN 'moderate' ELSE 'high' END AS consistency,
  {rounded('p75')}, p75 < 15 AS p75_below_15 FROM stats""",
        "top_spread": f"""WITH {RESPONSES}, {ROBUST}, {SPREAD} SELECT original_idx, num_answers, variance, {rounded('mean_score')} FROM spread
  WHERE variance >= (SELECT quantile_cont(variance, 0.9) FROM spread) ORDER BY variance DESC, original_idx LIMIT 10""",
        "aggregate_scores": f"""WITH {TURNS}, {CONTEXT}, {RESPONSES}, {STRICT}, {JUDGED} SELECT original_idx, md5(question) AS question_md5,
  md5(reference_answer) AS reference_answer_md5,
  string_agg('output_' || output_idx || '=' || CAST(total_score AS STRING), ',' ORDER BY output_idx) AS scores
  FROM judged GROUP BY original_idx, question, reference_answer""",
        "explode_scores": f"""WITH {TURNS}, {CONTEXT}, {RESPONSES}, {STRICT}, {JUDGED} SELECT original_idx,
  'output_' || output_idx AS output_name, {_SCORE_COLUMNS} FROM judged""",
        "scores_csv": f"""WITH {TURNS}, {CONTEXT}, {RESPONSES}, {STRICT}, {JUDGED} SELECT original_idx AS sample_idx,
  'output_' || output_idx AS output_name, {_SCORE_COLUMNS} FROM judged""",
        "spread_report": f"""WITH {RESPONSES}, {ROBUST}, {SPREAD}
SELECT 'statistics' AS section, CAST(1 AS BIGINT) AS entries, CAST(count(*) AS DOUBLE) AS total FROM spread
UNION ALL SELECT 'distribution', CAST({len(fixed.SPREAD_EDGES) - 1} AS BIGINT), CAST(count(*) AS DOUBLE) FROM spread
UNION ALL SELECT 'details', count(*), round(sum(variance), 6) FROM spread""",
        "output_stats_approximate": f"""WITH {RESPONSES}, {STRICT} SELECT 'output_' || output_idx AS output_name, count(*) AS samples,
  quantile_disc(total_score, 0.5) AS median_total FROM ok GROUP BY output_idx""",
        "output_stats": f"""WITH {RESPONSES}, {STRICT}, {OUTPUTS} SELECT output_name, samples,
  {rounded('mean_total', 'median_total', 'std_total', 'max_total', 'min_total', *[f'{s}_{d}' for d in DIMS for s in ('mean', 'std')])} FROM outputs""",
        "evaluation_totals": f"""WITH {TURNS}, {CONTEXT}, {RESPONSES}, {STRICT}, {JUDGED} SELECT count(DISTINCT original_idx) AS samples,
  count(*) AS evaluations, round(count(*)::DOUBLE / count(DISTINCT original_idx), 6) AS per_sample FROM judged""",
        "grade_bands": f"WITH {RESPONSES}, {ROBUST} {bins('ok', 'total_score', fixed.GRADE_EDGES, list(fixed.GRADE_LABELS))}",
        "rank_outputs": f"""WITH {RESPONSES}, {STRICT}, {OUTPUTS} SELECT CAST(row_number() OVER (ORDER BY mean_total DESC, output_name) AS INT) AS rank,
  output_name, {rounded('mean_total')} FROM outputs""",
        "best_per_dimension": f"""WITH {RESPONSES}, {STRICT}, {OUTPUTS}, means AS (
  {' UNION ALL '.join(f"SELECT '{d}' AS dimension, output_name, mean_{d} AS mean FROM outputs" for d in DIMS)})
SELECT dimension, first(output_name ORDER BY mean DESC, output_name) AS output_name, round(max(mean), 6) AS mean FROM means GROUP BY dimension""",
        "score_counts": f"WITH {RESPONSES}, {ROBUST} SELECT original_idx, total_score, count(*) AS answers FROM ok GROUP BY original_idx, total_score",
        "score_lists": f"""WITH {RESPONSES}, {ROBUST} SELECT original_idx, total_score,
  CAST(row_number() OVER (PARTITION BY original_idx ORDER BY total_score DESC) - 1 AS INT) AS place FROM ok""",
        "quarantine": f"""WITH {RESPONSES}, {ROBUST} SELECT CASE WHEN error IS NULL THEN 'ok' ELSE 'failed' END AS file, original_idx, output_idx,
  CASE WHEN error IS NULL THEN md5(model_answer) END AS model_answer_md5, error FROM scored""",
        "stage_counters": f"""WITH {MESSY}, {NORMAL}, {LAST} SELECT count(*) AS total, count(*) FILTER (WHERE question <> '') AS stage1,
  count(*) FILTER (WHERE question <> '' AND answer <> '') AS stage2 FROM last""",
        "split_report": """SELECT count(*) AS total, count(*) FILTER (WHERE role <> 'system') AS written,
  count(*) FILTER (WHERE role = 'system') AS invalid_json FROM conversations""",
        "last_question": f"WITH {MESSY}, {NORMAL}, {LAST} SELECT id, md5(question) AS question_md5 FROM last",
        "last_answer": f"WITH {MESSY}, {NORMAL}, {LAST} SELECT id, md5(answer) AS answer_md5 FROM last",
        "keep_prompt_roles": f"""WITH {MESSY}, {NORMAL}, kept AS ({_KEPT}) SELECT ids.id, coalesce(messages, 0) AS messages,
  coalesce(conversations_md5, md5('')) AS conversations_md5 FROM (SELECT DISTINCT id FROM turns) ids LEFT JOIN kept USING (id)""",
        "normalize_stage1": f"""WITH {MESSY}, {NORMAL}, {LAST}, kept AS ({_KEPT}) SELECT id, messages, conversations_md5
  FROM kept JOIN last USING (id) WHERE question <> ''""",
        "normalize_stage2": f"""WITH {MESSY}, {NORMAL}, {LAST}, nested AS (SELECT id, {messages()} FROM turns GROUP BY id)
SELECT id, md5(question) AS question_md5, md5(answer) AS thinking_answer_text_md5, messages, conversations_md5
  FROM nested JOIN last USING (id) WHERE question <> '' AND answer <> ''""",
        "replace_last_assistant": f"""WITH {MESSY}, {NORMAL},
latest AS (SELECT id, max(turn) FILTER (WHERE norm IN ('gpt', 'assistant')) AS spot FROM normal GROUP BY id),
rows AS (SELECT id, turn, role || ':' || CASE WHEN turn = spot THEN 'new answer' ELSE value END AS line FROM normal JOIN latest USING (id)
  UNION ALL SELECT id, 1000000, 'gpt:new answer' FROM latest WHERE spot IS NULL)
SELECT id, {messages('line')} FROM rows GROUP BY id""",
        "delivery_conversations": f"""WITH {MESSY}, {NORMAL}, answers AS (SELECT DISTINCT id FROM turns), {answered("'new answer'")}
SELECT * FROM built""",
        "judge_context": f"""WITH {MESSY}, {CONTEXT} SELECT id, md5(question) AS question_md5,
  md5(reference_answer) AS reference_answer_md5 FROM context""",
        "with_row_id": f"""SELECT CASE WHEN role <> 'system' THEN {shapes.CONV_ID} ELSE 'line-' || CAST(conv_id * 100 + turn AS STRING) END AS id,
  conv_id * 100 + turn AS line FROM conversations""",
        "prepare_stage1": f"""WITH {MESSY}, {NORMAL}, {LAST} SELECT id, md5({templated('question')}) AS prompt_md5 FROM last WHERE question <> ''""",
        "prepare_stage2": f"""WITH {TURNS}, {NORMAL}, {LAST}, cleaned AS (SELECT id, question, {unthink('answer')} AS text FROM last
  WHERE question <> '' AND answer <> '') SELECT id, md5({templated(rewrite('question', 'text'))}) AS prompt_md5 FROM cleaned""",
        "prepare_judge": f"""WITH {TURNS}, {CONTEXT}, {RESPONSES}, {PREPARED} SELECT original_idx, output_idx, md5(question) AS question_md5,
  md5(reference_answer) AS reference_answer_md5, md5(model_answer) AS model_answer_md5, md5({templated('raw_prompt')}) AS prompt_md5 FROM prepared""",
        "prepare_report": f"""WITH {TURNS}, {CONTEXT}, {RESPONSES}, {PREPARED} SELECT count(DISTINCT original_idx) AS inputs, count(*) AS tasks,
  round(count(*)::DOUBLE / count(DISTINCT original_idx), 6) AS tasks_per_input FROM prepared""",
        "strip_think": f"WITH {TURNS}, {NORMAL}, {LAST}, {STAGE2_PAIRS} SELECT id, md5({unthink('response')}) AS response_md5 FROM pairs",
        "clean_think_blocks": f"WITH {RESPONSES} SELECT original_idx, output_idx, md5({_CLEAN}) AS response_md5 FROM responses",
        "compact_len": f"SELECT doc_id, CAST({compact('text')} AS BIGINT) AS compact_len FROM documents",
        "length_gate": f"""WITH {TURNS}, {NORMAL}, {LAST} SELECT id, md5(CASE WHEN {is_short('question', 'answer')} THEN answer ELSE question END) AS response_md5
  FROM last WHERE question <> '' AND answer <> ''""",
        "split_by_think": f"""WITH {TURNS}, {NORMAL}, {LAST}, {STAGE2_PAIRS} SELECT id, contains(response, '</think>') AS think,
  CAST(3 AS BIGINT) AS messages, {_SPLIT_ROW} AS conversations_md5 FROM pairs""",
        "merge_stage1": f"""WITH {MESSY}, {NORMAL},
latest AS (SELECT id, max(turn) FILTER (WHERE norm IN ('gpt', 'assistant')) AS spot FROM normal GROUP BY id),
outputs AS (SELECT id, turn AS asked, stripped AS answer FROM normal WHERE stripped <> ''),
rows AS (SELECT o.id, asked, turn, role || ':' || CASE WHEN turn = spot THEN answer ELSE value END AS line
    FROM outputs o JOIN normal USING (id) JOIN latest USING (id) WHERE asked <> 0
  UNION ALL SELECT o.id, asked, 1000000, 'gpt:' || answer FROM outputs o JOIN latest USING (id) WHERE spot IS NULL AND asked <> 0
  UNION ALL SELECT 'x' || id, asked, 1000000, 'gpt:' || answer FROM outputs WHERE asked = 0)
SELECT id, messages, conversations_md5 FROM (SELECT id, asked, {messages('line')} FROM rows GROUP BY id, asked)""",
        "merge_stage2": f"""WITH {TURNS}, {NORMAL}, {LAST}, {STAGE2_PAIRS},
cleaned AS (SELECT id, {unthink('response')} AS clean, {unthink('answer')} AS source FROM pairs),
answers AS (SELECT id, {is_short('clean', 'source')} AS replaced_short, CASE WHEN replaced_short THEN source ELSE clean END AS text
  FROM cleaned WHERE clean <> ''), {answered('text')}
SELECT id, replaced_short, messages, conversations_md5 FROM built JOIN answers USING (id)""",
        "merge_stage_report": f"""WITH {TURNS}, {NORMAL}, {LAST}, {STAGE2_PAIRS},
cleaned AS (SELECT id, {unthink('response')} AS clean, {unthink('answer')} AS source FROM pairs)
SELECT count(*) FILTER (WHERE clean <> '') AS written, count(*) FILTER (WHERE clean = '') AS skipped_empty,
  count(*) FILTER (WHERE clean <> '' AND {is_short('clean', 'source')}) AS short_replaced FROM cleaned""",
        "join_responses": f"""WITH {TURNS}, {CONTEXT}, {RESPONSES} SELECT original_idx, output_idx, md5(response) AS response_md5,
  md5(model_answer) AS model_answer_md5 FROM responses JOIN context USING (original_idx) WHERE model_answer <> ''""",
        "enrich_with_conversations": f"WITH {TURNS}, {ENRICH} SELECT * FROM enriched",
        "enrich_report": f"""WITH {TURNS}, {ENRICH} SELECT count(messages) AS enriched, count(*) - count(messages) AS missing,
  round(count(messages) * 100.0::DOUBLE / count(*), 6) AS rate FROM enriched WHERE original_idx IS NOT NULL""",
        "pending": f"""WITH {EARLIER} SELECT DISTINCT {shapes.CONV_ID} AS id, conv_id FROM conversations
  WHERE {shapes.CONV_ID} NOT IN (SELECT id FROM earlier WHERE status = 'success')""",
        "pending_any_status": f"""WITH {EARLIER} SELECT DISTINCT {shapes.CONV_ID} AS id, conv_id FROM conversations
  WHERE {shapes.CONV_ID} NOT IN (SELECT id FROM earlier)""",
        "merge_shards": f"""WITH {SHARDS} SELECT id, file, conv_id, turn, md5(text) AS text_md5 FROM (
  SELECT *, row_number() OVER (PARTITION BY id ORDER BY file, conv_id, turn) AS n FROM shards) WHERE n = 1 OR id = ''""",
        "length_quantiles": f"""SELECT lang, count(*) AS n,
  {', '.join(f"round(quantile_cont(length(text), {q}), 6) AS p{int(q * 100)}" for q in (0.25, 0.5, 0.75, 0.99))} FROM documents GROUP BY lang""",
        "ledger_resume": f"""WITH {TURNS}, {NORMAL}, {LAST}, {ASKED} SELECT id, CASE WHEN regexp_matches(md5(prompt), '^[a-f]') THEN 'second' ELSE 'first' END AS run,
  'answer ' || md5(prompt) AS response FROM asked""",
        "ledger_merge": f"""WITH {SHARDS}, first_run AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY file, conv_id, turn) AS n FROM shards WHERE turn > 1),
second_run AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY file, conv_id, turn) AS n FROM shards
  WHERE id = '' OR id NOT IN (SELECT id FROM first_run))
SELECT id, 'first' AS run, file, conv_id, turn, md5(text) AS text_md5 FROM first_run WHERE n = 1 OR id = ''
UNION ALL SELECT id, 'second', file, conv_id, turn, md5(text) FROM second_run WHERE n = 1 OR id = ''""",
        "merge_report": f"""WITH {SHARDS}, marked AS (SELECT id = '' OR row_number() OVER (PARTITION BY id ORDER BY file, conv_id, turn) = 1 AS kept FROM shards)
SELECT count(*) FILTER (WHERE kept) AS written, count(*) FILTER (WHERE NOT kept) AS duplicate, CAST(0 AS BIGINT) AS bad_json FROM marked""",
        "md5_shard_counts": f"""SELECT CAST(('0x' || substr(md5({shapes.CONV_ID}), 1, 16))::UBIGINT % 80 AS INT) AS shard, count(*) AS rows
  FROM conversations GROUP BY 1""",
        "mod_shard_counts": f"""WITH {TURNS}, {ENRICH} SELECT CAST(coalesce(((original_idx % 16) + 16) % 16, 0) AS INT) AS shard, count(*) AS rows
  FROM keyed GROUP BY 1""",
        "write_shards": f"""SELECT CAST(('0x' || substr(md5(id), 1, 16))::UBIGINT % 16 AS INT) AS shard, count(*) AS rows
  FROM (SELECT DISTINCT {shapes.CONV_ID} AS id FROM conversations) GROUP BY 1""",
        "shards_read_back": f"""WITH ids AS (SELECT {shapes.CONV_ID} AS id, count(*) AS messages FROM conversations GROUP BY 1)
SELECT CAST(('0x' || substr(md5(id), 1, 16))::UBIGINT % 16 AS INT) AS shard, count(*) AS rows, count(*) AS rows_read,
  CAST(sum(messages) AS BIGINT) AS messages, true AS has_files FROM ids GROUP BY 1""",
        "written_stage_counters": f"""WITH {MESSY}, {NORMAL}, {LAST} SELECT count(*) AS total, count(*) FILTER (WHERE question <> '') AS kept, CAST(1 AS INT) AS stage FROM last
UNION ALL SELECT count(*), count(*) FILTER (WHERE question <> '' AND answer <> ''), 2 FROM last""",
        "written_merge_report": f"""WITH {TURNS}, {NORMAL}, {LAST}, {STAGE2_PAIRS},
cleaned AS (SELECT id, {unthink('response')} AS clean, {unthink('answer')} AS source FROM pairs)
SELECT count(*) FILTER (WHERE clean <> '') AS written, count(*) FILTER (WHERE clean = '') AS skipped_empty,
  count(*) FILTER (WHERE clean <> '' AND {is_short('clean', 'source')}) AS short_replaced,
  count(*) FILTER (WHERE clean <> '') AS rows FROM cleaned""",
        "jsonl_roundtrip": f"WITH {TURNS} SELECT id, conv_id AS original_idx, {messages()} FROM turns GROUP BY id, conv_id",
        "jsonl_bad_lines": """SELECT CASE WHEN doc_id % 3 = 0 THEN doc_id END AS doc_id, CASE WHEN doc_id % 3 = 0 THEN md5(text) END AS text_md5,
  CASE WHEN doc_id % 3 = 0 THEN '' ELSE 'JSON parse error' END AS error FROM documents""",
        "line_numbers": "SELECT count(*) AS lines, true AS complete FROM conversations",
        "build_messages": """SELECT conv_id, turn, md5(CASE WHEN role = 'assistant' THEN 'assistant:' || text
  ELSE 'system:be brief' || chr(10) || 'user:' || text END) AS messages_md5 FROM conversations""",
        "merge_sampling_params": """SELECT conv_id, turn, CASE WHEN role = 'user' THEN round(turn::DOUBLE / 10, 6) ELSE 0.7::DOUBLE END AS temperature,
  0.95::DOUBLE AS top_p, CAST(3 AS INT) AS seed, CAST(CASE WHEN role <> 'user' THEN length(text) END AS INT) AS max_tokens FROM conversations""",
        "parse_envelope": """SELECT conv_id, turn, md5(CASE WHEN turn % 4 <> 3 THEN text ELSE '' END) AS response_md5,
  CASE turn % 4 WHEN 0 THEN role WHEN 3 THEN 'about ' || role END AS thinking FROM conversations""",
        "token_stats": f"WITH {USAGE} SELECT * FROM usage",
        "usage_totals": f"""WITH {USAGE} SELECT CAST(sum(prompt) AS BIGINT) AS prompt, CAST(sum(completion) AS BIGINT) AS completion,
  CAST(sum(total) AS BIGINT) AS total FROM usage""",
        "batch_infer": f"""WITH {TURNS}, {NORMAL}, {LAST}, {ASKED} SELECT id, md5(prompt) AS prompt_md5, 'answer ' || md5(prompt) AS response FROM asked
  WHERE NOT regexp_matches(md5(prompt), '^[a-f]')""",
        "batch_infer_keep": f"""WITH {TURNS}, {NORMAL}, {LAST}, {ASKED}, called AS (SELECT *, md5(prompt) AS d, regexp_matches(md5(prompt), '^[a-f]') AS bad FROM asked)
SELECT id, CASE WHEN NOT bad THEN 'answer ' || d END AS response, CASE WHEN NOT bad THEN substr(d, 9) END AS thinking,
  CASE WHEN NOT bad THEN length(prompt) END AS prompt, CASE WHEN NOT bad THEN CAST(39 AS BIGINT) END AS completion,
  CASE WHEN NOT bad THEN length(prompt) + 39 END AS total, CASE WHEN bad THEN 'failed' ELSE 'success' END AS _status,
  CASE WHEN bad THEN 'refused ' || substr(d, 1, 8) END AS _error FROM called""",
        "batch_infer_many": f"""WITH {TURNS}, {NORMAL}, {LAST}, {ASKED}, called AS (SELECT id, md5(prompt) AS d,
    '{{"temperature": ' || CAST(CAST((length(prompt) % 3)::DOUBLE / 10 AS DECIMAL(2, 1)) AS STRING) || '}} ' AS sent FROM asked)
SELECT id, CASE WHEN d[1] <> '0' THEN sent || d END AS response, CASE WHEN d[1] = '0' THEN 'failed' ELSE 'success' END AS _status,
  CASE WHEN d[1] = '0' THEN 'a prompt of the batch is refused' END AS _error FROM called""",
        "multi_turn_infer": f"""WITH {TURNS}, {NORMAL}, {LAST}, {ASKED},
one AS (SELECT id, 'answer ' || md5(prompt) AS a FROM asked),
two AS (SELECT id, a, CASE WHEN NOT regexp_matches(a, '[0-9]$') THEN 'answer ' || md5('and ' || a || '?') END AS b FROM one),
three AS (SELECT id, a, b, CASE WHEN b IS NOT NULL AND NOT regexp_matches(b, '[0-9]$') THEN 'answer ' || md5('and ' || b || '?') END AS c FROM two)
SELECT id, concat_ws('|', a, b, c) AS responses,
  CAST(2 * (1 + CASE WHEN b IS NULL THEN 0 ELSE 1 END + CASE WHEN c IS NULL THEN 0 ELSE 1 END) AS BIGINT) AS completion FROM three""",
        "resume_infer": f"""WITH {TURNS}, {NORMAL}, {LAST}, {ASKED}, {EARLIER} SELECT id, 'answer ' || md5(prompt) AS response FROM asked
  WHERE id NOT IN (SELECT id FROM earlier WHERE status = 'success')""",
        "stream_answers": f"WITH {TURNS}, {NORMAL}, {LAST}, {ASKED} SELECT id, 'answer ' || md5(prompt) AS response FROM asked",
        "judge_scores": _GIVEN_SCORES,
        "judge_resumed": _GIVEN_SCORES,
        "judge_repeated_idx": f"""WITH {TURNS}, {CONTEXT}, {RESPONSES}, {PREPARED}, {VERDICTS} SELECT original_idx, md5(question) AS question_md5,
  'output_' || output_idx AS output_name, CAST({' + '.join(DIMS)} AS DOUBLE) AS total_score, digest AS brief_comment
  FROM given WHERE digest[1] <> '0'""",
        "judge_retried": f"""WITH {TURNS}, {CONTEXT}, {RESPONSES}, {PREPARED}, {VERDICTS} SELECT original_idx, output_idx,
  CASE WHEN digest[1] = '0' THEN '{fixed.NO_SCORE_STRICT}' END AS error FROM given""",
        "judge_refused": f"""WITH {TURNS}, {CONTEXT}, {RESPONSES}, {PREPARED}, {VERDICTS} SELECT original_idx, output_idx,
  CASE WHEN digest[1] = '0' THEN '{fixed.NO_SCORE_STRICT}' WHEN regexp_matches(digest, '^[a-f]') THEN 'refused ' || substr(digest, 1, 8) END AS error FROM given""",
        "preference_scored": f"""WITH {RESPONSES}, {ROBUST} SELECT original_idx, output_idx, md5(model_answer) AS model_answer_md5, total_score FROM ok""",
        "preference_failed": f"""WITH {RESPONSES}, {ROBUST} SELECT original_idx, output_idx, error, md5(response) AS raw_response_md5
  FROM scored WHERE error IS NOT NULL""",
        "retry_calls": f"""WITH {TURNS}, {NORMAL}, {LAST}, {ASKED} SELECT id, 'answer ' || md5(prompt) || ' after ' ||
  CAST(1 + CAST('0x' || substr(md5(prompt), 1, 1) AS INT) % 3 AS STRING) AS response FROM asked""",
        "reduced_params": f"""WITH {TURNS}, {NORMAL}, {LAST}, {ASKED} SELECT id, 'answer ' || md5(prompt) || ' with ' ||
  CASE WHEN regexp_matches(md5(prompt), '^[a-f]') THEN 'temperature' ELSE 'stop,temperature' END AS response FROM asked""",
        "ordered_output": "SELECT doc_id, row_number() OVER (ORDER BY n_chars DESC, doc_id) - 1 AS place FROM documents",
        "stage1_repeated_ids": f"""WITH {TURNS}, {NORMAL}, {LAST},
keyed AS (SELECT id AS conv, conv_id, question, {shapes.REPEATED_ID} AS id FROM last WHERE question <> ''),
latest AS (SELECT id, max(conv_id) AS source FROM keyed GROUP BY id),
replied AS (SELECT k.conv, k.id, l.source, 'answer ' || md5(k.question) AS text FROM keyed k JOIN latest l ON k.id = l.id),
rows AS (SELECT r.conv, r.id, n.turn, CASE WHEN n.norm = 'user' THEN 'human' ELSE n.role END || ':' || n.value AS line
    FROM replied r JOIN normal n ON n.conv_id = r.source WHERE n.norm IN ('system', 'human', 'user')
  UNION ALL SELECT conv, id, 1000000, 'gpt:' || text FROM replied)
SELECT id, messages, conversations_md5 FROM (SELECT conv, id, {messages('line')} FROM rows GROUP BY conv, id)""",
        "stage2_empty_ids": f"""WITH {TURNS}, {NORMAL}, {LAST},
keyed AS (SELECT id AS conv, conv_id, question, {unthink('answer')} AS source, {shapes.REPEATED_ID} AS id
  FROM last WHERE question <> '' AND answer <> ''),
latest AS (SELECT id, max(conv_id) AS from_conv, arg_max(source, conv_id) AS last_source FROM keyed GROUP BY id),
replied AS (SELECT k.conv, k.id, l.from_conv, l.last_source, 'answer ' || md5({rewrite('k.question', 'k.source')}) AS reply
  FROM keyed k JOIN latest l ON k.id = l.id),
answers AS (SELECT *, {is_short('reply', 'last_source')} AS replaced_short FROM replied),
rows AS (SELECT a.conv, n.turn, CASE WHEN n.norm = 'system' THEN 'system' ELSE 'human' END || ':' || n.value AS line
    FROM answers a JOIN normal n ON n.conv_id = a.from_conv WHERE n.norm IN ('system', 'human', 'user')
  UNION ALL SELECT conv, 1000000, 'gpt:' || CASE WHEN replaced_short THEN last_source ELSE reply END FROM answers),
built AS (SELECT conv, {messages('line')} FROM rows GROUP BY conv)
SELECT id, replaced_short, messages, conversations_md5 FROM answers JOIN built USING (conv)""",
        "stage1_merge_only": f"""WITH {TURNS}, {NORMAL}, {LAST},
answers AS (SELECT id, 'answer ' || md5(question) AS text FROM last WHERE question <> '' AND NOT regexp_matches(md5(question), '^[a-f]')),
rows AS (SELECT id, turn, CASE WHEN norm = 'user' THEN 'human' ELSE role END || ':' || value AS line FROM normal WHERE {_PROMPT_ROLES}
  UNION ALL SELECT id, 1000000, 'gpt:' || text FROM answers)
SELECT id, {messages('line')} FROM rows WHERE id IN (SELECT id FROM answers) GROUP BY id""",
        "judge_failed": f"""WITH {TURNS}, {CONTEXT}, {RESPONSES}, {PREPARED}, {VERDICTS} SELECT original_idx, output_idx,
  '{fixed.NO_SCORE_STRICT}' AS error, 'I would rather not say.' AS raw_response, digest AS prompt_md5 FROM given WHERE digest[1] = '0'""",
        "answer_stage1": f"""WITH {MESSY}, {NORMAL}, {LAST}, answers AS (SELECT id, 'answer ' || md5(question) AS text FROM last WHERE question <> ''),
rows AS (SELECT id, turn, CASE WHEN norm = 'user' THEN 'human' ELSE role END || ':' || value AS line FROM normal WHERE {_PROMPT_ROLES}
  UNION ALL SELECT id, 1000000, 'gpt:' || text FROM answers)
SELECT id, {messages('line')} FROM rows WHERE id IN (SELECT id FROM answers) GROUP BY id""",
        "recorded_stage1": f"""WITH {MESSY}, {NORMAL}, {LAST},
answers AS (SELECT run, id, CASE WHEN run = 'template' THEN 'asked ' || md5({templated('question')}) ELSE 'answer ' || md5(question) END AS text
  FROM last, (VALUES ('first'), ('same'), ('template')) AS runs(run) WHERE question <> ''),
rows AS (SELECT run, id, turn, CASE WHEN norm = 'user' THEN 'human' ELSE role END || ':' || value AS line FROM normal JOIN answers USING (id) WHERE {_PROMPT_ROLES}
  UNION ALL SELECT run, id, 1000000, 'gpt:' || text FROM answers)
SELECT run, id, {messages('line')} FROM rows GROUP BY run, id""",
        "answer_stage2": f"""WITH {MESSY}, {NORMAL}, {LAST},
cleaned AS (SELECT id, question, {unthink('answer')} AS source FROM last WHERE question <> '' AND answer <> ''),
replied AS (SELECT id, source, 'answer ' || md5({templated(rewrite('question', 'source'))}) AS reply FROM cleaned),
answers AS (SELECT id, {is_short('reply', 'source')} AS replaced_short, CASE WHEN replaced_short THEN source ELSE reply END AS text FROM replied),
{answered('text')} SELECT id, replaced_short, messages, conversations_md5 FROM built JOIN answers USING (id)""",
    }
