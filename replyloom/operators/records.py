"""Row-wise operators: normalising, preparing prompts, routing. No shuffle in any of them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import conversations as C
from ..functions import envelopes, prompts
from ..functions import fixed_values as fixed
from ..functions.prompts import Template
from ..functions.text import after_last_think, compact_len, strip_think_tokens
from ..session import Counters, materialize


def optional(df: DataFrame, name: str, kind: str = "string") -> Column:
    """A column, or a typed null where the frame has none of that name."""
    return F.col(name) if name in df.columns else F.lit(None).cast(kind)


def compute_once(df: DataFrame, **columns: Column) -> DataFrame:
    """Add columns that filters may test without being computed again for the test.

    A filter on a projected column is pushed below the projection together with a copy of
    the column's expression. It is not pushed below a generator, so the columns come from
    a one-element array.
    """
    kept = [F.col(f"`{c}`") for c in df.columns if c not in columns]
    fields = [column.alias(name) for name, column in columns.items()]
    return df.select(*kept, F.inline(F.array(F.struct(*fields))))


def line_id(df: DataFrame) -> Column:
    """``line-N``; a row that needs it and has no line fails, as nothing could find it again."""
    if "line" not in df.columns:
        return F.raise_error(F.lit("a row has neither id nor line")).cast("string")
    return F.concat(F.lit("line-"), F.col("line").cast("string"))


def with_row_id(df: DataFrame) -> DataFrame:
    """Fill a missing ``id`` with ``line-N``."""
    return df.withColumn("id", F.coalesce(optional(df, "id").cast("string"), line_id(df)))


def normalize_stage1(df: DataFrame, keep_id: bool = True) -> DataFrame:
    """Rows with a question, reduced to their prompt messages (and ``id``, unless told not to)."""
    kept = [c for c in ("id", "file", "line") if keep_id and c in df.columns]
    return df.where(C.last_question(F.col("conversations")) != "").select(
        *kept, C.keep_prompt_roles(F.col("conversations")).alias("conversations")
    )


def normalize_stage2(df: DataFrame) -> DataFrame:
    """Rows with question and answer; adds ``id``, ``question``, ``thinking_answer_text``."""
    row_id = F.coalesce(
        optional(df, "id").cast("string"), optional(df, "index").cast("string"), line_id(df)
    )
    found = compute_once(
        df,
        id=row_id,
        question=C.last_question(F.col("conversations")),
        thinking_answer_text=C.last_answer(F.col("conversations")),
    )
    return found.where((F.col("question") != "") & (F.col("thinking_answer_text") != ""))


def prepare_stage1(df: DataFrame, template: Template = None) -> DataFrame:
    """``{id, prompt}``: the last question, in a chat template if one is given."""
    rows = with_row_id(df).select("id", "conversations")
    asked = compute_once(rows, question=C.last_question(F.col("conversations")))
    return asked.where(F.col("question") != "").select(
        "id", prompts.apply_chat_template(F.col("question"), template).alias("prompt")
    )


def prepare_stage2(df: DataFrame, template: Template = None) -> DataFrame:
    """``{id, prompt}``: the instruction to rewrite ``thinking_answer_text``."""
    rows = with_row_id(df).select("id", "question", "thinking_answer_text")
    asked = compute_once(
        rows,
        question=prompts.stripped_text(F.col("question")),
        text=prompts.stripped_text(F.col("thinking_answer_text")),
    ).where((F.col("question") != "") & (F.col("text") != ""))
    cleaned = asked.withColumn("text", strip_think_tokens(F.col("text")))
    sized = cleaned.withColumn("src_len", compact_len(F.col("text")))
    prompt = prompts.rewrite_prompt(F.col("question"), F.col("text"), F.col("src_len"))
    return sized.select("id", prompts.apply_chat_template(prompt, template).alias("prompt"))


def judge_context(df: DataFrame) -> DataFrame:
    """Add ``question`` (with system context) and ``reference_answer``; drop rows without question."""
    conv = F.col("conversations")
    found = compute_once(
        df,
        _system=C.last_exact(conv, "system"),
        _human=C.last_exact(conv, "human"),
        reference_answer=C.last_exact(conv, "gpt"),
    ).where(F.col("_human") != "")
    with_system = prompts.fill_slots(
        fixed.QUESTION_WITH_SYSTEM, system=F.col("_system"), question=F.col("_human")
    )
    question = F.when(F.col("_system") != "", with_system).otherwise(F.col("_human"))
    return found.withColumn("question", question).drop("_system", "_human")


def with_original_idx(df: DataFrame) -> DataFrame:
    """``original_idx``: the row's own, else its line number."""
    names = [c for c in ("original_idx", "line") if c in df.columns]
    return df.withColumn("original_idx", F.coalesce(*[F.col(c).cast("bigint") for c in names]))


def prepare_judge(
    df: DataFrame,
    n_examples: int = 8,
    prefix: str = "output_",
    template: Template = None,
    mark_first: bool = False,
) -> DataFrame:
    """One row per question and non-empty candidate ``{prefix}0 … {prefix}{n-1}`` with its prompt.

    ``original_idx`` is the input's own, else its line number. The prompt is rendered
    after the unpivot, once per candidate. ``mark_first`` adds ``_first``, true for the first
    candidate of each input row.
    """
    names = [(i, f"{prefix}{i}") for i in range(n_examples)]
    candidates = [
        F.struct(F.lit(i).alias("output_idx"), F.col(name).alias("model_answer"))
        for i, name in names
        if name in df.columns
    ]
    if not candidates:
        raise ValueError(f"no candidate column {prefix}0 … {prefix}{n_examples - 1}")
    rows = judge_context(with_original_idx(df)).select(
        "original_idx",
        "question",
        "reference_answer",
        F.posexplode(F.filter(F.array(*candidates), lambda c: c["model_answer"] != "")).alias("_place", "_candidate"),
    ).select("original_idx", "question", "reference_answer", "_candidate.*", (F.col("_place") == 0).alias("_first"))
    prompt = prompts.judge_prompt(
        F.col("question"), F.col("reference_answer"), F.col("model_answer")
    )
    return rows.select(
        "original_idx",
        "output_idx",
        "question",
        "reference_answer",
        "model_answer",
        prompts.apply_chat_template(prompt, template).alias("prompt"),
        *(["_first"] if mark_first else []),
    )


def prepare_judge_counted(
    df: DataFrame, n_examples: int = 8, prefix: str = "output_", template: Template = None
) -> tuple[DataFrame, DataFrame]:
    """:func:`prepare_judge` written once, and its :func:`prepare_report` from the same job."""
    first = F.col("_first")
    tasks = prepare_judge(df, n_examples, prefix, template, mark_first=True)
    counters = Counters(inputs=F.count_if(first), tasks=F.count(F.lit(1)))
    written = materialize(counters.watch(tasks).drop("_first"), "prepared")
    return written, tasks_per_input(counters.row())


def normalize_counted(df: DataFrame, stage: int, label: str = "normalized") -> tuple[DataFrame, DataFrame]:
    """One of the two normalising steps, written once, and one row with the rows it read
    (``total``) and kept, counted by the job that writes."""
    read, kept = Counters(total=F.count(F.lit(1))), Counters(kept=F.count(F.lit(1)))
    step = normalize_stage1 if stage == 1 else normalize_stage2
    written = materialize(kept.watch(step(read.watch(df))), label)
    return written, read.row().crossJoin(kept.row())


def prepare_report(prepared: DataFrame) -> DataFrame:
    """One row: inputs with a task, tasks, tasks per input."""
    per_input = prepared.groupBy("original_idx").agg(F.count(F.lit(1)).alias("n"))
    counted = per_input.agg(
        F.count(F.lit(1)).alias("inputs"), F.coalesce(F.sum("n"), F.lit(0)).alias("tasks")
    )
    return tasks_per_input(counted)


def tasks_per_input(counted: DataFrame) -> DataFrame:
    average = F.coalesce(F.try_divide(F.col("tasks"), F.col("inputs")), F.lit(0.0))
    return counted.withColumn("tasks_per_input", average)


def counters(df: DataFrame, **conditions: Column) -> DataFrame:
    """One row with ``total`` and the number of rows meeting each condition."""
    counts = [F.count_if(cond).alias(name) for name, cond in conditions.items()]
    return df.agg(F.count(F.lit(1)).alias("total"), *counts)


def split_by_think(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(with, without)`` a closing think tag; each as a three-message conversation.

    With a tag, only the text after the last one is kept.
    """
    tagged = F.contains(F.col("response"), F.lit("</think>"))
    return tuple(
        df.where(tagged if has_tag else ~tagged).withColumn(
            "conversations", think_conversation(F.col("prompt"), F.col("response"))
        )
        for has_tag in (True, False)
    )


def think_conversation(prompt: Column, response: Column) -> Column:
    return F.array(
        C.message(F.lit("system"), F.lit("")),
        C.message(F.lit("human"), prompt),
        C.message(F.lit("gpt"), after_last_think(response)),
    )


def with_messages(df: DataFrame, system_prompt: str = "") -> DataFrame:
    """Set ``messages``: the row's own where not empty, else optional system text + prompt."""
    own = F.col("messages") if "messages" in df.columns else None
    built = envelopes.build_messages(optional(df, "prompt"), own, system_prompt)
    return df.withColumn("messages", built)


def merge_sampling_params(df: DataFrame, defaults: dict | None = None) -> DataFrame:
    """Set ``sampling_params``: defaults, overridden by a row's own values of five columns."""
    overrides = {name: F.col(name) for name in fixed.ROW_PARAMS if name in df.columns}
    return df.withColumn(
        "sampling_params", envelopes.sampling_params(defaults or {}, overrides)
    )
