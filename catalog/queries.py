"""Registered queries: each runs an operator over whole tables and flattens the result.

Long texts are compared by MD5; nested values by a joined string; doubles are rounded.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from replyloom.functions import conversations as C
from replyloom.functions import envelopes, prompts, sharding, text
from replyloom.operators import analysis, inference, ledgers, matching, quantiles, records, rounds, scoring
from replyloom.plans import RunLedger, record_stage1, run_judge, run_preference, run_stage1, run_stage2
from replyloom.session import configure, materialize, materialize_counted, new_path
from replyloom.sources import jsonl, sinks
from replyloom.streaming import stream_infer

from . import fixtures, models, shapes

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

SCORES = ("correctness", "logic", "clarity", "completeness", "total_score")
PREFIX = "output_"
TEMPLATE = ("<|user|>", "<|assistant|>")


def query(function: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return function(configure(spark), sf_dir)

    QUERIES[function.__name__] = run
    return function


# -- flattening -------------------------------------------------------------------


def digest(name: str, alias: str | None = None) -> Column:
    return F.md5(F.col(name)).alias(alias or f"{name.split('.')[-1]}_md5")


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    return df.select(
        *[F.round(F.col(c), digits).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes]
    )


def conversation(col: str = "conversations") -> list[Column]:
    turns = F.transform(col, lambda m: F.concat(m["from"], F.lit(":"), m["value"]))
    return [
        F.size(col).cast("bigint").alias("messages"),
        F.md5(F.array_join(turns, "\n")).alias("conversations_md5"),
    ]


def runs(col: str = "all_scores") -> Column:
    """Totals as ``totalxcount,…``, descending."""
    shown = F.transform(
        col, lambda r: F.concat(r["total_score"].cast("string"), F.lit("x"), r["answers"].cast("string"))
    )
    return F.array_join(shown, ",").alias(col)


def robust(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scoring.score_responses(fixtures.responses(spark, sf_dir), "robust")


def ok_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scoring.ok_rows(robust(spark, sf_dir))


# -- scores -----------------------------------------------------------------------


def _extracted(scored: DataFrame) -> DataFrame:
    return scored.select("original_idx", "output_idx", "error", "scores.*")


@query
def extract_strict(spark, sf_dir):
    return _extracted(scoring.score_responses(fixtures.responses(spark, sf_dir), "strict"))


@query
def extract_robust(spark, sf_dir):
    return _extracted(robust(spark, sf_dir))


@query
def failed_scores(spark, sf_dir):
    failed = scoring.failed_rows(robust(spark, sf_dir))
    return failed.select(
        "original_idx",
        "output_idx",
        "error",
        "response_preview",
        digest("raw_response"),
        F.get_json_object("extracted_score", "$.brief_comment").alias("seen_comment"),
    )


@query
def failed_prepared(spark, sf_dir):
    scored = scoring.score_responses(fixtures.responses(spark, sf_dir), "strict")
    return scoring.failed_prepared(scored).select(
        "original_idx", "output_idx", "error", digest("raw_response"), digest("model_answer")
    )


@query
def run_report(spark, sf_dir):
    return rounded(scoring.run_report(robust(spark, sf_dir)))


@query
def written_run_report(spark, sf_dir):
    """The report that the job writing scored and failed rows gathers."""
    return rounded(sinks.write_split(robust(spark, sf_dir), new_path(spark, "split")))


def flat_best_worst(df: DataFrame) -> DataFrame:
    columns = []
    for side in ("best", "worst"):
        answer = f"{side}_answer"
        columns += [
            F.col(f"{answer}.output_idx").alias(f"{side}_output_idx"),
            F.col(f"{answer}.scores.total_score").alias(f"{side}_total"),
            digest(f"{answer}.answer", f"{side}_answer_md5"),
        ]
    return df.select(
        "original_idx",
        digest("question"),
        digest("reference_answer"),
        "num_answers",
        *columns,
        "score_range",
        runs(),
    )


@query
def best_worst(spark, sf_dir):
    scored = scoring.score_responses(fixtures.judged(spark, sf_dir), "robust")
    return flat_best_worst(analysis.best_worst(scoring.ok_rows(scored)))


@query
def best_worst_summary(spark, sf_dir):
    return rounded(analysis.best_worst_summary(ok_scores(spark, sf_dir)))


@query
def score_histogram(spark, sf_dir):
    return rounded(analysis.score_histogram(ok_scores(spark, sf_dir)))


@query
def score_spread(spark, sf_dir):
    detail = analysis.spread_detail(ok_scores(spark, sf_dir))
    return rounded(
        detail.select(
            "original_idx", "num_answers", "max_score", "min_score", "variance", "mean_score", "std_score", runs()
        )
    )


@query
def spread_stats(spark, sf_dir):
    return rounded(analysis.spread_stats(analysis.score_spread(ok_scores(spark, sf_dir))))


@query
def spread_histogram(spark, sf_dir):
    return rounded(analysis.spread_histogram(analysis.score_spread(ok_scores(spark, sf_dir))))


@query
def spread_verdict(spark, sf_dir):
    stats = analysis.spread_stats(analysis.score_spread(ok_scores(spark, sf_dir)))
    return rounded(analysis.spread_verdict(stats))


@query
def top_spread(spark, sf_dir):
    top = analysis.top_spread(analysis.score_spread(ok_scores(spark, sf_dir)))
    return rounded(top.select("original_idx", "num_answers", "variance", "mean_score"))


def aggregated(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = scoring.score_responses(fixtures.responses(spark, sf_dir), "strict")
    context = records.judge_context(fixtures.conv_nested(spark, sf_dir))
    return analysis.aggregate_scores(scoring.ok_rows(scored), PREFIX, context=context)


@query
def aggregate_scores(spark, sf_dir):
    totals = F.transform(
        F.map_entries("scores"),
        lambda e: F.concat(e["key"], F.lit("="), e["value"]["total_score"].cast("string")),
    )
    return aggregated(spark, sf_dir).select(
        "original_idx",
        digest("question"),
        digest("reference_answer"),
        F.array_join(F.array_sort(totals), ",").alias("scores"),
    )


@query
def explode_scores(spark, sf_dir):
    return analysis.explode_scores(aggregated(spark, sf_dir))


def strict_output_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = scoring.score_responses(fixtures.responses(spark, sf_dir), "strict")
    return analysis.output_scores(scoring.ok_rows(scored), PREFIX)


@query
def output_stats(spark, sf_dir):
    return rounded(analysis.output_stats(strict_output_scores(spark, sf_dir)))


@query
def evaluation_totals(spark, sf_dir):
    return rounded(analysis.evaluation_totals(aggregated(spark, sf_dir)))


@query
def spread_report(spark, sf_dir):
    """The report written to one folder and read back: entries and a total per section."""
    path = new_path(spark, "spread-report")
    spread = materialize(analysis.score_spread(ok_scores(spark, sf_dir)), "spread")
    sinks.write_jsonl(analysis.spread_report(spread), path)
    rows = spark.read.schema("section string, entry string").json(path)
    value = F.coalesce(*[F.get_json_object("entry", f"$.{name}") for name in ("total_questions", "n", "variance")])
    return rounded(
        rows.groupBy("section").agg(F.count(F.lit(1)).alias("entries"), F.sum(value.cast("double")).alias("total"))
    )


@query
def output_stats_approximate(spark, sf_dir):
    """The median from a bounded buffer: of an even number of totals the lower middle one."""
    stats = analysis.output_stats(strict_output_scores(spark, sf_dir), approximate=True)
    return stats.select("output_name", "samples", "median_total")


@query
def spread_stats_ranked(spark, sf_dir):
    spread = analysis.score_spread(ok_scores(spark, sf_dir))
    return rounded(analysis.spread_stats(spread, ranked=True))


@query
def output_stats_ranked(spark, sf_dir):
    return rounded(analysis.output_stats(strict_output_scores(spark, sf_dir), ranked=True))


@query
def top_spread_ranked(spark, sf_dir):
    top = analysis.top_spread(analysis.score_spread(ok_scores(spark, sf_dir)), ranked=True)
    return rounded(top.select("original_idx", "num_answers", "variance", "mean_score"))


@query
def length_quantiles(spark, sf_dir):
    """Exact quartiles of the documents' lengths, per language."""
    docs = fixtures.table(spark, sf_dir, "documents").select("lang", F.length("text").alias("chars"))
    found = quantiles.exact_quantiles(docs, "chars", [0.25, 0.5, 0.75, 0.99], ["lang"])
    names = ("p25", "p50", "p75", "p99")
    return rounded(found.select("lang", "n", *[F.col("quantiles")[i].alias(name) for i, name in enumerate(names)]))


@query
def grade_bands(spark, sf_dir):
    return rounded(analysis.grade_bands(ok_scores(spark, sf_dir)))


@query
def rank_outputs(spark, sf_dir):
    stats = analysis.output_stats(strict_output_scores(spark, sf_dir))
    return rounded(analysis.rank_outputs(stats))


@query
def best_per_dimension(spark, sf_dir):
    stats = analysis.output_stats(strict_output_scores(spark, sf_dir))
    return rounded(analysis.best_per_dimension(stats))


@query
def scores_csv(spark, sf_dir):
    path = new_path(spark, "scores-csv")
    sinks.scores_to_csv(aggregated(spark, sf_dir), path)
    schema = "sample_idx bigint, output_name string, correctness double, logic double, clarity double, completeness double, total_score double, brief_comment string"
    return spark.read.schema(schema).option("header", True).option("escape", '"').csv(path)


@query
def stats_json(spark, sf_dir):
    path = new_path(spark, "stats-json")
    stats = rounded(analysis.best_worst_summary(ok_scores(spark, sf_dir)))
    sinks.write_stats(stats, path)
    return spark.read.schema(stats.schema).json(path)


@query
def score_counts(spark, sf_dir):
    return analysis.score_counts(ok_scores(spark, sf_dir))


@query
def score_lists(spark, sf_dir):
    """All totals of each question, one row per place in its descending list."""
    runs_of = analysis.score_runs(ok_scores(spark, sf_dir))
    listed = analysis.list_scores(F.col("all_scores"))
    return runs_of.select("original_idx", F.posexplode(listed).alias("place", "total_score"))


@query
def quarantine(spark, sf_dir):
    """Scored and failed rows written and read back: which file holds which row."""
    path = new_path(spark, "split")
    sinks.write_split(robust(spark, sf_dir), path)
    schema = "original_idx bigint, output_idx int, model_answer string, error string"
    both = [sinks.read_split(spark, path, schema, name).withColumn("file", F.lit(name)) for name in sinks.OUTCOMES]
    return both[0].unionByName(both[1]).select(
        "file", "original_idx", "output_idx", digest("model_answer"), "error"
    )


# -- conversations ----------------------------------------------------------------


@query
def last_question(spark, sf_dir):
    return fixtures.conv_messy(spark, sf_dir).select(
        "id", F.md5(C.last_question(F.col("conversations"))).alias("question_md5")
    )


@query
def last_answer(spark, sf_dir):
    return fixtures.conv_messy(spark, sf_dir).select(
        "id", F.md5(C.last_answer(F.col("conversations"))).alias("answer_md5")
    )


@query
def keep_prompt_roles(spark, sf_dir):
    kept = C.keep_prompt_roles(F.col("conversations")).alias("conversations")
    return fixtures.conv_messy(spark, sf_dir).select("id", kept).select("id", *conversation())


@query
def normalize_stage1(spark, sf_dir):
    rows = records.normalize_stage1(fixtures.conv_messy(spark, sf_dir))
    return rows.select("id", *conversation())


@query
def normalize_stage2(spark, sf_dir):
    rows = records.normalize_stage2(fixtures.conv_messy(spark, sf_dir))
    return rows.select("id", digest("question"), digest("thinking_answer_text"), *conversation())


@query
def replace_last_assistant(spark, sf_dir):
    replaced = C.replace_last_assistant(F.col("conversations"), F.lit("new answer"))
    rows = fixtures.conv_messy(spark, sf_dir).select("id", replaced.alias("conversations"))
    return rows.select("id", *conversation())


@query
def delivery_conversations(spark, sf_dir):
    built = C.delivery_conversations(F.col("conversations"), F.lit("new answer"))
    rows = fixtures.conv_messy(spark, sf_dir).select("id", built.alias("conversations"))
    return rows.select("id", *conversation())


@query
def judge_context(spark, sf_dir):
    rows = records.judge_context(fixtures.conv_messy(spark, sf_dir))
    return rows.select("id", digest("question"), digest("reference_answer"))


@query
def with_row_id(spark, sf_dir):
    """Rows without id (those of system messages) are named after their line."""
    rows = fixtures.table(spark, sf_dir, "conversations").select(
        F.when(F.col("role") != "system", F.expr(shapes.CONV_ID)).alias("id"),
        (F.col("conv_id") * 100 + F.col("turn")).alias("line"),
    )
    return records.with_row_id(rows)


@query
def prepare_stage1(spark, sf_dir):
    rows = records.prepare_stage1(fixtures.conv_messy(spark, sf_dir), TEMPLATE)
    return rows.select("id", digest("prompt"))


@query
def prepare_stage2(spark, sf_dir):
    rows = records.prepare_stage2(fixtures.stage2_source(spark, sf_dir), TEMPLATE)
    return rows.select("id", digest("prompt"))


@query
def prepare_judge(spark, sf_dir):
    """Two more candidates are asked for than there are: missing ones are skipped."""
    rows = records.prepare_judge(
        fixtures.judge_wide(spark, sf_dir), shapes.CANDIDATES + 2, PREFIX, TEMPLATE
    )
    return rows.select(
        "original_idx", "output_idx", digest("question"), digest("reference_answer"), digest("model_answer"), digest("prompt")
    )


@query
def prepare_report(spark, sf_dir):
    prepared = records.prepare_judge(fixtures.judge_wide(spark, sf_dir), shapes.CANDIDATES, PREFIX)
    return rounded(records.prepare_report(prepared))


@query
def stage_counters(spark, sf_dir):
    """Rows read and rows the two normalising steps would keep."""
    rows = records.compute_once(
        fixtures.conv_messy(spark, sf_dir),
        asked=C.last_question(F.col("conversations")) != "",
        answered=C.last_answer(F.col("conversations")) != "",
    )
    asked, answered = F.col("asked"), F.col("answered")
    return records.counters(rows, stage1=asked, stage2=asked & answered)


@query
def written_prepare_report(spark, sf_dir):
    _, report = records.prepare_judge_counted(fixtures.judge_wide(spark, sf_dir), shapes.CANDIDATES, PREFIX)
    return rounded(report)


@query
def written_stage_counters(spark, sf_dir):
    """Rows read and kept by each normalising step, counted by the job that writes them."""
    rows = fixtures.conv_messy(spark, sf_dir)
    reports = [records.normalize_counted(rows, stage)[1].withColumn("stage", F.lit(stage)) for stage in (1, 2)]
    return reports[0].unionByName(reports[1])


# -- text -------------------------------------------------------------------------


def marked_up(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fixtures.stage2_responses(spark, sf_dir)


@query
def strip_think(spark, sf_dir):
    return marked_up(spark, sf_dir).select(
        "id", F.md5(text.strip_think_tokens(F.col("response"))).alias("response_md5")
    )


@query
def clean_think_blocks(spark, sf_dir):
    cleaned = text.clean_think_blocks(F.col("response"))
    return fixtures.responses(spark, sf_dir).select("original_idx", "output_idx", F.md5(cleaned).alias("response_md5"))


@query
def compact_len(spark, sf_dir):
    return fixtures.table(spark, sf_dir, "documents").select(
        "doc_id", text.compact_len(F.col("text")).cast("bigint").alias("compact_len")
    )


@query
def length_gate(spark, sf_dir):
    source = fixtures.stage2_source(spark, sf_dir).select("id", "question", "thinking_answer_text")
    gated = prompts.length_gate(F.col("question"), F.col("thinking_answer_text"))
    return source.select("id", F.md5(gated).alias("response_md5"))


@query
def split_by_think(spark, sf_dir):
    tagged, plain = records.split_by_think(marked_up(spark, sf_dir))
    both = tagged.withColumn("think", F.lit(True)).unionByName(plain.withColumn("think", F.lit(False)))
    return both.select("id", "think", *conversation())


# -- joins ------------------------------------------------------------------------


@query
def merge_stage1(spark, sf_dir):
    """Every conversation is asked twice; sources come twice too, the later one counts."""
    conv = fixtures.conv_messy(spark, sf_dir)
    source = conv.withColumn("line", F.lit(1)).unionByName(
        conv.withColumn("line", F.lit(0)).withColumn("conversations", F.slice("conversations", 1, 1))
    )
    asked = fixtures.table(spark, sf_dir, "conversations").select(
        F.expr(shapes.CONV_ID).alias("id"), "turn", F.expr(shapes.MESSY_VALUE).alias("response")
    )
    unknown = F.when(F.col("turn") == 0, F.concat(F.lit("x"), "id")).otherwise(F.col("id"))
    merged = matching.merge_stage1(
        source.select("id", "line", "conversations"), asked.select(unknown.alias("id"), "response"), ["line"]
    )
    return merged.select("id", *conversation())


@query
def merge_stage2(spark, sf_dir):
    merged = matching.merge_stage2(
        fixtures.stage2_source(spark, sf_dir), fixtures.stage2_responses(spark, sf_dir)
    )
    return merged.select("id", "replaced_short", *conversation())


@query
def merge_stage_report(spark, sf_dir):
    output = fixtures.stage2_responses(spark, sf_dir)
    merged = matching.merge_stage2(fixtures.stage2_source(spark, sf_dir), output)
    return matching.merge_stage_report(output, merged, think=True)


@query
def written_merge_report(spark, sf_dir):
    """The same counters from the job that writes the merged rows."""
    source, output = fixtures.stage2_source(spark, sf_dir), fixtures.stage2_responses(spark, sf_dir)
    merged, report = matching.merge_stage2_counted(source, output)
    return report.withColumn("rows", merged.agg(F.count(F.lit(1))).scalar())


@query
def join_responses(spark, sf_dir):
    prepared = records.prepare_judge(fixtures.judge_wide(spark, sf_dir), shapes.CANDIDATES, PREFIX)
    joined = matching.join_responses(prepared, fixtures.responses(spark, sf_dir))
    return joined.select("original_idx", "output_idx", digest("response"), digest("model_answer"))


def to_enrich(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores whose key is unknown for one form of response and null for another."""
    form = F.size(F.split("model_answer", " ")) % 5
    key = F.when(form == 0, -F.col("original_idx") - 1).when(form != 1, F.col("original_idx"))
    rows = fixtures.candidates(spark, sf_dir)
    return rows.withColumn("doc", F.col("original_idx") * shapes.CANDIDATES + F.col("output_idx")).withColumn("original_idx", key)


@query
def enrich_with_conversations(spark, sf_dir):
    rows = matching.enrich_with_conversations(
        to_enrich(spark, sf_dir), fixtures.conv_nested(spark, sf_dir)
    )
    return rows.select(
        "doc", "original_idx", F.when(F.col("conversations").isNotNull(), F.size("conversations").cast("bigint")).alias("messages"), conversation()[1]
    )


@query
def enrich_report(spark, sf_dir):
    rows = matching.enrich_with_conversations(
        to_enrich(spark, sf_dir), fixtures.conv_nested(spark, sf_dir)
    )
    return rounded(matching.enrich_report(rows))


def earlier_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What an earlier run left: an entry per assistant turn, failed where it is the first."""
    turns = fixtures.table(spark, sf_dir, "conversations").where(F.col("role") == "assistant")
    status = F.when(F.col("turn") == 1, "failed").otherwise("success")
    return turns.select(
        F.expr(shapes.CONV_ID).alias("id"), F.col("text").alias("response"), status.alias("_status")
    )


@query
def pending(spark, sf_dir):
    todo = fixtures.conv_nested(spark, sf_dir).select("id", "conv_id")
    return matching.pending(todo, earlier_run(spark, sf_dir))


@query
def pending_any_status(spark, sf_dir):
    todo = fixtures.conv_nested(spark, sf_dir).select("id", "conv_id")
    return matching.pending(todo, earlier_run(spark, sf_dir), retry_failed=False)


@query
def merge_shards(spark, sf_dir):
    rows = matching.merge_shards(fixtures.shard_rows(spark, sf_dir), ["file", "conv_id", "turn"])
    return rows.select("id", "file", "conv_id", "turn", digest("text"))


@query
def ledger_resume(spark, sf_dir):
    """Two runs over the same rows: the second asks what the ledger of the first does not hold."""
    todo = asked(spark, sf_dir)
    ledger = ledgers.KeyLedger(spark, new_path(spark, "ledger"), buckets=8)
    runs = []
    for run, backend in (("first", models.MoodyBackend()), ("second", models.DigestBackend())):
        answered = materialize(inference.batch_infer(ledger.pending(todo, run), backend), "responses")
        ledger.append(answered, run)
        runs.append(answered.select("id", F.lit(run).alias("run"), "response"))
    return runs[0].unionByName(runs[1])


@query
def ledger_merge(spark, sf_dir):
    """Shards that arrive in two runs: over both the first row of an id stays."""
    rows = fixtures.shard_rows(spark, sf_dir)
    ledger = ledgers.KeyLedger(spark, new_path(spark, "ledger"), buckets=8)
    merged = [
        ledger.merge(part, run, new_path(spark, "merged"), ["file", "conv_id", "turn"]).withColumn("run", F.lit(run))
        for run, part in (("first", rows.where(F.col("turn") > 1)), ("second", rows))
    ]
    return merged[0].unionByName(merged[1]).select("id", "run", "file", "conv_id", "turn", digest("text"))


@query
def merge_report(spark, sf_dir):
    return matching.merge_report(fixtures.shard_rows(spark, sf_dir))


# -- shards and files -------------------------------------------------------------


@query
def md5_shard_counts(spark, sf_dir):
    shard = sharding.md5_shard(F.col("id"), 80).alias("shard")
    rows = fixtures.table(spark, sf_dir, "conversations").select(F.expr(shapes.CONV_ID).alias("id"))
    return sinks.shard_counts(rows.select(shard))


@query
def mod_shard_counts(spark, sf_dir):
    shard = sharding.mod_shard(F.col("original_idx"), 16).alias("shard")
    return sinks.shard_counts(to_enrich(spark, sf_dir).select(shard))


@query
def write_shards(spark, sf_dir):
    rows = fixtures.conv_nested(spark, sf_dir).select("id", "conversations")
    path = new_path(spark, "shards")
    return sinks.write_shards(rows, path, sharding.md5_shard(F.col("id"), 16), 16).select("shard", "rows")


@query
def shards_read_back(spark, sf_dir):
    """Rows of each shard by its manifest and as its checked files give them back."""
    rows = fixtures.conv_nested(spark, sf_dir).select("id", "conversations")
    path = new_path(spark, "shards")
    shard = sharding.md5_shard(F.col("id"), 16)
    manifest = sinks.write_shards(rows, path, shard, 16)
    read, _ = sinks.read_shards(spark, path, CONV_SCHEMA)
    found = read.groupBy(shard.alias("shard")).agg(
        F.count(F.lit(1)).alias("rows_read"), F.sum(F.size("conversations")).alias("messages")
    )
    return manifest.join(found, "shard", "full").select("shard", "rows", "rows_read", "messages", (F.col("files") > 0).alias("has_files"))


CONV_SCHEMA = "id string, conversations array<struct<`from`:string,value:string>>"


@query
def jsonl_roundtrip(spark, sf_dir):
    """Write records with more fields than are declared, read them, write and read again."""
    rows = fixtures.conv_nested(spark, sf_dir)
    first, second = new_path(spark, "jsonl"), new_path(spark, "jsonl")
    sinks.write_jsonl(rows, first)
    read, _ = jsonl.read_jsonl(spark, first, CONV_SCHEMA, numbered=True)
    sinks.write_jsonl(read, second)
    again, _ = jsonl.read_jsonl(spark, second, CONV_SCHEMA)
    extra = F.try_variant_get(F.col("extra")["original_idx"], "$", "bigint")
    return again.select("id", extra.alias("original_idx"), *conversation())


@query
def jsonl_bad_lines(spark, sf_dir):
    """The whole text of every document as lines: most are no JSON, none is lost."""
    path = new_path(spark, "lines")
    bare = F.regexp_replace("text", r"[\r\n]", " ")
    fixtures.table(spark, sf_dir, "documents").select(
        F.when(F.col("doc_id") % 3 == 0, F.to_json(F.struct("doc_id", "text"))).otherwise(bare)
    ).write.text(path)
    rows, bad = jsonl.read_jsonl_dir(spark, path, "*.txt", "doc_id bigint, text string", numbered=True)
    good = rows.select("doc_id", digest("text"), F.lit("").alias("error"))
    failed = jsonl.as_bad_lines(bad.withColumnRenamed("value", "text"))
    return good.unionByName(
        failed.select(F.lit(None).cast("bigint").alias("doc_id"), F.lit(None).cast("string").alias("text_md5"), "error")
    )


@query
def split_report(spark, sf_dir):
    path = new_path(spark, "lines")
    cut = F.when(F.col("role") == "system", F.lit("{")).otherwise(F.to_json(F.struct("conv_id", "text")))
    fixtures.table(spark, sf_dir, "conversations").select(cut).write.text(path)
    return sinks.split_report(*jsonl.read_jsonl(spark, path, "conv_id bigint"))


@query
def ordered_output(spark, sf_dir):
    """Documents written longest first: the place of each in the files read back."""
    path = new_path(spark, "ordered")
    docs = fixtures.table(spark, sf_dir, "documents").select("doc_id", "n_chars", (-F.col("n_chars")).alias("rank_by"))
    sinks.write_jsonl(docs, path, order_by=["rank_by", "doc_id"])
    rows, _ = jsonl.read_jsonl(spark, path, "doc_id bigint", numbered=True)
    # Lines before a file: a window over one row per file.
    before = Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)
    sizes = rows.groupBy("file").agg(F.count(F.lit(1)).alias("n"))
    starts = sizes.select("file", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    return rows.join(starts, "file").select("doc_id", (F.col("start") + F.col("line")).alias("place"))


@query
def line_numbers(spark, sf_dir):
    """Lines per file and the highest number: numbers are complete when they agree."""
    path = new_path(spark, "numbered")
    sinks.write_jsonl(fixtures.table(spark, sf_dir, "conversations"), path)
    numbered = jsonl.number_lines(jsonl.scan_lines(spark, path))
    files = numbered.groupBy("file").agg(
        F.count(F.lit(1)).alias("n"), F.max("line").alias("last"), F.count_distinct("line").alias("different")
    )
    complete = F.bool_and((F.col("last") + 1 == F.col("n")) & (F.col("different") == F.col("n")))
    return files.agg(F.sum("n").alias("lines"), complete.alias("complete"))


# -- requests and replies ---------------------------------------------------------


@query
def build_messages(spark, sf_dir):
    turn = F.struct(F.col("role"), F.col("text").alias("content"))
    rows = fixtures.table(spark, sf_dir, "conversations").select(
        "conv_id",
        "turn",
        F.col("text").alias("prompt"),
        F.when(F.col("role") == "assistant", F.array(turn)).when(F.col("role") == "user", F.array().cast(envelopes.MESSAGES)).alias("messages"),
    )
    built = records.with_messages(rows, "be brief")
    shown = F.transform("messages", lambda m: F.concat(m["role"], F.lit(":"), m["content"]))
    return built.select("conv_id", "turn", F.md5(F.array_join(shown, "\n")).alias("messages_md5"))


@query
def merge_sampling_params(spark, sf_dir):
    rows = fixtures.table(spark, sf_dir, "conversations").select(
        "conv_id",
        "turn",
        F.when(F.col("role") == "user", F.col("turn") / 10).alias("temperature"),
        F.when(F.col("role") != "user", F.length("text")).alias("max_tokens"),
    )
    merged = records.merge_sampling_params(rows, {"temperature": 0.7, "top_p": 0.95, "seed": 3})
    return rounded(merged.select("conv_id", "turn", "sampling_params.*"))


@query
def parse_envelope(spark, sf_dir):
    parsed = fixtures.replies(spark, sf_dir).withColumn("parsed", envelopes.read_reply(F.col("reply")))
    fields = parsed.withColumn("chat", envelopes.parse_envelope(F.col("parsed")))
    return fields.select("conv_id", "turn", digest("chat.response"), "chat.thinking")


@query
def token_stats(spark, sf_dir):
    parsed = envelopes.token_stats(envelopes.read_reply(F.col("reply"))).alias("usage")
    return fixtures.replies(spark, sf_dir).select("conv_id", "turn", parsed).select("conv_id", "turn", "usage.*")


@query
def usage_totals(spark, sf_dir):
    parsed = envelopes.token_stats(envelopes.read_reply(F.col("reply"))).alias("usage")
    return inference.usage_totals(fixtures.replies(spark, sf_dir).select(parsed))


@query
def written_usage(spark, sf_dir):
    """Token counts gathered by the job that writes the replies."""
    parsed = envelopes.token_stats(envelopes.read_reply(F.col("reply"))).alias("usage")
    rows = fixtures.replies(spark, sf_dir).select("conv_id", "turn", parsed)
    return materialize_counted(rows, "replies", **inference.usage_sums())[1]


# -- inference --------------------------------------------------------------------


def asked(spark: SparkSession, sf_dir: str) -> DataFrame:
    return records.prepare_stage1(fixtures.conv_nested(spark, sf_dir))


@query
def batch_infer(spark, sf_dir):
    rows = inference.batch_infer(asked(spark, sf_dir), models.MoodyBackend())
    return rows.select("id", digest("prompt"), "response")


@query
def batch_infer_keep(spark, sf_dir):
    rows = inference.batch_infer(asked(spark, sf_dir), models.MoodyBackend(), on_error="keep")
    return rows.select("id", "response", "thinking", "usage.*", "_status", "_error")


@query
def batch_infer_many(spark, sf_dir):
    """Batches of equal parameters; of a batch that fails only the refused prompts fail."""
    rows = asked(spark, sf_dir).withColumn("temperature", F.length("prompt") % 3 / 10)
    found = inference.batch_infer(rows, models.BatchBackend(), on_error="keep", batch_size=16)
    return found.select("id", "response", "_status", "_error")


def at_once(seconds: float) -> None:
    """In place of a delay between retries."""


@query
def retry_calls(spark, sf_dir):
    """Calls that fail once or twice are made again."""
    policy = inference.RetryPolicy(max_retries=2, sleep=at_once)
    rows = inference.batch_infer(asked(spark, sf_dir), models.FlakyBackend(), policy=policy)
    return rows.select("id", "response")


@query
def reduced_params(spark, sf_dir):
    """A call with parameters that the model rejects is made once more without them."""
    sent = {"temperature": 0.5, "stop": "."}
    rows = inference.batch_infer(asked(spark, sf_dir), models.PickyBackend(), sent)
    return rows.select("id", "response")


@query
def multi_turn_infer(spark, sf_dir):
    rows = inference.multi_turn_infer(
        asked(spark, sf_dir), models.DigestBackend(), models.ask_again, max_turns=10
    )
    return rows.select("id", F.array_join("responses", "|").alias("responses"), F.col("usage.completion").alias("completion"))


@query
def multi_turn_rounds(spark, sf_dir):
    """The same conversations in rounds, one written frame per turn."""
    rows = rounds.multi_turn_rounds(
        asked(spark, sf_dir), models.DigestBackend(), models.ask_again, max_turns=10
    )
    return rows.select("id", F.array_join("responses", "|").alias("responses"), F.col("usage.completion").alias("completion"))


@query
def resume_infer(spark, sf_dir):
    todo = matching.pending(asked(spark, sf_dir), earlier_run(spark, sf_dir))
    return inference.batch_infer(todo, models.DigestBackend()).select("id", "response")


@query
def stream_answers(spark, sf_dir):
    """The same as a stream over JSONL files that may be started again for new files."""
    source, sink, checkpoint = (new_path(spark, f"stream-{part}") for part in ("in", "out", "state"))
    sinks.write_jsonl(fixtures.conv_nested(spark, sf_dir).select("id", "conversations"), source)
    running = stream_infer(
        spark, source, sink, checkpoint, CONV_SCHEMA, models.DigestBackend(), prepare=records.prepare_stage1
    )
    running.awaitTermination()
    return spark.read.schema("id string, response string").json(sink)


# -- whole runs -------------------------------------------------------------------


def judge_run(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    return run_judge(
        fixtures.judge_wide(spark, sf_dir), models.DigestJudge(), n_examples=shapes.CANDIDATES, prefix=PREFIX, template=TEMPLATE
    )


@query
def judge_scores(spark, sf_dir):
    scores, _ = judge_run(spark, sf_dir)
    return analysis.explode_scores(scores)


@query
def judge_failed(spark, sf_dir):
    _, failed = judge_run(spark, sf_dir)
    return failed.select("original_idx", "output_idx", "error", "raw_response", digest("prompt"))


@query
def judge_resumed(spark, sf_dir):
    """A run that finds the responses to all longer answers written by an earlier one."""
    wide = fixtures.judge_wide(spark, sf_dir)
    prepared = materialize(records.prepare_judge(wide, shapes.CANDIDATES, PREFIX, TEMPLATE), "prepared")
    earlier = prepared.where(F.length("model_answer") > 500)
    done = materialize(inference.batch_infer(earlier, models.DigestJudge()), "responses")
    scores, _ = run_judge(wide, models.DigestJudge(), prefix=PREFIX, prepared=prepared, done=done)
    return analysis.explode_scores(scores)


def outcomes(scores: DataFrame, failed: DataFrame) -> DataFrame:
    """One row per judged candidate: which output of a run it is in, and why it failed."""
    name = F.substring_index("output_name", "_", -1).cast("int").alias("output_idx")
    none = F.lit(None).cast("string").alias("error")
    good = analysis.explode_scores(scores).select("original_idx", name, none)
    return good.unionByName(failed.select("original_idx", "output_idx", "error"))


@query
def judge_retried(spark, sf_dir):
    """A run after one in which calls failed: every candidate is in one output, once."""
    wide = fixtures.judge_wide(spark, sf_dir)
    prepared = materialize(records.prepare_judge(wide, shapes.CANDIDATES, PREFIX, TEMPLATE), "prepared")
    done = materialize(inference.batch_infer(prepared, models.RefusingJudge(), on_error="keep"), "responses")
    return outcomes(*run_judge(wide, models.DigestJudge(), prefix=PREFIX, prepared=prepared, done=done))


@query
def judge_refused(spark, sf_dir):
    """A run whose model refuses some calls: these are failed rows with the call's error."""
    wide = fixtures.judge_wide(spark, sf_dir)
    return outcomes(
        *run_judge(wide, models.RefusingJudge(), n_examples=shapes.CANDIDATES, prefix=PREFIX, template=TEMPLATE)
    )


@query
def judge_repeated_idx(spark, sf_dir):
    """Every question comes twice, first with other answers; scores and question are of the last."""
    wide = fixtures.judge_wide(spark, sf_dir)
    names = [f"{PREFIX}{i}" for i in range(shapes.CANDIDATES)]
    other = wide.withColumns({a: F.concat(F.lit("other "), F.col(b)) for a, b in zip(names, reversed(names))})
    asked = C.message(F.lit("human"), F.lit("another question"))
    other = other.withColumn("conversations", F.concat("conversations", F.array(asked)))
    both = other.withColumn("line", F.lit(0)).unionByName(wide.withColumn("line", F.lit(1)))
    scores, _ = run_judge(both, models.DigestJudge(), n_examples=shapes.CANDIDATES, prefix=PREFIX, template=TEMPLATE)
    rows = scores.select("original_idx", digest("question"), F.explode("scores").alias("output_name", "score"))
    return rows.select("original_idx", "question_md5", "output_name", "score.total_score", "score.brief_comment")


@query
def preference_scored(spark, sf_dir):
    scored = run_preference(fixtures.judged(spark, sf_dir)).scored
    return scored.select("original_idx", "output_idx", digest("model_answer"), "scores.total_score")


@query
def preference_failed(spark, sf_dir):
    failed = run_preference(fixtures.judged(spark, sf_dir)).failed
    return failed.select("original_idx", "output_idx", "error", digest("raw_response"))


@query
def preference_summary(spark, sf_dir):
    return rounded(run_preference(fixtures.judged(spark, sf_dir)).summary)


@query
def preference_histogram(spark, sf_dir):
    return rounded(run_preference(fixtures.judged(spark, sf_dir)).histogram)


@query
def preference_report(spark, sf_dir):
    return rounded(run_preference(fixtures.judged(spark, sf_dir)).report)


@query
def preference_pairs(spark, sf_dir):
    return flat_best_worst(run_preference(fixtures.judged(spark, sf_dir)).best_worst)


@query
def answer_stage1(spark, sf_dir):
    rows = run_stage1(fixtures.conv_messy(spark, sf_dir), models.DigestBackend())
    return rows.select("id", *conversation())


def repeated_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversations in the order of their lines, with empty and repeated ids."""
    rows = fixtures.conv_nested(spark, sf_dir)
    return rows.select(F.expr(shapes.REPEATED_ID).alias("id"), F.col("conv_id").alias("line"), "conversations")


@query
def stage1_repeated_ids(spark, sf_dir):
    rows = run_stage1(repeated_ids(spark, sf_dir), models.DigestBackend())
    return rows.select("id", *conversation())


@query
def stage2_empty_ids(spark, sf_dir):
    rows = run_stage2(repeated_ids(spark, sf_dir), models.DigestBackend())
    return rows.select("id", "replaced_short", *conversation())


@query
def stage1_merge_only(spark, sf_dir):
    """Only what an earlier run has written is merged."""
    done = materialize(inference.batch_infer(asked(spark, sf_dir), models.MoodyBackend()), "responses")
    rows = run_stage1(fixtures.conv_nested(spark, sf_dir), models.MoodyBackend(), done=done, merge_only=True)
    return rows.select("id", *conversation())


@query
def stage1_prepared(spark, sf_dir):
    """Prompts written by an earlier run are used as they are."""
    rows = fixtures.conv_messy(spark, sf_dir)
    source = records.with_row_id(records.normalize_stage1(rows))
    prepared = materialize(records.prepare_stage1(source), "prepared")
    return run_stage1(rows, models.DigestBackend(), prepared=prepared).select("id", *conversation())


def prepared_stage2(spark: SparkSession, rows: DataFrame) -> DataFrame:
    return materialize(records.prepare_stage2(records.normalize_stage2(rows), TEMPLATE), "prepared")


@query
def stage2_prepared(spark, sf_dir):
    rows = fixtures.conv_messy(spark, sf_dir)
    found = run_stage2(rows, models.DigestBackend(), prepared=prepared_stage2(spark, rows))
    return found.select("id", "replaced_short", *conversation())


@query
def stage2_merge_only(spark, sf_dir):
    rows = fixtures.conv_messy(spark, sf_dir)
    done = materialize(inference.batch_infer(prepared_stage2(spark, rows), models.DigestBackend()), "responses")
    found = run_stage2(rows, models.MoodyBackend(), done=done, merge_only=True)
    return found.select("id", "replaced_short", *conversation())


@query
def recorded_stage1(spark, sf_dir):
    """Three runs by one ledger: the second finds all that it needs, the third has another template."""
    rows = fixtures.conv_messy(spark, sf_dir)
    ledger = RunLedger(spark, new_path(spark, "runs"))
    found = []
    for run, backend, template in (
        ("first", models.DigestBackend(), None),
        ("same", models.DigestBackend("never asked "), None),
        ("template", models.DigestBackend("asked "), TEMPLATE),
    ):
        merged = record_stage1(ledger, rows, backend, "digest", template=template).df
        found.append(merged.select(F.lit(run).alias("run"), "id", *conversation()))
    return found[0].unionByName(found[1]).unionByName(found[2])


@query
def answer_stage2(spark, sf_dir):
    """Stage 2 on the answers the conversations came with."""
    rows = run_stage2(fixtures.conv_messy(spark, sf_dir), models.DigestBackend(), template=TEMPLATE)
    return rows.select("id", "replaced_short", *conversation())
