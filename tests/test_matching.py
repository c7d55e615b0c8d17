import random

from pyspark.sql import functions as F

from replyloom.functions import conversations as C
from replyloom.functions import prompts
from replyloom.operators import matching

CONV = C.CONVERSATION


def one(role, value):
    return [{"from": role, "value": value}]


def shard_rows(spark, n=20_000):
    """A third of the rows share one id, a tenth have none."""
    rng = random.Random(1)
    rows = []
    for i in range(n):
        pick = rng.random()
        key = "hot" if pick < 1 / 3 else (rng.choice(["", None]) if pick < 0.43 else f"k{rng.randrange(n)}")
        rows.append((key, f"part_{rng.randrange(9)}.jsonl", i, f"text {i}"))
    return rows, spark.createDataFrame(rows, "id string, file string, line bigint, text string")


def test_merge_shards_first_wins_whatever_the_skew(spark):
    rows, df = shard_rows(spark)
    seen, wanted = set(), []
    for row in sorted(rows, key=lambda r: (r[1], r[2])):
        if row[0] and row[0] in seen:
            continue
        seen.add(row[0])
        wanted.append(row)
    found = matching.merge_shards(df.repartition(13)).collect()
    assert sorted((r.file, r.line) for r in found) == sorted((r[1], r[2]) for r in wanted)
    report = matching.merge_report(df, df.limit(3)).first()
    assert (report.written, report.duplicate, report.bad_json) == (len(wanted), len(rows) - len(wanted), 3)
    assert matching.merge_shards(df, dedup=False).count() == len(rows)


def test_merge_shards_sends_no_group_to_one_task(spark):
    _, df = shard_rows(spark, 100)
    plan = matching.merge_shards(df)._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "partial_min" in plan


def test_merge_report_of_nothing(spark):
    empty = spark.createDataFrame([], "id string, file string, line bigint")
    assert tuple(matching.merge_report(empty).first()) == (0, 0, 0)


def test_merge_stage1(spark):
    source = spark.createDataFrame(
        [
            ("a", 0, one("gpt", "old"), "q", "first"),
            ("a", 1, one("human", "q"), "q", "last"),
            ("b", 2, None, "q", "b"),
            (None, 3, one("gpt", "null id"), "q", "n"),
        ],
        f"id string, line bigint, conversations {CONV}, question string, other string",
    )
    output = spark.createDataFrame(
        [("a", " new "), ("a", "again"), ("b", "x"), ("c", "lost"), (None, "no id"), ("b", " 　"), ("b", None)],
        "id string, response string",
    )
    merged = matching.merge_stage1(source, output, ["line"])
    assert "question" not in merged.columns
    found = sorted(
        (r.id or "", [m.value for m in r.conversations], r.other or "") for r in merged.collect()
    )
    assert found == [
        ("", ["no id"], ""), ("a", ["q", "again"], "last"), ("a", ["q", "new"], "last"),
        ("b", ["x"], "b"), ("c", ["lost"], ""),
    ]
    assert [m for r in merged.where("id = 'c'").collect() for m in r.conversations] == [("gpt", "lost")]


def test_length_gate(spark):
    source = "s" * 200
    cases = [  # response, source, kept as is
        ("r" * 180, source, True),
        ("r" * 179, source, False),
        ("r" * 179 + " " * 50, source, False),
        ("r" * 119, "s" * 10, False),
        ("r" * 120, "s" * 10, True),
        ("r", "", True),
        # int(0.9 * 134) is 120, not 121: the product is cut, not rounded
        ("r" * 120, "s" * 134, True),
    ]
    rows = spark.createDataFrame([(i, r, s) for i, (r, s, _) in enumerate(cases)], "i int, r string, s string")
    gated = rows.select("i", "r", prompts.length_gate(F.col("r"), F.col("s")).alias("g")).orderBy("i")
    assert [r.g == r.r for r in gated.collect()] == [c[2] for c in cases]
    off = rows.select("r", prompts.length_gate(F.col("r"), F.col("s"), fallback=False).alias("g"))
    assert all(r.g == r.r for r in off.collect())


def test_merge_stage2(spark):
    source = spark.createDataFrame(
        [("a", one("human", "q"), "<think>t</think>" + "s" * 200), ("b", one("user", "q"), None)],
        f"id string, conversations {CONV}, thinking_answer_text string",
    )
    output = spark.createDataFrame(
        [("a", "<think>x</think>short"), ("a", "r" * 190), ("b", "fine"), ("c", "lost"), ("a", "<think>x</think>")],
        "id string, response string",
    )
    merged = matching.merge_stage2(source, output)
    found = sorted((r.id, r.replaced_short, [tuple(m) for m in r.conversations]) for r in merged.collect())
    assert found == [
        ("a", False, [("human", "q"), ("gpt", "r" * 190)]),
        ("a", True, [("human", "q"), ("gpt", "s" * 200)]),
        ("b", False, [("human", "q"), ("gpt", "fine")]),
        ("c", False, [("gpt", "lost")]),
    ]
    report = matching.merge_stage_report(output, merged, think=True).first()
    assert (report.written, report.skipped_empty, report.short_replaced) == (4, 1, 1)
    assert not any(r.replaced_short for r in matching.merge_stage2(source, output, fallback=False).collect())


def test_join_responses_by_key(spark):
    prepared = spark.createDataFrame([(1, 0, "p"), (1, 1, "q"), (2, 0, "r")], "original_idx bigint, output_idx int, prompt string")
    responses = spark.createDataFrame([(2, 0, "R"), (1, 1, "Q"), (9, 9, "?")], "original_idx bigint, output_idx int, response string")
    found = matching.join_responses(prepared, responses).collect()
    assert sorted((r.prompt, r.response) for r in found) == [("q", "Q"), ("r", "R")]


def test_enrich_keeps_unmatched_and_spreads_null_keys(spark):
    n = 6000
    scores = spark.range(n).select(
        F.when(F.col("id") % 3 > 0, F.col("id") % 5).alias("original_idx"), F.col("id").alias("row")
    )
    original = spark.createDataFrame(
        [(0, one("human", "q0")), (1, one("human", "q1")), (2, []), (3, None), (None, one("human", "null"))],
        f"original_idx bigint, conversations {CONV}",
    )
    rich = matching.enrich_with_conversations(scores, original)
    found = rich.collect()
    assert sorted(r.row for r in found) == list(range(n))
    for r in found:
        wanted = f"q{r.original_idx}" if r.original_idx in (0, 1) else None
        assert (r.conversations[0].value if r.conversations else None) == wanted
    report = matching.enrich_report(rich).first()
    assert report.enriched + report.missing == sum(1 for r in found if r.original_idx is not None)
    assert matching.enrich_report(rich.limit(0)).first().rate is None
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        wide = matching.enrich_with_conversations(scores, original)
        nulls = wide.where("original_idx IS NULL").groupBy(F.spark_partition_id()).count().collect()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert len(nulls) == 8 and max(r["count"] for r in nulls) < n / 3 / 4


def test_pending(spark):
    todo = spark.createDataFrame([("a", 1), ("b", 2), ("c", 3), (None, 4)], "id string, n int")
    done = spark.createDataFrame([("a", "success"), ("a", "success"), ("b", "failed"), (None, "success")], "id string, _status string")
    assert sorted(r.n for r in matching.pending(todo, done).collect()) == [2, 3, 4]
    assert sorted(r.n for r in matching.pending(todo, done, retry_failed=False).collect()) == [3, 4]
    assert sorted(r.n for r in matching.pending(todo, done.drop("_status")).collect()) == [3, 4]


def test_rows_without_a_position_stay(spark):
    df = spark.createDataFrame([("a", None, 1), ("b", 2, 2), ("b", 1, 3), ("", None, 4), ("", None, 5)], "id string, line int, n int")
    kept = {r.n for r in matching.keep_one(df, "id", ["line"]).collect()}
    assert kept == {1, 3, 4, 5}


def test_one_source_per_id(spark):
    """As many rows as responses, whatever ids the sources share."""
    turns = "array<struct<`from`:string,value:string>>"
    rows = [(i, k, [("human", f"q{k}")]) for k, i in enumerate(["a", "a", "", "", "", None])]
    for order in (None, ["line"]):
        source = spark.createDataFrame(rows, f"id string, line int, conversations {turns}")
        output = spark.createDataFrame([("a", "x"), ("a", "y"), ("", "z"), ("", "u"), ("", "v")], "id string, response string")
        merged = matching.merge_stage1(source, output, order).collect()
        assert sorted(r.conversations[-1].value for r in merged) == ["u", "v", "x", "y", "z"]
        assert {r.conversations[0].value for r in merged if r.id == "a"} == {"q1"}
        hidden = matching.merge_stage1(source.drop("line"), output)
        assert hidden.count() == 5


def test_repeated_keys_do_not_fan_out(spark):
    turns = "array<struct<`from`:string,value:string>>"
    scores = spark.createDataFrame([(1, "s"), (2, "t")], "original_idx long, n string")
    original = spark.createDataFrame([(1, 0, [("human", "a")]), (1, 1, [("human", "b")])], f"original_idx long, line long, conversations {turns}")
    found = {r.original_idx: r.conversations for r in matching.enrich_with_conversations(scores, original).collect()}
    assert found[2] is None and found[1][0].value == "b" and len(found) == 2
