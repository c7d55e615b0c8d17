import gzip
import json
import random

import pytest
from pyspark.sql import functions as F

from replyloom.functions import sharding
from replyloom.operators import matching
from replyloom.sources import jsonl, sinks

SCHEMA = "id string, n bigint, conversations array<struct<`from`:string,value:string>>"


@pytest.fixture
def files(tmp_path):
    """Files of different size with blank, broken and differently ended lines."""
    rng = random.Random(2)
    wanted = {}
    for f in range(5):
        lines = []
        for i in range(rng.randint(1, 4000)):
            pick = rng.random()
            if pick < 0.1:
                lines.append(rng.choice(["", "  ", "\t", " "]))
            elif pick < 0.2:
                lines.append(rng.choice(["{", '{"id": 1} x', "[1]", '"text"', "{'id': 1}"]))
            else:
                lines.append(json.dumps({"id": f"{f}/{i}", "n": i, "pad": "中" * rng.randint(0, 60)}, ensure_ascii=False))
        ends = [rng.choice(["\n", "\r\n", "\n"]) for _ in lines]
        (tmp_path / f"part_{f}.jsonl").write_text("".join(a + b for a, b in zip(lines, ends)), encoding="utf-8", newline="")
        wanted[f"part_{f}.jsonl"] = lines
    (tmp_path / "other.txt").write_text('{"id": "no"}\n')
    return str(tmp_path), wanted


def name(path):
    return path.rsplit("/", 1)[1]


@pytest.mark.parametrize("broadcast", [True, False])
def test_line_numbers_over_split_files(spark, files, broadcast):
    path, wanted = files
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    if not broadcast:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        lines = jsonl.scan_lines(spark, path, "part_*.jsonl")
        assert lines.select("block").distinct().count() > 5
        numbered = jsonl.number_lines(lines)
        found = {}
        for r in numbered.collect():
            found.setdefault(name(r.file), {})[r.line] = r.value
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert found == {f: dict(enumerate(lines)) for f, lines in wanted.items()}


def test_rows_bad_lines_and_extra_fields(spark, files):
    path, wanted = files
    rows, bad = jsonl.read_jsonl_dir(spark, path, "part_*.jsonl", SCHEMA, numbered=True)
    good = {(name(r.file), r.line): r for r in rows.select("*", F.to_json("extra").alias("rest")).collect()}
    failed = {(name(r.file), r.line - 1): r.error for r in jsonl.as_bad_lines(bad).collect()}
    for f, lines in wanted.items():
        for i, line in enumerate(lines):
            if not line.strip():
                assert (f, i) not in good and (f, i) not in failed
            elif line.startswith('{"id": "'):
                assert good[f, i].n == i and json.loads(good[f, i].rest) == {"pad": json.loads(line)["pad"]}
            else:
                assert failed[f, i] == "JSON parse error"
    report = sinks.split_report(rows, bad).first()
    assert (report.total, report.written, report.invalid_json) == (len(good) + len(failed), len(good), len(failed))


def test_carriage_returns_end_lines(spark, tmp_path):
    (tmp_path / "a.jsonl").write_text('{"id": "a"}\r{"id": "b"}\r\n\n{"id": "c"}', newline="")
    rows, _ = jsonl.read_jsonl(spark, str(tmp_path), "id string", numbered=True)
    assert sorted((r.id, r.line) for r in rows.collect()) == [("a", 0), ("b", 1), ("c", 3)]


def test_open_schema_round_trip(spark, tmp_path):
    rows = [
        {"id": "a", "n": 1, "deep": {"x": [1, 2.5, None], "y": "ü"}, "flag": True},
        {"id": 7, "conversations": [{"from": "human", "value": "q"}, {"from": "gpt", "value": 3}]},
        {"conversations": "no list", "only": 1},
    ]
    (tmp_path / "in.jsonl").write_text("\n".join(json.dumps(r) for r in rows))
    read, bad = jsonl.read_jsonl(spark, str(tmp_path / "in.jsonl"), SCHEMA, numbered=True)
    assert bad.count() == 0
    found = {r.line: r for r in read.collect()}
    assert found[1].id == "7" and [tuple(m) for m in found[1].conversations] == [("human", "q"), ("gpt", "3")]
    assert found[2].conversations is None
    sinks.write_jsonl(read, str(tmp_path / "out"), order_by=["line"])
    back = [json.loads(r.value) for r in spark.read.text(str(tmp_path / "out")).collect()]
    wanted = [rows[0], {"id": "7", "conversations": [{"from": "human", "value": "q"}, {"from": "gpt", "value": "3"}]}, rows[2]]
    assert sorted(back, key=str) == sorted(wanted, key=str)
    assert "ü" in "".join(r.value for r in spark.read.text(str(tmp_path / "out")).collect())


def test_write_shards_splits_a_hot_shard(spark, tmp_path):
    """Rows without a key all go to shard 0; the folder gets them from several tasks."""
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "200000")
    try:
        rows = spark.range(40_000).select(
            F.when(F.col("id") % 3 > 0, F.col("id")).alias("original_idx"), F.sha2(F.col("id").cast("string"), 256).alias("text")
        ).repartition(6)
        counts = sinks.write_shards(rows, str(tmp_path / "s"), sharding.mod_shard(F.col("original_idx"), 4), 4).collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    assert sum(r.rows for r in counts) == 40_000 and {r.shard for r in counts} == {0, 1, 2, 3}
    assert next(r.rows for r in counts if r.shard == 0) > 40_000 / 3
    assert len(list((tmp_path / "s" / "shard=0").glob("part-*"))) > 1


def test_shards_merge_back(spark, tmp_path):
    """Split by id, read the shards again, merge: every record once."""
    rows = spark.range(500).select(F.concat(F.lit("id"), F.col("id") % 400).alias("id"), F.col("id").alias("n"))
    for part in (0, 1):
        sinks.write_shards(rows, str(tmp_path / f"s{part}"), sharding.md5_shard(F.col("id"), 8), 8)
    lines = jsonl.scan_lines(spark, str(tmp_path / "s*" / "shard=*"))
    read, _ = jsonl.parse_lines(jsonl.number_lines(lines), "id string, n bigint")
    merged = matching.merge_shards(read)
    assert merged.count() == 400 == merged.select("id").distinct().count()


def test_write_stats_is_one_file(spark, tmp_path):
    sinks.write_stats(spark.createDataFrame([(1, 2.5)], "a int, b double"), str(tmp_path / "st"))
    (part,) = (tmp_path / "st").glob("part-*")
    assert json.loads(part.read_text()) == {"a": 1, "b": 2.5}


def test_one_compressed_file(spark, tmp_path):
    """An unsplittable file: numbered in order, parsed by all cores."""
    with gzip.open(tmp_path / "a.jsonl.gz", "wt") as f:
        f.writelines(f'{{"n": {i}}}\n' for i in range(5000))
    rows, bad = jsonl.read_jsonl(spark, str(tmp_path), "n bigint", numbered=True, partitions=8)
    assert rows.where("n = line").count() == 5000 and bad.count() == 0
    assert rows.select(F.spark_partition_id()).distinct().count() > 1
