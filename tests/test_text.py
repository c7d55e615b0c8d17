import hashlib
import random
import re
import sys

from pyspark.sql import functions as F

from replyloom.functions import fixed_values as fixed
from replyloom.functions import sharding, text


def test_whitespace_is_pythons():
    spaces = {chr(c) for c in range(sys.maxunicode + 1) if chr(c).isspace()}
    assert set(fixed.WHITESPACE) == spaces
    assert len(fixed.WHITESPACE) == len(spaces)


def test_whitespace_class_matches_python(column):
    found = column(
        lambda c: F.regexp_replace(c, fixed.WHITESPACE_CLASS, ""),
        [f"a{chr(c)}b" for c in range(0x10000) if not 0xD800 <= c <= 0xDFFF],
    )
    wanted = [
        re.sub(r"\s", "", f"a{chr(c)}b") for c in range(0x10000) if not 0xD800 <= c <= 0xDFFF
    ]
    assert found == wanted


def test_strip_and_role(column):
    values = [" \t  Human　\n", "x", "", " ", "a b", None, "\x1cUSER\x1f"]
    assert column(text.py_strip, values) == [None if v is None else v.strip() for v in values]
    assert column(text.norm_role, values)[0] == "human"
    assert column(text.norm_role, values)[-1] == "user"


def test_compact_len(column):
    values = ["", " a b c\n", "\U0001f600 \U0001f600", "中 文"]
    assert column(text.compact_len, values) == [0, 3, 2, 2]


def test_strip_think_tokens(column):
    cases = {
        "<think>a</think> b": "b",
        "a <think>b<think>c</think> d": "a  d",
        "<think>open": "open",
        "stray</think> end": "stray end",
        "<|begin_of_thought|>x\ny<|end_of_thought|>z": "z",
        "<|begin_of_thought|>x": "x",
        "<|/end_of_thought|>x": "x",
        "<think>a</think>b<think>c</think>": "b",
        "<think>all</think> ": "",
    }
    assert column(text.strip_think_tokens, list(cases)) == list(cases.values())


def test_clean_think_blocks_by_definition(column):
    """Removing every shortest run up to a newline pair, computed the slow way."""
    rng = random.Random(7)
    pieces = ["a", "\n", "\n\n", "b{", "<think>", "</think>", "<|begin_of_thought|>", "<|end_of_thought|>", " "]
    values = ["".join(rng.choice(pieces) for _ in range(rng.randint(0, 14))) for _ in range(3000)]
    wanted = []
    for value in values:
        for pattern in (*fixed.THINK_BLOCKS, r"(?s).*?\n\n"):
            value = re.sub(pattern, "", value)
        wanted.append(value)
    assert column(text.clean_think_blocks, values) == wanted


def test_clean_think_blocks_long_text(column):
    """Linear in the text: neither a missing nor a late blank line makes it slow."""
    long = "word " * 200_000
    assert column(text.clean_think_blocks, [long, long + "\n\nx", "\n\n" + long]) == [long, "x", long]


def test_after_last_think(column):
    cases = {"a</think>b</think> c": " c", "none": "none", "</think>": "", "": ""}
    assert column(text.after_last_think, list(cases)) == list(cases.values())


def test_md5_shard(column):
    ids = [f"line-{i}" for i in range(2000)] + ["", "中文", "\U0001f600"]
    wanted = [int(hashlib.md5(i.encode()).hexdigest()[:16], 16) % 80 for i in ids]
    assert column(lambda c: sharding.md5_shard(c, 80), ids) == wanted


def test_mod_shard(spark):
    rows = spark.createDataFrame([(5,), (-1,), (None,), (16,)], "k bigint")
    shards = [r.s for r in rows.select("k", sharding.mod_shard(F.col("k"), 16).alias("s")).collect()]
    assert shards == [5, 15, 0, 0]
