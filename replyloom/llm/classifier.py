"""Quality classifier: logistic regression on hashed word n-grams, learned by FTRL-proximal.

Features of a text: its words and word pairs, hashed to ``2**bits`` buckets, and the same of
the words' shapes (runs of capitals, small letters and digits become one sign each), so that
invented or rare words still say how a text is written. A text's values are square roots of
bucket counts, scaled to length one; the score is the logistic of their sparse dot product
with the weights.

Learning takes at most ``max_rows`` labelled rows (those with the smallest hashes of their
keys), dealt over ``shards`` by that hash. Each shard learns a model of its own in hash order
and the models are averaged, so that the result depends neither on partitions nor on reruns.
Only the weights, at most ``2**bits``, pass the driver.

Defined results: a null or empty text has only the bias feature; with no labelled row every
score is 0.5; repeated labels of one kind count once, a key with both labels learns both;
null labels and null keys are no labels; repeated documents of a key all learn. Keys choose
and order the rows to learn from and are no features; other columns are not read.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from replyloom.llm.common import map_rows

BITS = 18
MAX_ROWS = 20_000
SHARDS = 2
PASSES = 3
PAIR = np.uint64(0x9E3779B97F4A7C15)
#: Word hashes kept per task at once; the table starts anew beyond.
KEPT_WORDS = 200_000

ALPHA, BETA, L1, L2 = 3.0, 1.0, 1e-3, 1e-4

#: Capitals, small letters (all of other scripts, too) and digits become one sign each.
SIGNS = bytes(
    65 if 65 <= c <= 90 else 97 if 97 <= c <= 122 or c >= 128 else 48 if 48 <= c <= 57 else c
    for c in range(256)
)
RUNS = re.compile(rb"(.)\1+", re.S)


class WordHashes(dict):
    """Numbers of words, in the order of the hashes of the words and of their shapes."""

    def __init__(self):
        self.words, self.word_shapes = array("Q"), array("Q")
        self.shapes: dict[bytes, int] = {}

    def __missing__(self, word: bytes) -> int:
        signs = word.translate(SIGNS)
        shape = self.shapes.get(signs)
        if shape is None:
            shape = self.shapes[signs] = xxhash.xxh64_intdigest(RUNS.sub(rb"\1", signs), 2)
        self.words.append(xxhash.xxh64_intdigest(word, 1))
        self.word_shapes.append(shape)
        number = self[word] = len(self)
        return number

    def of(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        if len(self) >= KEPT_WORDS:
            self.clear()
            self.__init__()
        numbers = np.fromiter(map(self.__getitem__, words), np.int64, len(words))
        return np.frombuffer(self.words, "u8")[numbers], np.frombuffer(self.word_shapes, "u8")[numbers]


def features(text: bytes | None, known: WordHashes, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Buckets and values of a text; bucket 0 is the bias."""
    found = (text or b"").split()
    parts = [np.zeros(1, np.int64)]
    if found:
        shift = np.uint64(64 - bits)
        for column in known.of(found):
            pairs = (column[:-1] * PAIR) ^ column[1:]
            mixed = np.concatenate([column, pairs]) * PAIR
            parts.append((mixed >> shift).astype(np.int64))
    buckets, counts = np.unique(np.concatenate(parts), return_counts=True)
    return buckets, np.sqrt(counts / counts.sum())


class Ftrl:
    """Follow the regularised leader, per-coordinate learning rates (McMahan et al., 2013)."""

    def __init__(self, bits: int):
        self.z = np.zeros(1 << bits)
        self.n = np.zeros(1 << bits)

    def weights(self, at: np.ndarray | slice = slice(None)) -> np.ndarray:
        z = self.z[at]
        rate = (BETA + np.sqrt(self.n[at])) / ALPHA + L2
        return np.where(np.abs(z) <= L1, 0.0, -(z - np.sign(z) * L1) / rate)

    def learn(self, at: np.ndarray, values: np.ndarray, label: int) -> None:
        w = self.weights(at)
        gradient = (logistic(float(w @ values)) - label) * values
        seen = self.n[at]
        step = (np.sqrt(seen + gradient**2) - np.sqrt(seen)) / ALPHA
        self.z[at] += gradient - step * w
        self.n[at] = seen + gradient**2


def logistic(x: float) -> float:
    return float(1 / (1 + np.exp(-np.clip(x, -35, 35))))


def fit(
    docs: DataFrame,
    labels: DataFrame,
    text: str = "text",
    key: str = "doc_id",
    label: str = "quality",
    bits: int = BITS,
    max_rows: int = MAX_ROWS,
    shards: int = SHARDS,
    passes: int = PASSES,
) -> np.ndarray:
    """Weights learned from the rows of ``docs`` that ``labels`` marks with 0 or 1."""
    chosen = (
        labels.where(F.col(label).isin(0, 1) & F.col(key).isNotNull())
        .select(F.col(key).alias("key"), F.col(label).cast("int").alias("label"))
        .distinct()
        .withColumn("h", F.xxhash64(F.col("key").cast("string")))
        .orderBy("h", "key", "label")
        .limit(max_rows)
    )
    # At most max_rows keys and labels: small enough to send to every task.
    sample = (
        docs.select(F.col(key).alias("key"), F.col(text).cast("binary").alias("text"))
        .join(F.broadcast(chosen), "key")
        .withColumn("shard", F.pmod("h", F.lit(shards)))
        .withColumn("pass", F.explode(F.sequence(F.lit(1), F.lit(passes))))
        .repartitionById(shards, F.col("shard").cast("int"))
        .sortWithinPartitions("shard", "pass", "h", "key", "label", F.xxhash64("text"))
        .select("shard", "pass", "label", "text")
    )

    def learned(shard: Iterator[dict]) -> Iterator[tuple]:
        model, known, n = Ftrl(bits), WordHashes(), 0
        for row in shard:
            model.learn(*features(row["text"], known, bits), row["label"])
            n += row["pass"] == 1
        w = model.weights()
        yield -1, float(n)
        for bucket in np.flatnonzero(w):
            yield int(bucket), float(w[bucket]) * n

    def learn(rows: Iterator[dict]) -> Iterator[tuple]:
        for _, shard in groupby(rows, key=lambda row: row["shard"]):
            yield from learned(shard)

    parts = map_rows(sample, learn, "bucket int, weight double")
    total = dict(parts.groupBy("bucket").agg(F.sum("weight")).collect())
    weights = np.zeros(1 << bits)
    n = total.pop(-1, 0.0)
    for bucket, weight in total.items():
        weights[bucket] = weight / n
    return weights


def scores(spark: SparkSession, weights: np.ndarray, text: Column) -> Column:
    """The score of a text (0 to 1, higher: label 1 likelier)."""
    bits = len(weights).bit_length() - 1
    shared = spark.sparkContext.broadcast(weights)  # 2**bits doubles

    @F.pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        known, w = WordHashes(), shared.value
        for batch in batches:
            sparse = (features(value, known, bits) for value in batch)
            yield pd.Series([logistic(float(w[at] @ values)) for at, values in sparse], dtype=float)

    return score(text.cast("binary"))


def held_out(doc_id: str = "doc_id") -> Column:
    """Rows never learned from: remainder 1 of the CRC of the id's text."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 3 == 1, F.lit(False))
