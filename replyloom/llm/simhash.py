"""Near-duplicates by SimHash, found by multi-index hashing.

A 64-bit fingerprint is cut into two halves. Of two fingerprints at distance two or less,
either the halves differ by one bit each, or one half is equal. For the first case the
Hamming ball of radius one around the upper half is enumerated (only the bits that are set are
cleared: the other end of the link has them cleared already, and meets each pair once); the
other cases look the equal half up. The table key also holds a part of the other half that the
few remaining differing bits cannot all reach, so that fingerprints that agree on a half by
the thousand do not meet in one bucket. Each pair met is verified over all 64 bits.

Links are between distinct fingerprints: copies, any number of them, are one node.

Defined results: a null, empty or blank text has fingerprint 0; repeated rows are members of one
component; null ids are carried and count as larger than any id (a component of null ids only
has a null id); an empty table gives no rows; further columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from replyloom.llm.common import map_rows, text_key
from replyloom.llm.components import components
from replyloom.session import materialize

SEED = 42


def fingerprint(text: bytes | None, shingle: int) -> int:
    """Majority bits of the XXH64 of all shingles, as a signed number."""
    found = (text or b"").lower().split()  # bytes: A-Z only
    if not found:
        return 0
    joined = b" ".join(found)
    ends = [e - 1 for e in accumulate(len(w) + 1 for w in found)]
    n = max(1, len(found) - shingle + 1)
    starts = [0, *(e + 1 for e in ends[: n - 1])]
    last = ends[min(shingle, len(found)) - 1 :]
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(joined[s:e], SEED) for s, e in zip(starts, last, strict=True)], "<u8")
    ones = np.zeros(64, np.int64)
    for i in range(0, n, 4096):
        bits = np.unpackbits(hashes[i : i + 4096].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<i8")[0])


def fingerprints(
    docs: DataFrame, text: str = "text", keys: tuple[str, ...] = ("doc_id",), shingle: int = 3
) -> DataFrame:
    """``keys`` and ``fp`` (signed 64 bits) of every row."""
    types = dict(docs.dtypes)

    def run(rows: Iterator[dict]) -> Iterator[tuple]:
        for row in rows:
            yield *(row[f"key{i}"] for i in range(len(keys))), fingerprint(row["text"], shingle)

    chosen = docs.select(
        *[F.col(k).alias(f"key{i}") for i, k in enumerate(keys)], F.col(text).cast("binary").alias("text")
    )
    return map_rows(chosen, run, ", ".join([*(f"`{k}` {types[k]}" for k in keys), "fp bigint"]))


def _part(value: Column, low: int, width: int) -> Column:
    return F.shiftrightunsigned(value, low).bitwiseAND(F.lit((1 << width) - 1))


def _keys(half: Column, other: Column, case: int, cuts: tuple[tuple[int, int], ...]) -> list[Column]:
    """Table keys: a half, the case, and each part of the other half."""
    return [
        F.struct(half.alias("half"), F.lit(case * 8 + i).alias("part"), _part(other, *cut).alias("rest"))
        for i, cut in enumerate(cuts)
    ]


THIRDS = ((0, 11), (11, 11), (22, 10))
HALVES = ((0, 16), (16, 16))


def links(nodes: DataFrame) -> DataFrame:
    """``(a, b)``: pairs of distinct ``fp`` of ``nodes`` that differ in one or two bits."""
    fp = F.col("fp")
    high, low = _part(fp, 32, 32), _part(fp, 0, 32)
    # One half equal, the other differs in two bits at most: a third of it is equal.
    equal = _keys(high, low, 0, THIRDS) + _keys(low, high, 1, THIRDS)
    # Both halves differ in one bit: half of the lower one is equal.
    table = _keys(high, low, 2, HALVES)
    one = F.lit(1).cast("long")
    probes = F.flatten(
        F.transform(
            F.filter(F.sequence(F.lit(0), F.lit(31)), lambda i: F.getbit(high, i) == 1),
            lambda i: F.array(*_keys(high - F.call_function("shiftleft", one, i), low, 2, HALVES)),
        )
    )
    left = nodes.select(fp.alias("a"), F.explode(F.concat(F.array(*equal), probes)).alias("key"))
    right = nodes.select(fp.alias("b"), F.explode(F.array(*equal, *table)).alias("key"))
    near = F.bit_count(F.col("a").bitwiseXOR(F.col("b"))).between(1, 2)
    # Of an equal half both ends are in the table: keep one direction.
    once = (F.col("key.part") >= 16) | (F.col("a") < F.col("b"))
    return left.join(right, "key").where(near & once).select("a", "b").distinct()


def near_duplicates(
    docs: DataFrame, text: str = "text", key: str = "doc_id", shingle: int = 3
) -> DataFrame:
    """``key``, ``fp`` and ``component_id`` (smallest key reachable over links of two bits or
    less) of every row."""
    marked, members = _members(docs, text, (key,), shingle)
    firsts = members.groupBy("root").agg(F.min("first").alias("first"))
    named = materialize(members.join(firsts.withColumnRenamed("first", "found"), "root"), "members")
    return marked.join(named.select("fp", F.col(f"found.{key}").alias("component_id")), "fp").select(
        key, "fp", "component_id"
    )


def one_of_each(docs: DataFrame, text: str = "text", key: str = "doc_id", shingle: int = 3) -> DataFrame:
    """One row of every component: of those with the smallest key, the first in order of the
    text's digest; of rows that agree in both, one."""
    digest = text_key(F.col(text))
    chosen = docs.select(F.col(key).alias("key"), digest.alias("digest"), F.col(text).alias("text"))
    _, members = _members(chosen, "text", ("key", "digest"), shingle)
    kept = members.groupBy("root").agg(F.min("first").alias("first")).select("first.key", "first.digest")
    return first_rows(docs, kept, text, key)


def first_rows(docs: DataFrame, kept: DataFrame, text: str, key: str) -> DataFrame:
    """One row of ``docs`` for each ``(key, digest)`` of ``kept``."""
    digest = text_key(F.col(text))
    rows = docs.select(F.struct("*").alias("row"), F.col(key).alias("row_key"), digest.alias("row_digest"))
    found = rows.join(kept, F.expr("row_key <=> key and row_digest = digest"))
    copy = F.row_number().over(Window.partitionBy("row_key", "row_digest").orderBy("row_key"))
    return found.withColumn("copy", copy).where("copy = 1").select("row.*")


def _members(docs: DataFrame, text: str, keys: tuple[str, ...], shingle: int) -> tuple[DataFrame, DataFrame]:
    """``(keys, fp)`` of every row, and ``(fp, first, root)`` of every fingerprint: its smallest
    keys, nulls last, and what names its component."""
    marked = materialize(fingerprints(docs, text, keys, shingle), "fingerprints")
    order = F.struct(F.col(keys[0]).isNull().alias("unknown"), *keys)
    nodes = materialize(marked.groupBy("fp").agg(F.min(order).alias("first")), "nodes")
    roots = components(links(nodes.select("fp")))
    named = nodes.join(roots.withColumnRenamed("id", "fp"), "fp", "left").select(
        "fp", "first", F.coalesce("root", "fp").alias("root")
    )
    return marked, named
