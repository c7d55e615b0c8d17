import random

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from replyloom.llm import simhash
from replyloom.llm.components import components


def brute(text, shingle=3):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    grams = [b" ".join(words[i : i + shingle]) for i in range(max(1, len(words) - shingle + 1))]
    hashes = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def groups(values, near):
    parent = list(range(len(values)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(values)):
        for j in range(i):
            if near(values[i], values[j]) and find(i) != find(j):
                parent[max(find(i), find(j))] = min(find(i), find(j))
    return [find(i) for i in range(len(values))]


def test_fingerprints_and_components(spark, documents, odd_texts, prose):
    base = prose(4, 400)
    texts = [*odd_texts, base, base.upper(), base + " tail", prose(5, 300), base, "A b", "a B"]
    want = [brute(t) for t in texts]
    roots = groups(want, lambda a, b: (a ^ b).bit_count() <= 2)
    for r in simhash.near_duplicates(documents(texts)).collect():
        assert (r.fp & (1 << 64) - 1, r.component_id) == (want[r.doc_id], roots[r.doc_id])


@pytest.mark.parametrize("seed", range(3))
def test_links_find_all_pairs_within_two_bits(spark, seed):
    r = random.Random(seed)
    bases = [r.getrandbits(64) for _ in range(6)]
    values = list({b ^ (1 << r.randrange(64)) ^ (1 << r.randrange(64)) * r.randrange(2) for b in bases for _ in range(40)} | set(bases))
    signed = [int(np.uint64(v).astype(np.int64)) for v in values]
    found = {frozenset((x.a, x.b)) for x in simhash.links(spark.createDataFrame([(s,) for s in signed], "fp long")).collect()}
    want = {
        frozenset((signed[i], signed[j]))
        for i in range(len(values)) for j in range(i) if (values[i] ^ values[j]).bit_count() <= 2
    }
    assert found == want


def test_one_of_each(spark, documents, prose):
    a, b = prose(6, 200), prose(7, 200)
    rows = documents([(5, a, "x"), (3, a, "y"), (3, a, "z"), (None, b, "x"), (8, None, "x"), (9, "", "x")])
    left = simhash.one_of_each(rows)
    assert left.columns == rows.columns
    assert sorted((r.doc_id is None, r.doc_id or 0) for r in left.collect()) == [(False, 3), (False, 8), (True, 0)]
    assert simhash.one_of_each(documents([])).count() == 0


def test_components_of_a_path_and_nothing(spark):
    path = spark.range(200).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b"))
    extra = spark.createDataFrame([(500, 501), (501, 501), (None, 3), (7, None)], "a long, b long")
    found = {r.id: r.root for r in components(path.union(extra)).collect()}
    assert found == {**{i: 0 for i in range(201)}, 500: 500, 501: 500}
    assert components(path.limit(0)).count() == 0
