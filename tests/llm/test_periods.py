import hashlib
import os
import random
import re
import zlib
from fractions import Fraction

import numpy as np
import pytest

import __spark_entry__ as registry
from replyloom.llm import periods

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


def brute(words, least=24, repeats=3):
    """Every period, word by word."""
    n, best = len(words), {}
    for q in range(1, n // repeats + 1):
        i = 0
        while i < n - q:
            j = i
            while j < n - q and words[j] == words[j + q]:
                j += 1
            if j > i and j - i + q >= max(least, repeats * q):
                best.setdefault((i, j + q), q)
            i = j + 1
    return sorted(((s, e - s, q) for (s, e), q in best.items()), key=lambda r: (r[0], r[2]))


def texts_with_runs(seed):
    r = random.Random(seed)
    for _ in range(40):
        n, v = r.randrange(500), r.choice([1, 2, 3, 6, 40, 2000])
        words = [r.randrange(v) for _ in range(n)]
        for _ in range(r.randrange(4)):
            if n > 30:
                a = r.randrange(n)
                q, end = 1 + r.randrange(max(1, (n - a) // 3)), r.randrange(a, n)
                for i in range(a + q, end):
                    words[i] = words[i - q]
        yield words


@pytest.mark.parametrize("seed", range(6))
def test_same_runs_as_brute_force(seed):
    texts = list(texts_with_runs(seed))
    found = periods.find_runs([np.array(t, dtype=np.int64) for t in texts])
    assert found == [brute(t) for t in texts]
    assert sum(map(len, found)) > 5


@pytest.mark.parametrize("least, repeats", [(6, 3), (40, 5)])
def test_other_limits(least, repeats):
    texts = list(texts_with_runs(77))
    found = periods.find_runs([np.array(t, dtype=np.int64) for t in texts], least, repeats)
    assert found == [brute(t, least, repeats) for t in texts]


def test_every_period_of_a_run_that_just_fits():
    """Three periods exactly, at every period up to 300, one word less, and one more on either side."""
    texts = []
    for q in range(8, 301):
        base = list(range(1, q + 1))
        run = base * 3
        texts += [run, run[:-1], [0, *run, 0, 0], [*run, run[0]]]
    found = periods.find_runs([np.array(t, dtype=np.int64) for t in texts])
    for i, q in enumerate(range(8, 301)):
        assert found[4 * i : 4 * i + 4] == [[(0, 3 * q, q)], [], [(1, 3 * q, q)], [(0, 3 * q + 1, q)]]


def test_strongest_is_exact_and_first():
    assert periods.strongest([]) is None
    assert periods.strongest([(0, 24, 8), (30, 33, 11), (70, 30, 10)]) == (0, 24, 8)
    assert periods.strongest([(0, 31, 10), (40, 28, 9)]) == (40, 28, 9)  # 3.1 and 3.11


def test_defined_results(spark, documents, odd_texts):
    refrain = " ".join(["la li lu"] * 30)
    found = periods.find_periods(documents([*odd_texts, f"so {refrain} end"])).orderBy("doc_id").collect()
    assert [r.n_words for r in found[:5]] == [0, 0, 0, 1, 1] and found[0].collapsed == "" == found[2].collapsed
    assert all(r.runs == [] for r in found[:-1]) and found[6].n_words == 30_000
    assert [tuple(r) for r in found[-1].runs] == [(1, 90, 3)] and found[-1].collapsed == "so la li lu end"
    assert found[-1].key == "key" and found[7].collapsed == found[8].collapsed == "same row"
    empty = periods.find_periods(documents([]))
    assert empty.count() == 0 and {"n_words", "runs", "collapsed"} <= set(empty.columns)
    clash = documents(["x"]).withColumnRenamed("row", "runs")
    assert clash.columns.count("runs") == 1 and periods.find_periods(clash).first().runs == []


@pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test data")
def test_query_against_brute_force(spark):
    found = {r.doc_id: r for r in registry.queries()["op12_periodic_runs"](spark, SF_DIR).collect()}
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").collect()
    assert len(found) == len(docs)
    total = 0
    for d in docs:
        words = re.findall(r"[^\x20\x09-\x0D]+", d.text or "")
        n, h = len(words), zlib.crc32(str(d.doc_id).encode())
        g = h // 10
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
        if n > 3000:
            continue  # brute force takes the square of the length
        runs = brute(words)
        total += len(runs)
        best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2])) if runs else (None,) * 3
        gone = {i for s, size, q in runs for i in range(s + q, s + size)}
        lines = "".join(f"{s},{size},{q}\n" for s, size, q in runs)
        kept = " ".join(w for i, w in enumerate(words) if i not in gone)
        assert tuple(found[d.doc_id])[1:] == (
            len(runs),
            *best,
            1000 * best[1] // best[2] if runs else None,
            hashlib.sha256(lines.encode()).hexdigest(),
            hashlib.sha256(kept.encode()).hexdigest(),
        )
    assert total > 5
