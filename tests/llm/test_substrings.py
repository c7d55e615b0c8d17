import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from replyloom.llm import substrings, suffixes


def brute(texts, length):
    data = [(t or "").encode() for t in texts]
    counts = Counter(b[i : i + length] for b in data for i in range(len(b) - length + 1))
    out = []
    for b in data:
        gone = np.zeros(len(b), bool)
        for i in range(len(b) - length + 1):
            if counts[b[i : i + length]] > 1:
                gone[i : i + length] = True
        spans = int((np.diff(gone.astype(int), prepend=0) == 1).sum())
        out.append((len(b), int(gone.sum()), spans, np.frombuffer(b, np.uint8)[~gone].tobytes()))
    return out


def mixture(seed, prose):
    r = random.Random(seed)
    shared = [prose(900 + i, 60) for i in range(4)]
    texts = []
    for i in range(40):
        parts = [prose(seed * 100 + i, r.randrange(5, 120))]
        for _ in range(r.randrange(3)):
            s = r.choice(shared)
            cut = r.randrange(len(s) // 2)
            parts.append(s[cut : cut + r.randrange(150, len(s))])
            parts.append(prose(seed * 1000 + i + r.randrange(50), r.randrange(1, 30)))
        texts.append(" ".join(parts))
    return [*texts, texts[3], texts[3], "ab" * 400, "x" * 1000, "Zeile äöü " * 60, None, ""]


@pytest.mark.parametrize("seed, hot", [(1, 2000), (2, 2000), (3, 1)])
def test_by_brute_force(spark, documents, prose, seed, hot):
    texts = mixture(seed, prose)
    want = brute(texts, 200)
    found = {r.doc_id: r for r in substrings.drop_repeats(documents(texts), hot=hot).collect()}
    for i, w in enumerate(want):
        r = found[i]
        assert (r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) == w


def test_pieces_of_long_texts(spark, documents, prose, monkeypatch):
    monkeypatch.setattr(substrings, "PIECE", 1000)
    a = prose(1, 2500)
    texts = [a, a[500:9000], prose(2, 500) + a[3000:5000]]
    want = brute(texts, 200)
    found = {r.doc_id: r for r in substrings.drop_repeats(documents(texts)).collect()}
    assert [(found[i].n_removed, found[i].n_spans) for i in range(3)] == [w[1:3] for w in want]


def test_odd_rows(spark, documents, odd_texts):
    rows = {r.doc_id: r for r in substrings.drop_repeats(documents(odd_texts)).collect()}
    assert len(rows) == len(odd_texts) and all(r.n_removed == 0 for r in rows.values())
    assert bytes(rows[0].kept) == b"" and rows[0].n_bytes == 0
    assert substrings.drop_repeats(documents([])).count() == 0
    twice = substrings.drop_repeats(documents([(1, "y" * 150 + "z" * 150, "s")] * 2)).collect()
    assert [(r.n_removed, r.n_spans) for r in twice] == [(300, 1)] * 2


def test_suffix_arrays_by_sorting():
    r = np.random.default_rng(3)
    for t in range(150):
        s = np.append(r.integers(1, [2, 3, 5, 30][t % 4] + 1, r.integers(1, 80)), 0).astype(np.int16)
        order = suffixes.suffix_array(s, 10**6)
        assert order.tolist() == sorted(range(len(s)), key=lambda i: s[i:].tolist())
        at = np.arange(max(0, len(s) - 4))
        counts = Counter(tuple(s[i : i + 4]) for i in range(len(s) - 3))
        assert suffixes.common_prefixes(s, order, at, 4).tolist() == [counts[tuple(s[i : i + 4])] > 1 for i in at]


def test_contexts_of_hot_anchors_are_not_taken_apart_into_windows(spark, documents, prose):
    """Blocks of windows decide for most of them; the spans are those of all windows."""
    r, passage = random.Random(4), prose(7, 300).encode()[:300]
    place = substrings.anchor_place(np.frombuffer(passage[:200], np.uint8), 40)
    contexts = []
    for i in range(300):
        data = bytearray(passage[: 200 + r.randrange(1, 100)])
        if i % 3:  # an edit to the right or left of the anchor
            at = r.choice([*range(place), *range(place + 40, len(data))])
            data[at] = 65 + i % 20
        if substrings.anchor_place(np.frombuffer(bytes(data[-200:]), np.uint8), 40) == place - (len(data) - 200):
            contexts.append(bytes(data))
    contexts = [c for c in dict.fromkeys(contexts) if substrings.anchor_place(np.frombuffer(c[:200], np.uint8), 40) == place]
    assert len(contexts) > 50
    counts = Counter(c[i : i + 200] for c in contexts for i in range(len(c) - 199))
    rows = [(k, 0, 1000, True, c) for k, c in enumerate(contexts)]
    cuts = spark.createDataFrame(rows, "k long, k2 long, first long, single boolean, bytes binary")
    covered = {}
    for s in substrings.hot_spans(cuts, 200, 40).collect():
        covered.setdefault(s.k, set()).update(range(s.start - 1000, s.end - 1000))
    for k, c in enumerate(contexts):
        agree = [i for i in range(len(c) - 199) if counts[c[i : i + 200]] > 1]
        assert covered.get(k, set()) == {j for i in agree for j in range(i, i + 200)}
    blocks = substrings.hot_blocks(cuts, 200, 40)
    names = ["common1", "common2", "whole1", "whole2"]
    one = F.min(F.struct("k", "k2", "first", "start", "windows", "single")).alias("one")
    different = blocks.groupBy(*names).agg(F.count("*").alias("n"), one)
    assert blocks.count() + substrings.open_windows(cuts, different, 200).count() < sum(len(c) - 199 for c in contexts) / 2
