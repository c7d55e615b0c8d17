import random
import re
from collections import Counter

import pyarrow.parquet as pq
import pytest

from replyloom.llm import phrases
from replyloom.session import materialize


def pieces(text):
    low = (text or "").translate({i: i + 32 for i in range(65, 91)})
    for piece in re.split(r"[.,;:!?\x0A-\x0D]", low):
        yield [w for w in re.split(r"[\x20\x09]+", piece) if w]


def brute(docs, support=10, longest=3, k=2000, percent=50):
    """Counts of every phrase, then the definitions word for word."""
    counts, totals = Counter(), Counter()
    for lang, text in docs:
        lang = "und" if lang is None else lang
        for w in pieces(text):
            totals[lang] += len(w)
            for n in range(1, longest + 1):
                counts.update((lang, *w[i : i + n]) for i in range(len(w) - n + 1))
    chosen = {p: f for p, f in counts.items() if len(p) > 2 and f >= support}
    found = []
    for p, a in chosen.items():
        lang, w = p[0], p[1:]
        cuts = []
        for c in range(1, len(w)):
            left, right = counts[lang, *w[:c]], counts[lang, *w[c:]]
            cuts.append((phrases.SCALE * a * a // (left * right), c, left, right))
        score, _, left, right = min(cuts)
        longer = [f for q, f in chosen.items() if q[0] == lang and len(q) > len(p)
                  and any(q[1 + i : 1 + i + len(w)] == w for i in range(len(q) - len(p) + 1))]
        if not any(100 * f >= percent * a for f in longer):
            found.append((lang, -score, -a, " ".join(w).encode(), left, right))
    rows, rank = [], Counter()
    for lang, score, a, phrase, left, right in sorted(found):
        rank[lang] += 1
        if rank[lang] <= k:
            rows.append((lang, rank[lang], phrase.decode(), -a, left, right, totals[lang], -score))
    return rows


def some_texts(seed, n=120):
    r = random.Random(seed)
    fixed = ["New York City", "as well as", "à la carte", "on the other hand", "El Niño"]
    for i in range(n):
        words = [r.choice(fixed) if r.random() < 0.2 else f"W{r.randrange(60)}" for _ in range(r.randrange(60))]
        marks = [r.choice([" ", " ", " ", "\t ", ", ", ".\n", "! "]) for _ in words]
        yield r.choice(["en", "en", "en", "fr", None, "und", ""]), "".join(w + m for w, m in zip(words, marks, strict=True))


def rows_of(spark, docs, **options):
    df = spark.createDataFrame([(lang, t, "x", "y") for lang, t in docs], "lang string, text string, n string, key string")
    return sorted(map(tuple, phrases.collocations(df.repartition(5), **options).collect()))


@pytest.mark.parametrize("options", [{}, {"shards": 1}, {"support": 3, "longest": 4, "shards": 7}, {"k": 5, "support": 4}])
def test_same_as_brute_force(spark, options):
    docs = list(some_texts(4))
    want = brute(docs, **{k: v for k, v in options.items() if k != "shards"})
    assert rows_of(spark, docs, **options) == sorted(want) and len(want) > 15


@pytest.mark.parametrize("size", [50, 7, 3, 1])
def test_blocks_of_a_few_words(size):
    """Phrases over the ends of blocks are counted once."""
    docs = list(some_texts(9, 40))
    counted = Counter()
    for row in phrases.cut_blocks(iter([batch_of(docs)]), 2, size):
        block = phrases.Block(row)
        for n in (1, 2, 3):
            if len(block.ids) < n:
                continue
            places, number = block.counts(n, block.whole(n))
            for lang, phrase, k in zip(block.lang_names(places).to_pylist(), block.phrases(places, n).to_pylist(), number.tolist(), strict=True):
                counted[lang, phrase] += k
    want = Counter()
    for lang, text in docs:
        for w in pieces(text):
            want.update(("und" if lang is None else lang, " ".join(w[i : i + n])) for n in (1, 2, 3) for i in range(len(w) - n + 1))
    assert counted == want


def test_tokens_in_blocks():
    assert [w for part in phrases.tokens(b"a b. C,d " * 50, 10) for w in part] == [b"a", b"b", b".", b"c", b".", b"d"] * 50


def batch_of(docs):
    import pyarrow as pa

    return pa.RecordBatch.from_pylist([{"lang": "und" if lang is None else lang, "shard": i // 9 % 3, "text": t.encode()} for i, (lang, t) in enumerate(docs)])


def test_full_bitmap_loses_nothing(spark, monkeypatch):
    docs = list(some_texts(2))
    monkeypatch.setattr(phrases, "MOST_BITS", 15)
    small = phrases.bitmap
    monkeypatch.setattr(phrases, "bitmap", lambda rows, key: small(rows, key, 15))
    assert rows_of(spark, docs, support=3) == sorted(brute(docs, support=3))


def test_products_beyond_64_bits(spark):
    rows = [(3_000_000_000, 4_000_000_000, 3_000_000_001), (10, 10, 10), (10**14, 10**14 + 1, 10**14), (1, 10**12, 10**12)]
    df = spark.createDataFrame(rows, "a long, l long, r long")
    found = [r[0] for r in df.select(phrases.cut_score(df.a, df.l, df.r)).collect()]
    assert found == [phrases.SCALE * a * a // (left * right) for a, left, right in rows]


def test_nothing_to_find(spark):
    assert rows_of(spark, []) == []
    assert rows_of(spark, [("en", None), ("en", ""), (None, " .,;"), ("en", "one")] * 20) == []


def test_long_text_and_repeated_rows(spark):
    text = "aa bb " * 200_000
    assert rows_of(spark, [("en", text)] * 3) == sorted(brute([("en", text)] * 3))


def test_blocks_are_not_compressed_by_the_file_format(spark, monkeypatch):
    """Its codecs hold whole files of blocks beside the heap; blocks are compressed one by one."""
    written = {}

    def write(df, label, **options):
        written[label] = materialize(df, label, **options)
        return written[label]

    monkeypatch.setattr(phrases, "materialize", write)
    rows_of(spark, list(some_texts(6)), support=3)
    blocks = written["phrase-blocks"]
    meta = pq.ParquetFile(blocks.inputFiles()[0].removeprefix("file://")).metadata.row_group(0)
    assert {meta.column(i).compression for i in range(meta.num_columns)} == {"UNCOMPRESSED"}
    row = max(blocks.collect(), key=lambda r: len(r.ids))
    block = phrases.Block(row.asDict())
    assert len(row.ids) < block.ids.nbytes and block.ids.max() < len(block.words)
