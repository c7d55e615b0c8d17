import numpy as np
from pyspark.sql import functions as F

from replyloom.llm import classifier


def test_learns_held_out_labels(spark, documents, prose):
    texts, labels = [], []
    for i in range(300):
        good = i % 3 > 0
        words = prose(i, 60)
        texts.append(words if good else " | ".join(words.split()))
        labels.append((i, int(good)))
    docs = documents(texts)
    marked = spark.createDataFrame(labels, "doc_id long, quality int")
    weights = classifier.fit(docs, marked.where(~classifier.held_out()))
    scored = docs.withColumn("score", classifier.scores(spark, weights, F.col("text"))).collect()
    held = {r.doc_id for r in marked.where(classifier.held_out()).collect()}
    right = [(r.score >= 0.5) == bool(labels[r.doc_id][1]) for r in scored if r.doc_id in held]
    assert len(held) > 60 and np.mean(right) > 0.95
    again = classifier.fit(docs.repartition(5), marked.where(~classifier.held_out()).repartition(3))
    assert np.array_equal(weights, again)


def test_sparse_dot_product(prose):
    text, weights = prose(1, 50).encode(), np.random.default_rng(1).normal(size=1 << 10)
    at, values = classifier.features(text, classifier.WordHashes(), 10)
    assert abs((values**2).sum() - 1) < 1e-9 and len(set(at.tolist())) == len(at) and at[0] == 0
    assert 0 < classifier.logistic(float(weights[at] @ values)) < 1
    assert classifier.logistic(1e9) == 1.0 or classifier.logistic(1e9) < 1


def test_word_table_starts_anew(monkeypatch, prose):
    text = prose(1, 200).encode()
    fresh = classifier.features(text, classifier.WordHashes(), 12)
    monkeypatch.setattr(classifier, "KEPT_WORDS", 20)
    known = classifier.WordHashes()
    for i in range(5):
        classifier.features(prose(i + 2, 100).encode(), known, 12)
    again = classifier.features(text, known, 12)
    assert all(np.array_equal(a, b) for a, b in zip(fresh, again, strict=True))


def test_odd_rows(spark, documents, odd_texts):
    docs = documents(odd_texts)
    none = spark.createDataFrame([], "doc_id long, quality int")
    weights = classifier.fit(docs, none)
    assert not weights.any()
    scores = docs.select(classifier.scores(spark, weights, F.col("text")).alias("s")).collect()
    assert [r.s for r in scores] == [0.5] * len(odd_texts)
    marked = spark.createDataFrame([(0, 1), (0, 0), (1, None), (None, 1), (3, 1), (3, 1), (7, 2)], "doc_id long, quality int")
    assert np.isfinite(classifier.fit(docs, marked)).all()
    assert documents([]).select(classifier.scores(spark, weights, F.col("text"))).count() == 0
    row = docs.limit(1).select(F.lit(None).cast("long").alias("doc_id"))
    assert row.select(classifier.held_out().alias("h")).first().h is False
