import random
from itertools import combinations

from replyloom.llm import licenses


def found(docs, **options):
    return sorted((r.doc_id, r.license) for r in licenses.scan(docs, **options).collect())


def test_every_template_in_place(spark, documents, prose):
    names = list(licenses.TEMPLATES)
    texts = [f"{prose(i, 70 * i)} {licenses.TEMPLATES[n].upper()} {prose(50 + i, 90)}" for i, n in enumerate(names)]
    hits = found(documents(texts))
    assert {(i, n) for i, n in enumerate(names)} <= set(hits)
    # A longer license may hold a shorter notice, and nothing else is found.
    assert {n for _, n in set(hits) - {(i, n) for i, n in enumerate(names)}} <= {"Apache-2.0-notice"}


def test_edited_and_scattered(spark, documents, prose):
    words = licenses.TEMPLATES["MIT"].split()
    edited = [w for i, w in enumerate(words) if i % 12] + ["end"]
    scattered = " ".join(f"{w} {prose(i, 12)}" for i, w in enumerate(words))
    other = prose(3, 500)
    assert found(documents([" ".join(edited), scattered, other])) == [(0, "MIT")]


def test_two_places(spark, documents, prose):
    notice = licenses.TEMPLATES["MIT-notice"]
    rows = licenses.scan(documents([f"{notice} {prose(1, 100)} {notice}"])).collect()
    assert [r.first_word for r in sorted(rows)] == [0, 105] and {r.coverage for r in rows} == {1.0}


def test_patience_steps_by_brute_force():
    r = random.Random(1)
    for _ in range(60):
        pairs = list(enumerate(r.sample(range(20), 9)))
        longest = max(k for k in range(1, 10) for c in combinations(pairs, k) if all(a[1] < b[1] for a, b in zip(c, c[1:])))
        chain = licenses.increasing(pairs)
        assert len(chain) == longest and all(a < b and x < y for (a, x), (b, y) in zip(chain, chain[1:]))
        a, b = [r.randrange(6) for _ in range(12)], [r.randrange(6) for _ in range(12)]
        found = licenses.align(a, b)
        assert all(a[i] == b[j] for i, j in found)
        assert all(x[0] < y[0] and x[1] < y[1] for x, y in zip(found, found[1:]))
    assert licenses.align(list("abcdef"), list("abcdef")) == [(i, i) for i in range(6)]


def test_odd_rows(spark, documents, odd_texts):
    assert found(documents(odd_texts)) == [] and found(documents([])) == []
