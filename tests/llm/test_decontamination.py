from collections import Counter

from pyspark.sql import functions as F

from replyloom.llm import decontamination as D


def items(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "item_id long, text string")


def leaks(docs, tests, **options):
    found = D.find_leaks(docs, tests, *D.split_item(F.col("text")), **options)
    return {(r.doc_id, r.item_id) for r in found.collect()}


def test_items_in_long_texts(spark, documents, prose):
    tests = [prose(1000 + i, 15 + i) for i in range(40)]
    texts = [prose(i, 400 + 37 * i) for i in range(12)]
    want = set()
    for i in range(0, 12, 2):
        words = texts[i].split()
        cut = (i * 61) % len(words)
        texts[i] = " ".join([*words[:cut], tests[3 * i % 40], *words[cut:], tests[i + 1].upper() + "!!"])
        want |= {(i, 3 * i % 40), (i, i + 1)}
    assert leaks(documents(texts), items(spark, tests)) == want
    assert leaks(documents(texts), items(spark, tests), index_bytes=300) == want
    left = D.drop_leaking(documents(texts), items(spark, tests), *D.split_item(F.col("text")))
    assert {r.doc_id for r in left.collect()} == set(range(1, 12, 2))


def test_near_and_far(spark, documents, prose):
    test = prose(2000, 40).split()
    near, far, half = list(test), list(test), prose(2001, 60).split()
    near[30] = "changed"  # one word of the answer; in the question five shingles of 23 would go
    for i in range(0, 40, 4):
        far[i] = "changed"
    half[10:30] = test[:20]
    texts = [" ".join(w) for w in (near, far, half)]
    assert leaks(documents(texts), items(spark, [" ".join(test)])) == {(0, 0)}


def test_search_equals_brute_force(prose, monkeypatch):
    """The block bounds leave out nothing: scores by index and by definition agree."""
    rows = [(i, prose(3000 + i, 12 + i % 20, 300).encode(), b"") for i in range(70)]
    split = [Counter(D.tokens(q)) for _, q, _ in rows]
    in_items = Counter(w for c in split for w in c)
    index = D.Index(rows, 90, 21.5, {w: n + 3 for w, n in in_items.items()}, 32)
    text = " ".join(prose(3000 + i, 12 + i % 20, 300) for i in range(0, 70, 7)) + " " + prose(9, 500, 300)
    words = D.tokens(text.encode())
    impact = {}
    for key, question, _ in rows:
        of_item = D.impacts(Counter(D.tokens(question)), 90, 21.5, {w: n + 3 for w, n in in_items.items()})
        impact[key] = {w: v / sum(of_item.values()) for w, v in of_item.items()}
    for sums in (1 << 22, 40):
        monkeypatch.setattr(D, "SUMS", sums)
        found = {(s, index.keys[item]): score for s, _, item, score in index.search(words, 0.4)}
        for start in range(0, max(1, -(-len(words) // 32) - 1) * 32, 32):
            passage = set(words[start : start + 64])
            for key in impact:
                score = sum(v for w, v in impact[key].items() if w in passage)
                assert ((start, key) in found) == (score >= 0.4) or abs(score - 0.4) < 1e-9
                if (start, key) in found:
                    assert abs(found[start, key] - score) < 1e-9


def brute(texts, tests, threshold=0.5, overlap=0.8, min_words=8):
    """Every passage of every text with every item, word for word as defined."""
    split = {}
    for key, test in enumerate(tests):
        w = test.split()
        cut = -(-len(w) * 2 // 3)
        split[key] = D.tokens(" ".join(w[:cut]).encode()), D.tokens(" ".join(w[cut:]).encode())
    long = {k: Counter(q + a) for k, (q, a) in split.items() if len(q) + len(a) >= min_words}
    in_items = Counter(w for c in long.values() for w in c)
    mean = sum(c.total() for c in long.values()) / max(1, len(long))
    found = set()
    for doc, text in enumerate(texts):
        words = D.tokens((text or "").encode())
        for key, (question, answer) in split.items():
            whole = question + answer
            if key not in long:
                if whole and any(words[i : i + len(whole)] == whole for i in range(len(words))):
                    found.add((doc, key, 1.0, 1.0, 1.0))
                continue
            impact = D.impacts(long[key], len(long), mean, in_items)
            chunk = 1 << (len(whole) - 1).bit_length()
            best = None
            for start in range(0, max(1, -(-len(words) // chunk) - 1) * chunk, chunk):
                passage = words[start : start + 2 * chunk]
                score = sum(v for w, v in impact.items() if w in set(passage)) / sum(impact.values())
                q = len(D.shingles(question) & D.shingles(passage)) / len(D.shingles(question))
                a = (Counter(answer) & Counter(passage)).total() / max(1, len(answer)) if answer else 1.0
                if score >= threshold and q >= overlap and a >= overlap:
                    best = max(best or (), (q + a, score, -start, q, a))
            if best:
                found.add((doc, key, round(best[1], 9), best[3], best[4]))
    return found


def test_whole_result_equals_brute_force(spark, documents, prose):
    """Items of all lengths, some too short to score, and edited ones; any size of the indexes."""
    tests = [prose(5000 + i, n, 400) for i, n in enumerate([8, 9, 15, 16, 17, 31, 40, 64, 65, 90, 130, 3, 1, 7, 12, 12])]
    texts = [None, ""]
    for i in range(30):
        words = prose(6000 + i, 60 + 23 * (i % 9), 400).split()
        for j in (i % 16, (5 * i + 3) % 16):
            item = tests[j].split()
            if i % 3 == 1 and len(item) > 12:
                item[len(item) * 5 // 6] = "edited"
            place = (17 * i + j) % len(words)
            words[place:place] = item
        texts.append(" ".join(words))
    want = brute(texts, tests)
    assert len({k for _, k, *_ in want}) > 12
    for index_bytes in (1 << 20, 700, 60):
        found = D.find_leaks(documents(texts), items(spark, tests), *D.split_item(F.col("text")), index_bytes=index_bytes).collect()
        assert {(r.doc_id, r.item_id, round(r.score, 9), r.question_overlap, r.answer_overlap) for r in found} == want
        assert len(found) == len(want)


def test_odd_rows(spark, documents, odd_texts):
    tests = items(spark, [None, "", "too short", "x", " . "])
    assert leaks(documents(odd_texts), tests) == set()
    assert leaks(documents(["x-ray, too", "was too, SHORT!", "short too", "y"]), tests) == {(0, 3), (1, 2)}
    assert leaks(documents([]), items(spark, ["a b c d e f g h i j"])) == set()
    assert leaks(documents(odd_texts), tests.limit(0)) == set()
    rows = documents(odd_texts)
    left = D.drop_leaking(rows, tests, *D.split_item(F.col("text")))
    assert left.columns == rows.columns and left.count() == len(odd_texts)
    ten = "a1 b2 c3 d4 e5 f6 g7 h8 i9 j0"
    twice = documents([(4, ten, "s"), (4, ten, "s")])
    assert D.find_leaks(twice, items(spark, [ten]), *D.split_item(F.col("text"))).count() == 2
