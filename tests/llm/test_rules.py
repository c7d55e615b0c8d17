from collections import Counter

from replyloom.llm import rules


def brute(text):
    import re

    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    seen, dup = set(), 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    counts = Counter(windows)
    covered = {i + j for i, w in enumerate(windows) if counts[w] > 1 for j in range(3)}
    return len(words), sum(map(len, words)), sum(text.count(c) for c in "#*$%&|<>"), dup, len(covered)


def test_measures_by_brute_force(spark, documents, odd_texts, prose):
    texts = [*odd_texts, "a b c a b c a b", "x\nx\n x\nx\n\n\n", "Mentpa " * 80, "# * | <b>", prose(1, 300) + "\n" + prose(1, 40)]
    found = {r.doc_id: r for r in rules.ledger(documents(texts)).collect()}
    assert len(found) == len(texts)
    for i, text in enumerate(texts):
        r = found[i]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == brute(text)


def test_policies_and_ablations(spark, documents, prose):
    clean, junk = prose(2, 200), "LOUD!! " * 3 + " ".join(f"{w.upper()}!!" for w in prose(3, 100).split())
    led = rules.ledger(documents([clean, junk, "short", None, clean + " ###" * 30])).cache()
    kept = {r.doc_id for r in led.where(rules.passes("v2")).collect()}
    assert kept == {0}
    rows = {r.rule: r for r in rules.ablations(led).collect()}
    assert rows["few_words"].fail == 2 and rows["few_words"].only == 1  # one word is all of "short"
    assert rows["symbols"].fail >= 1 and all(r.kept == 1 for r in rows.values())
    assert set(rows) == set(rules.POLICIES["v2"])


def test_empty_table(spark, documents):
    led = rules.ledger(documents([]))
    assert led.count() == 0 and rules.ablations(led).count() == 0
