import random

import pytest

#: Columns that operators use inside, and others that a table may have.
CLASHING = ("key", "text_id", "row", "k", "source_size", "h")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(
    f"{c} string" for c in CLASHING
)


@pytest.fixture(scope="session")
def documents(spark):
    """A table of documents from texts, or (id, text, source) tuples, with clashing columns."""

    def build(texts):
        rows = [t if isinstance(t, tuple) else (i, t, f"s{i % 3}") for i, t in enumerate(texts)]
        data = [(i, t, "en", s, len(t or ""), *CLASHING) for i, t, s in rows]
        return spark.createDataFrame(data, SCHEMA)

    return build


@pytest.fixture(scope="session")
def odd_texts():
    """Null, empty, blank, one word, repeated rows, other scripts, and a very long text."""
    words = random.Random(5)
    long = " ".join(f"w{words.randrange(3000)}" for _ in range(30_000))
    return [None, "", " \t\n", "one", "one", "Ünïcode wörds — ñandú", long, "same row", "same row"]


@pytest.fixture(scope="session")
def prose():
    """Invented sentences, the same for the same seed."""

    def build(seed, n, vocabulary=4000):
        r = random.Random(seed)
        return " ".join("".join(r.choice("aeiounrst") for _ in range(2 + w % 7)) + str(w % 9) * (w % 2)
                        for w in (r.randrange(vocabulary) for _ in range(n)))

    return build
