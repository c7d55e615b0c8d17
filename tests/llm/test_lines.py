from replyloom.llm import lines


def dropped(rows, **options):
    return {r.doc_id: (r.text, r.lines_dropped) for r in lines.drop_lines(rows, **options).collect()}


def test_templates_with_variable_fields(spark, documents, prose):
    texts = [f"{prose(i, 30)}\nPage {i} of {i * 7} in this long book\n{prose(100 + i, 30)}" for i in range(8)]
    found = dropped(documents(texts))
    assert found[0] == (texts[0], 0)
    for i in range(1, 8):
        head, _, tail = texts[i].split("\n")
        assert found[i] == (f"{head}\n{tail}", 1)


def test_one_free_word_in_six(spark, documents, prose):
    names = ["anna", "bert", "carl", "dora", "emil", "fritz"]
    texts = [f"{prose(i, 20)}\nwritten and checked today by {n}" for i, n in enumerate(names)]
    found = dropped(documents(texts))
    assert [found[i][1] for i in range(6)] == [0, 1, 1, 1, 1, 1]
    assert all(n == 0 for _, n in dropped(documents(texts), fixed=0.9).values())


def test_copies_of_a_text_count_once(spark, documents, prose):
    body = "\n".join(prose(i, 25) for i in range(4))
    assert all(n == 0 for _, n in dropped(documents([body] * 9)).values())


def test_odd_rows(spark, documents, odd_texts):
    rows = documents([*odd_texts, "a b\nc", (None, "the same five words here", "s")])
    found = lines.drop_lines(rows)
    assert found.columns == [*rows.columns, "lines_dropped"]
    clash = documents(["a", "b"]).withColumnRenamed("row", "lines_dropped")
    assert lines.drop_lines(clash).columns.count("lines_dropped") == 1
    assert [r.lines_dropped for r in lines.drop_lines(clash).collect()] == [0, 0]
    assert sorted(map(str, found.drop("lines_dropped").collect())) == sorted(map(str, rows.collect()))
    assert lines.drop_lines(documents([])).count() == 0


def test_repeated_rows_agree(spark, documents):
    line = "one and the same line"
    rows = [(i, f"{'abcdefgh'[i]} is its first\n{line}", "s") for i in range(7)] + [(6, f"g is its first\n{line}", "s")]
    found = [r for r in lines.drop_lines(documents(rows)).collect() if r.doc_id == 6]
    assert [r.text for r in found] == ["g is its first"] * 2


def test_long_digit_words_stay_linear(spark, documents):
    text = "x" * 1_000_000 + " " + "1" * 200_000 + " y"
    assert dropped(documents([text]))[0] == (text, 0)


def test_short_lines(spark, documents, prose):
    """One and two words as they are, three with a field, numbers as fields."""
    names = ["anna", "bert", "carl", "dora", "emil", "fritz", "gerd", "hans"]
    texts = [
        f"{prose(i, 20)}\nRead more\nShare\nPosted by {names[i]}\nPage {i}\n{prose(50 + i, 20)}\n\n{names[i]} again"
        for i in range(8)
    ]
    found = dropped(documents(texts))
    assert found[0] == (texts[0], 0)
    for i in range(1, 8):
        assert found[i] == (f"{prose(i, 20)}\n{prose(50 + i, 20)}\n\n{names[i]} again", 4)


def test_rows_of_numbers_and_two_words_with_one_in_common_stay(spark, documents):
    texts = [f"{i + 10} {i * 7} {i * i + 3}\nthe {'abcdefgh'[i]}word\n{i} {i} total\n{i}" for i in range(8)]
    assert all(n == 0 for _, n in dropped(documents(texts)).values())
