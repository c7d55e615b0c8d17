"""The registered queries of this subpackage and their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from replyloom.llm import (
    classifier,
    decontamination,
    licenses,
    lines,
    mixing,
    passages,
    periods,
    phrases,
    rules,
    simhash,
    substrings,
    tokenfiles,
    warc,
)
from replyloom.llm.common import table, words
from replyloom.session import configure

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def query(function: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return function(configure(spark), sf_dir)

    QUERIES[function.__name__] = run
    return run


@query
def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ledger of every document under the newest policy."""
    base = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    return rules.ledger(table(spark, sf_dir, "documents")).select(
        "doc_id",
        *base,
        (~rules.passes("base")).alias("base_failed"),
        rules.passes("v2").alias("kept"),
    )


@query
def op7_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores of all documents by a model that saw no label of a held-out row."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    weights = classifier.fit(docs, labels.where(~classifier.held_out()))
    scored = docs.withColumn("score", classifier.scores(spark, weights, F.col("text")))
    return scored.select(
        "doc_id",
        classifier.held_out().alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


@query
def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and near-duplicate component of every document."""
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id"
    )


@query
def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Copies of every document in a mix of sources weighing 3, 1, 2, repeating."""
    return mixing.mix(table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "source_size", "target", "taken"
    )


@query
def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page as the archives give it back."""
    return warc.round_trip(table(spark, sf_dir, "pages")).select(
        F.col("key").alias("page_id"),
        F.col("n_bytes").alias("payload_bytes"),
        F.col("digest").alias("payload_digest"),
        "record_type",
        "refers_to",
    )


# 160 bits as 32 digits of five bits; five hexadecimal digits make four of them.
_BASE32 = """array_to_string(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    ((CAST('0x' || substr(hex, CAST(i // 4 AS INT) * 5 + 1, 5) AS INT) >> CAST(15 - 5 * (i % 4) AS INT)) & 31) + 1, 1)), '')"""

ORACLE["op8_warc"] = f"""
WITH p AS (SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS hex FROM pages),
f AS (SELECT html, min(page_id) AS first FROM p GROUP BY html)
SELECT page_id, CAST(strlen(html) AS BIGINT) AS payload_bytes, {_BASE32} AS payload_digest,
    CASE WHEN first < page_id THEN 'revisit' ELSE 'response' END AS record_type,
    CASE WHEN first < page_id THEN first END AS refers_to
FROM p JOIN f USING (html)"""


@query
def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What line dedup leaves of every document."""
    docs = table(spark, sf_dir, "documents")
    n_lines = F.size(F.split(F.coalesce("text", F.lit("")), "\n", -1)).cast("long")
    return lines.drop_lines(docs.withColumn("n_lines", n_lines)).select(
        "doc_id",
        "n_lines",
        "lines_dropped",
        F.md5("text").alias("kept_md5"),
    )


_WORDS = r"list_filter(string_split_regex({0}, '[\x20\x09-\x0D]+'), lambda w: w <> '')"

ORACLE["op5_line_dedup"] = rf"""
WITH rows AS (SELECT doc_id, text, string_split(text, chr(10)) AS lines FROM documents),
texts AS (SELECT min(doc_id) AS key, text, any_value(lines) AS lines FROM rows GROUP BY text),
each AS (SELECT key, unnest(range(0, len(lines))) AS pos, unnest(lines) AS line FROM texts),
tokens AS (SELECT key, pos, list_transform({_WORDS.format('line')},
        lambda w: CASE WHEN regexp_matches(w, '[0-9]') THEN '{lines.MARK}' ELSE w END) AS words FROM each),
tree AS (SELECT key, pos, words, len(words) AS n, array_to_string(words, ' ') AS line,
    words[1 : CASE WHEN len(words) <= {lines.WHOLE} THEN len(words) ELSE least({lines.DEPTH}, len(words) // 2) END] AS head
    FROM tokens WHERE len(words) > 0),
texts_of AS (SELECT n, head, line, any_value(words) AS words, count(DISTINCT key) AS texts FROM tree GROUP BY n, head, line),
placed AS (SELECT n, head, line, texts, unnest(range(0, n)) AS spot, unnest(words) AS word FROM texts_of),
common AS (SELECT n, head, spot, word FROM placed GROUP BY n, head, spot, word HAVING sum(texts) >= {lines.MIN_DOCS}),
general AS (SELECT p.n, p.head, p.line, p.spot, p.word = '{lines.MARK}' AS number,
    CASE WHEN p.word = '{lines.MARK}' THEN p.word ELSE c.word END AS word FROM placed p LEFT JOIN common c
    ON p.n = c.n AND p.head = c.head AND p.spot = c.spot AND p.word = c.word),
templates AS (SELECT n, head, line, string_agg(coalesce(word, '{lines.MARK}'), ' ' ORDER BY spot) AS template
    FROM general GROUP BY n, head, line
    HAVING count(*) FILTER (WHERE word IS NULL) <= CASE WHEN n <= {lines.WHOLE} THEN 0.0 WHEN n <= {lines.ONE_FIELD} THEN 1.0
        ELSE n * (1 - {lines.FIXED}) + 1e-9 END
      AND 2 * count(*) FILTER (WHERE word IS NOT NULL AND NOT number) >= n
      AND count(*) FILTER (WHERE word IS NOT NULL AND NOT number) >= greatest(1, least(2, n - 1))),
marked AS (SELECT t.n, t.head, m.template, t.key, t.pos FROM tree t JOIN templates m
    ON t.n = m.n AND t.head = m.head AND t.line = m.line),
recurring AS (SELECT n, head, template, min(key) AS kept_in FROM marked
    GROUP BY n, head, template HAVING count(DISTINCT key) >= {lines.MIN_DOCS}),
gone AS (SELECT DISTINCT m.key, m.pos FROM marked m JOIN recurring r
    ON m.n = r.n AND m.head = r.head AND m.template = r.template WHERE m.key <> r.kept_in),
left_over AS (SELECT e.key, string_agg(e.line, chr(10) ORDER BY e.pos) FILTER (WHERE g.pos IS NULL) AS kept,
        count(g.pos) AS dropped
    FROM each e LEFT JOIN gone g ON e.key = g.key AND e.pos = g.pos GROUP BY e.key)
SELECT r.doc_id, CAST(len(r.lines) AS BIGINT) AS n_lines, CAST(l.dropped AS BIGINT) AS lines_dropped,
    md5(coalesce(l.kept, '')) AS kept_md5
FROM rows r JOIN texts t ON r.text = t.text JOIN left_over l ON l.key = t.key"""


@query
def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Test items that documents hold."""
    items = table(spark, sf_dir, "benchmark")
    found = decontamination.find_leaks(
        table(spark, sf_dir, "documents"), items, *decontamination.split_item(F.col("text"))
    )
    return found.select("doc_id", "item_id", "score", "question_overlap", "answer_overlap")


@query
def op6_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licenses and license notices in documents."""
    return licenses.scan(table(spark, sf_dir, "documents"))


@query
def op2_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of every document without strings of 200 bytes that occur again."""
    return substrings.drop_repeats(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256")
    )


@query
def op9_compact_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with passages of 50 words or more that other documents hold, too."""
    return passages.repeated_passages(table(spark, sf_dir, "documents"))


def _failed_sql(policy: str) -> str:
    return " OR ".join(f"({condition})" for name, condition in rules.RULES if name in rules.POLICIES[policy])


ORACLE["op10_quality_rules"] = rf"""
WITH docs AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
split AS (SELECT doc_id, {_WORDS.format('text')} AS words FROM docs),
tokens AS (SELECT doc_id, unnest(range(0, len(words))) AS spot, unnest(words) AS word FROM split),
windows AS (SELECT doc_id, spot, word AS one, lead(word, 1) OVER w AS two, lead(word, 2) OVER w AS three
    FROM tokens WINDOW w AS (PARTITION BY doc_id ORDER BY spot)),
again AS (SELECT doc_id, one, two, three FROM windows WHERE three IS NOT NULL
    GROUP BY doc_id, one, two, three HAVING count(*) > 1),
spots AS (SELECT w.doc_id, w.spot FROM windows w JOIN again a
    ON w.doc_id = a.doc_id AND w.one = a.one AND w.two = a.two AND w.three = a.three),
covered AS (SELECT doc_id, count(*) AS n FROM (
    SELECT doc_id, spot FROM spots UNION SELECT doc_id, spot + 1 FROM spots UNION SELECT doc_id, spot + 2 FROM spots)
    GROUP BY doc_id),
top AS (SELECT doc_id, max(n) AS n FROM (SELECT doc_id, word, count(*) AS n FROM tokens GROUP BY doc_id, word) GROUP BY doc_id),
kept_lines AS (SELECT doc_id, list_filter(string_split(text, chr(10)),
    lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) AS kept_lines FROM docs),
measured AS (SELECT d.doc_id, CAST(len(s.words) AS BIGINT) AS n_words,
    CAST(length(regexp_replace(d.text, '[\x20\x09-\x0D]', '', 'g')) AS BIGINT) AS word_chars,
    CAST(length(d.text) - length(regexp_replace(d.text, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
    CAST(len(l.kept_lines) - len(list_distinct(l.kept_lines)) AS BIGINT) AS n_dup_lines,
    CAST(coalesce(c.n, 0) AS BIGINT) AS n_repeat_words, len(l.kept_lines) AS n_lines,
    length(d.text) - length(regexp_replace(d.text, '[A-Z]', '', 'g')) AS n_upper,
    length(d.text) - length(regexp_replace(d.text, '[A-Za-z]', '', 'g')) AS n_letters,
    length(d.text) - length(replace(d.text, '!', '')) AS n_exclaims, coalesce(t.n, 0) AS top_word
    FROM docs d JOIN split s ON d.doc_id = s.doc_id JOIN kept_lines l ON d.doc_id = l.doc_id
    LEFT JOIN covered c ON d.doc_id = c.doc_id LEFT JOIN top t ON d.doc_id = t.doc_id)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
    {_failed_sql('base')} AS base_failed, NOT ({_failed_sql('v2')}) AS kept FROM measured"""


def with_planted_runs(docs: DataFrame) -> DataFrame:
    """``docs`` where the text of about every tenth id repeats some of its own words to its end."""
    hashed = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    rows = docs.select("doc_id", "text", words(F.col("text")).alias("words"), hashed.alias("h"))
    numbers = rows.withColumns({"n": F.size("words"), "g": F.floor(F.col("h") / 10)})
    places = numbers.withColumn("a", F.expr("if(n > 0, cast(g % n as int), 0)"))
    places = places.withColumn("p", F.expr("cast(1 + (n - a) div (3 + g % 8) as int)"))
    repeated = "slice(flatten(array_repeat(slice(words, a + 1, p), cast(ceil((n - a) / p) as int))), 1, n - a)"
    planted = F.expr(f"array_join(concat(slice(words, 1, a), {repeated}), ' ')")
    return places.select("doc_id", F.when((F.col("h") % 10 == 0) & (F.col("n") > 0), planted).otherwise(F.col("text")).alias("text"))


@query
def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of words in every document, the strongest of them, and what is left without repeats."""
    found = periods.find_periods(with_planted_runs(table(spark, sf_dir, "documents")))
    best = periods.strongest_run(F.col("runs"))
    listed = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    rows = found.withColumns({"best": best, "listed": F.array_join(F.transform(listed, lambda r: F.concat(r, F.lit("\n"))), "")})
    return rows.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        "best.start",
        "best.length",
        "best.period",
        F.expr("(1000 * best.length) div best.period").alias("exponent_milli"),
        F.sha2("listed", 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


@query
def op13_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document as the token files give it back."""
    import public_tokenizers

    encoding = tokenfiles.Encoding(public_tokenizers.path("word_bpe_49k.json"), end_id=2, folds=True)
    return tokenfiles.round_trip(table(spark, sf_dir, "documents"), encoding).select(
        F.col("key").alias("doc_id"), "start", F.col("n").alias("n_tokens"), F.crc32("ids").alias("ids_crc32")
    )


@query
def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The strongest collocations of two and three words of each language."""
    return phrases.collocations(table(spark, sf_dir, "documents"))


ORACLE["op11_collocations"] = rf"""
WITH docs AS (SELECT doc_id, coalesce(lang, 'und') AS lang,
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text FROM documents),
pieces AS (SELECT lang, doc_id, unnest(string_split_regex(text, '[.,;:!?\x0A-\x0D]')) AS piece FROM docs),
lists AS (SELECT lang, list_filter(string_split_regex(piece, '[\x20\x09]+'), lambda w: w <> '') AS w FROM pieces),
spots AS (SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM lists),
grams AS (SELECT lang, s AS size, array_to_string(w[i : i + s - 1], ' ') AS phrase
    FROM spots, (VALUES (1), (2), (3)) AS sizes(s) WHERE i + s - 1 <= len(w)),
counts AS (SELECT lang, size, phrase, count(*) AS f FROM grams GROUP BY lang, size, phrase),
totals AS (SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM counts WHERE size = 1 GROUP BY lang),
candidates AS (SELECT lang, size, phrase, f AS a, string_split(phrase, ' ') AS w FROM counts WHERE size > 1 AND f >= {phrases.SUPPORT}),
cuts AS (SELECT lang, phrase, a, k, array_to_string(w[1 : k], ' ') AS head, array_to_string(w[k + 1 : size], ' ') AS rest
    FROM (SELECT *, unnest(range(1, size)) AS k FROM candidates)),
cut_scores AS (SELECT c.lang, c.phrase, c.a, c.k, x.f AS l, y.f AS r,
    CAST((CAST({phrases.SCALE} AS HUGEINT) * c.a * c.a) // (CAST(x.f AS HUGEINT) * y.f) AS BIGINT) AS score
    FROM cuts c JOIN counts x ON c.lang = x.lang AND c.head = x.phrase JOIN counts y ON c.lang = y.lang AND c.rest = y.phrase),
best AS (SELECT * FROM cut_scores QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
inner_pairs AS (SELECT lang, array_to_string(w[i : i + 1], ' ') AS phrase, max(a) AS around
    FROM (SELECT *, unnest([1, 2]) AS i FROM candidates WHERE size = 3) GROUP BY ALL),
kept AS (SELECT b.* FROM best b LEFT JOIN inner_pairs p ON b.lang = p.lang AND b.phrase = p.phrase
    WHERE p.around IS NULL OR 100 * p.around < {phrases.INSIDE_PERCENT} * b.a),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept)
SELECT r.lang, r.rank, r.phrase, r.a, r.l, r.r, t.n, r.score FROM ranked r JOIN totals t ON r.lang = t.lang WHERE r.rank <= {phrases.TOP}"""
