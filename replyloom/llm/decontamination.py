"""Benchmark decontamination by BM25 with block-max bounds.

Test items are the indexed side: for every word, the items that have it with their BM25 impact,
divided by the item's score against itself, so that one threshold serves items of any
length. Items lie in blocks, and each word keeps its largest impact per block. Every passage of
every text is a query. Its words' block maxima are added up first, each word once in each half of the passage: a block whose sum stays below
the threshold is skipped, as no item in it can reach it; the others are scored item by item,
and every item at or above the threshold is retrieved, not only the best. Passages of one text
are bounded together.

What is retrieved is verified: of the question's five-word shingles and of the answer's words a
share of ``overlap`` or more must be in the passage. Items are dealt to classes by length, up to a power
of two; passages are twice as long as that and overlap by half, so every occurrence lies within
one of them whole. Items of fewer than ``min_words`` words have too little to score: they are found
where all their words stand in a row.

Items and their word counts are Spark tables, and so are the numbers of items and of items with
a word that scores depend on. What is sent to all tasks at once is a bundle of indexes over
``index_bytes`` of items; texts are read once per bundle. Results do not depend on that number.

Words are lower-cased (A-Z) with ASCII punctuation taken as space. Defined results: null and empty
texts or items never match, nor do items without an id; repeated items with one id are one item, the
first in order of text; of an item's passages with the same overlap the better, then the first
counts; a text of any length is searched whole, its words in memory; documents with null or
repeated ids are all found; an empty table on either side finds nothing; further columns are
carried whatever their names.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Callable, Iterator, Mapping
from itertools import repeat

import numpy as np
import pandas as pd
from pyspark.broadcast import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from replyloom.llm.common import map_rows, words
from replyloom.session import materialize

SHINGLE = 5
OVERLAP = 0.8
THRESHOLD = 0.5
MIN_WORDS = 8
BLOCK = 4
INDEX_BYTES = 1 << 20
#: Sums of maxima held at once, of a text's chunks times blocks.
SUMS = 1 << 22
K1, B = 1.2, 0.75

_MARKS = bytes(c for c in range(33, 127) if not chr(c).isalnum())
_SPACED = bytes.maketrans(_MARKS + bytes(range(65, 91)), b" " * len(_MARKS) + bytes(range(97, 123)))


def tokens(text: bytes | None) -> list[bytes]:
    return (text or b"").translate(_SPACED).split()


def shingles(found: list[bytes]) -> set[tuple[bytes, ...]]:
    return {tuple(found[i : i + SHINGLE]) for i in range(max(1, len(found) - SHINGLE + 1))} if found else set()


class Index:
    """Postings of items with impacts, and the words' largest impacts per block of items.

    ``count``, ``mean`` and ``in_items`` are of all items, those of other indexes included: their
    number, their mean length and in how many a word is. ``chunk`` is half a passage, as long as
    any item or longer.
    """

    def __init__(self, items: list[tuple[int, bytes, bytes]], count: int, mean: float, in_items: Mapping[bytes, int], chunk: int):
        split = [(key, tokens(question), tokens(answer)) for key, question, answer in items]
        # Items alike in their words lie together, so that blocks bound them well.
        split.sort(key=lambda x: (len(x[1]) + len(x[2]), x[1]))
        self.keys = [key for key, _, _ in split]
        self.questions = [shingles(question) for _, question, _ in split]
        self.answers = [Counter(answer) for _, _, answer in split]
        self.chunk = chunk
        self.blocks = -(-len(split) // BLOCK)
        self.words: dict[bytes, int] = {}
        posted: list[list[tuple[int, float]]] = [[]]  # word 0 stands for all that no item has
        for item, (_, question, answer) in enumerate(split):
            impact = impacts(Counter(question + answer), count, mean, in_items)
            whole = sum(impact.values())
            for word, value in impact.items():
                if word not in self.words:
                    self.words[word] = len(posted)
                    posted.append([])
                posted[self.words[word]].append((item, value / whole))
        # Postings of all words one after another, and where each word's begin; so for the blocks.
        self.begin = np.cumsum([0, *map(len, posted)])
        self.items = np.array([item for p in posted for item, _ in p], np.int64)
        self.impacts = np.array([value for p in posted for _, value in p])
        word_of = np.repeat(np.arange(len(posted)), np.diff(self.begin))
        cells, cell = np.unique(word_of * max(1, self.blocks) + self.items // BLOCK, return_inverse=True)
        self.maxima = np.zeros(len(cells))
        np.maximum.at(self.maxima, cell, self.impacts)
        self.block_of = cells % max(1, self.blocks)
        self.block_begin = np.searchsorted(cells, np.arange(len(posted) + 1) * max(1, self.blocks))

    def bounds(self, chunk: np.ndarray, word: np.ndarray, chunks: int) -> np.ndarray:
        """Sums of the words' maxima per chunk and block."""
        at, of = spread(self.block_begin, word)
        cells = chunk[of] * self.blocks + self.block_of[at]
        return np.bincount(cells, self.maxima[at], chunks * self.blocks).reshape(chunks, self.blocks)

    def search(self, found: list[bytes], threshold: float) -> Iterator[tuple[int, int, int, float]]:
        """``(first word, last word, item, score)`` of passages and items at the threshold.

        A passage is two chunks of a text.
        """
        yield from self.search_numbers(numbered(self.words, found), threshold)

    def search_numbers(self, numbers: np.ndarray, threshold: float) -> Iterator[tuple[int, int, int, float]]:
        """:meth:`search` for words by their numbers in :attr:`words`, 0 for others."""
        at = np.flatnonzero(numbers)
        if not len(at):
            return
        # A word counts once in a chunk.
        size, chunks = len(self.begin) - 1, -(-len(numbers) // self.chunk)
        pairs = np.unique(at // self.chunk * size + numbers[at])
        chunk, word = pairs // size, pairs % size
        edge = np.searchsorted(pairs, np.arange(chunks + 1) * size)
        together = max(1, SUMS // self.blocks)
        for low in range(0, max(1, chunks - 1), together):
            high = min(low + together + 1, chunks)
            part = slice(edge[low], edge[high])
            sums = self.bounds(chunk[part] - low, word[part], high - low)
            over = (sums[:-1] + sums[1:] if len(sums) > 1 else sums) >= threshold - 1e-4
            for passage in np.flatnonzero(over.any(axis=1)).tolist():
                stop = min(low + passage + 2, chunks)
                words = np.unique(word[edge[low + passage] : edge[stop]])
                posting, _ = spread(self.begin, words)
                posting = posting[over[passage][self.items[posting] // BLOCK]]
                scores = np.bincount(self.items[posting], self.impacts[posting])
                start = (low + passage) * self.chunk
                for item in np.flatnonzero(scores >= threshold).tolist():
                    yield start, min(start + 2 * self.chunk, len(numbers)), item, float(scores[item])

    def leaks(self, found: list[bytes], numbers: np.ndarray, threshold: float, overlap: float) -> list[tuple]:
        """``(key, score, question overlap, answer overlap, first word, last word)``, the best
        passage of each item that is verified."""
        best: dict[int, tuple] = {}
        for start, end, item, score in self.search_numbers(numbers, threshold):
            passage = found[start:end]
            question, answer = self.questions[item], self.answers[item]
            q = len(question & shingles(passage)) / len(question) if question else 1.0
            total = answer.total()
            a = (answer & Counter(passage)).total() / total if total else 1.0
            if q >= overlap and a >= overlap:
                row = (self.keys[item], score, q, a, start, end)
                best[item] = max(best.get(item, row), row, key=lambda r: (r[2] + r[3], r[1], -r[4]))
        return [best[item] for item in sorted(best)]


def split_item(text: Column, share: float = 2 / 3) -> tuple[Column, Column]:
    """An item of one field: the first part of its words asks, the rest answers."""
    all_words = words(text)
    cut = F.ceil(F.size(all_words) * F.lit(share)).cast("int")
    return (
        F.array_join(F.slice(all_words, 1, cut), " "),
        F.array_join(F.slice(all_words, cut + 1, F.size(all_words)), " "),
    )


class ShortItems:
    """Items too short to score, found word by word."""

    def __init__(self, items: list[tuple[int, bytes, bytes]]):
        self.by_first: dict[bytes, list[tuple[int, list[bytes]]]] = {}
        for key, question, answer in items:
            whole = tokens(question) + tokens(answer)
            self.by_first.setdefault(whole[0], []).append((key, whole))

    def leaks(self, found: list[bytes]) -> list[tuple]:
        """As :meth:`Index.leaks`: the first place of each item."""
        best: dict[int, tuple] = {}
        if self.by_first.keys().isdisjoint(found):
            return []
        for i, word in enumerate(found):
            for key, whole in self.by_first.get(word, ()):
                if key not in best and found[i : i + len(whole)] == whole:
                    best[key] = key, 1.0, 1.0, 1.0, i, i + len(whole)
        return [best[key] for key in sorted(best)]


class Bundle:
    """Indexes that texts are searched in together: their words are looked up once."""

    def __init__(self, indexes: list[Index], short: ShortItems | None):
        self.indexes, self.short = indexes, short
        self.words: dict[bytes, int] = {}
        for index in indexes:
            for word in index.words:
                self.words.setdefault(word, len(self.words) + 1)
        self.own: list[np.ndarray] = []
        for index in indexes:
            own = np.zeros(len(self.words) + 1, np.int64)
            own[[self.words[word] for word in index.words]] = list(index.words.values())
            self.own.append(own)

    def leaks(self, text: bytes | None, threshold: float, overlap: float) -> list[tuple]:
        found = tokens(text)
        rows = self.short.leaks(found) if self.short else []
        numbers = numbered(self.words, found)
        if numbers.any():
            for index, own in zip(self.indexes, self.own, strict=True):
                rows += index.leaks(found, own[numbers], threshold, overlap)
        return rows


def numbered(words: Mapping[bytes, int], found: list[bytes]) -> np.ndarray:
    return np.fromiter(map(words.get, found, repeat(0)), np.int64, len(found))


def impacts(words: Counter, count: int, mean: float, in_items: Mapping[bytes, int]) -> dict[bytes, float]:
    """BM25 impact of the words of an item."""
    length = words.total()
    return {
        word: math.log(1 + (count - in_items[word] + 0.5) / (in_items[word] + 0.5))
        * (tf * (K1 + 1) / (tf + K1 * (1 - B + B * length / mean)))
        for word, tf in words.items()
    }


def spread(begin: np.ndarray, chosen: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All places of the chosen lists, and for each which of the chosen it is of."""
    counts = begin[chosen + 1] - begin[chosen]
    of = np.repeat(np.arange(len(chosen)), counts)
    return np.arange(len(of)) + (begin[chosen] - (np.cumsum(counts) - counts))[of], of


def bundles(
    items: DataFrame, key: str, question: Column, answer: Column, min_words: int, index_bytes: int
) -> Iterator[Bundle]:
    """Indexes over all items, in bundles over about ``index_bytes`` of them."""
    rows = items.select(
        F.col(key).cast("long").alias("key"),
        F.coalesce(question, F.lit("")).cast("binary").alias("question"),
        F.coalesce(answer, F.lit("")).cast("binary").alias("answer"),
    ).where("key is not null")
    single = rows.groupBy("key").agg(F.min(F.struct("question", "answer")).alias("x")).select("key", "x.*")

    def measure(rows: Iterator[dict]) -> Iterator[tuple]:
        for row in rows:
            whole = tokens(row["question"]) + tokens(row["answer"])
            # Class 0 for items too short to score, else the power of two that holds the item.
            kind = (len(whole) - 1).bit_length() if len(whole) >= min_words else 0
            if whole:
                yield row["key"], row["question"], row["answer"], len(whole), kind, list(set(whole))

    schema = "key bigint, question binary, answer binary, n int, kind int, words array<binary>"
    measured = materialize(map_rows(single, measure, schema), "items")
    scored = measured.where("kind > 0")
    in_items = materialize(scored.select(F.explode("words").alias("word")).groupBy("word").count(), "item-words")
    count, mean = scored.agg(F.count("*"), F.avg("n")).first()
    size = F.sum(F.length("question") + F.length("answer"))
    todo: list[tuple[int, int, int]] = []
    held = 0
    for kind, total in measured.groupBy("kind").agg(size).orderBy("kind").collect():
        parts = total // index_bytes + 1
        for part in range(parts):
            if todo and held + total // parts > index_bytes:
                yield _bundle(measured, in_items, todo, count, mean)
                todo, held = [], 0
            todo.append((kind, parts, part))
            held += total // parts
    if todo:
        yield _bundle(measured, in_items, todo, count, mean)


def _bundle(
    measured: DataFrame, in_items: DataFrame, todo: list[tuple[int, int, int]], count: int, mean: float
) -> Bundle:
    found: list[Index] = []
    short: list[tuple[int, bytes, bytes]] = []
    for kind, parts, part in todo:
        chosen = measured.where((F.col("kind") == kind) & (F.pmod(F.xxhash64("key"), F.lit(parts)) == part))
        rows = [(r["key"], bytes(r["question"]), bytes(r["answer"])) for r in chosen.orderBy("key").collect()]
        if not rows:
            continue
        if kind == 0:
            short += rows
            continue
        words = chosen.select(F.explode("words").alias("word")).distinct().join(in_items, "word")
        numbers = {bytes(r["word"]): r["count"] for r in words.collect()}
        found.append(Index(rows, count, mean, numbers, 1 << kind))
    return Bundle(found, ShortItems(short) if short else None)


def find_leaks(
    docs: DataFrame,
    items: DataFrame,
    question: Column,
    answer: Column,
    key: str = "doc_id",
    text: str = "text",
    item_key: str = "item_id",
    threshold: float = THRESHOLD,
    overlap: float = OVERLAP,
    min_words: int = MIN_WORDS,
    index_bytes: int = INDEX_BYTES,
) -> DataFrame:
    """One row per document and test item that it holds: where, and how much of it."""
    spark = docs.sparkSession
    kind = dict(docs.dtypes)[key]
    schema = (
        f"`{key}` {kind}, item_id bigint, score double, question_overlap double,"
        " answer_overlap double, first_word bigint, last_word bigint"
    )
    chosen = docs.select(F.col(key).alias("key"), F.col(text).cast("binary").alias("text"))
    result = spark.createDataFrame([], schema)
    for bundle in bundles(items, item_key, question, answer, min_words, index_bytes):
        shared = spark.sparkContext.broadcast(bundle)

        def run(rows: Iterator[dict], shared=shared) -> Iterator[tuple]:
            for row in rows:
                for leak in shared.value.leaks(row["text"], threshold, overlap):
                    yield row["key"], *leak

        result = result.union(map_rows(chosen, run, schema))
    return result


def drop_leaking(
    docs: DataFrame,
    items: DataFrame,
    question: Column,
    answer: Column,
    text: str = "text",
    item_key: str = "item_id",
    threshold: float = THRESHOLD,
    overlap: float = OVERLAP,
    min_words: int = MIN_WORDS,
    index_bytes: int = INDEX_BYTES,
) -> DataFrame:
    """The rows of ``docs`` that hold no test item; rows stay where they are."""
    spark, left = docs.sparkSession, docs
    for bundle in bundles(items, item_key, question, answer, min_words, index_bytes):
        leaking = _leaking(spark.sparkContext.broadcast(bundle), threshold, overlap)
        left = left.where(~leaking(F.col(text).cast("binary")))
    return left


def _leaking(shared: Broadcast, threshold: float, overlap: float) -> Callable[..., Column]:
    @F.pandas_udf("boolean")
    def leaking(texts: pd.Series) -> pd.Series:
        return pd.Series([bool(shared.value.leaks(text, threshold, overlap)) for text in texts], dtype=bool)

    return leaking
