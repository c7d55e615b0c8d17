"""Collocations: phrases that recur, ranked by how much their words belong together.

Frequent phrases are found by partitioning (SON). Rows are dealt to ``shards`` once and written, as
blocks of numbered words that all later passes read.
Each shard is mined completely, level by level, at a support lowered to its share of all words: a
phrase with ``support`` occurrences has that share of them in one shard at least, so the union of
what is frequent in some shard holds all of them. A second pass counts these candidates, by their
text, over all rows, which alone decides.

A shard is no task: its blocks are read by any number of tasks, which send one row per block and
different phrase; a common phrase is no single task's work.
A level sends only phrases whose two parts without the last and without the first word are
frequent in the shard. What is frequent is looked up in a bitmap of 64-bit hashes, of 16 bits an entry
and :data:`MOST_BITS` at most: hashes that meet, and bitmaps that fill up on very large input, let
more phrases through and lose none.

Defined results: a null language is ``und``; a null or empty text has no words; a text of any length
is read in blocks; repeated rows count each time; ties in score go to the more frequent, then the
lesser phrase in byte order; an empty table gives no rows; further columns are not read.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.broadcast import Broadcast
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from replyloom.llm.common import join64
from replyloom.session import materialize

SUPPORT, LONGEST, SHARDS, TOP = 10, 3, 4, 2000
#: A phrase goes if a longer candidate around it has so many percent of its occurrences.
INSIDE_PERCENT = 50
SCALE = 1_000_000
#: Words counted together, and bytes of a text that are split together.
WORDS, BLOCK = 1 << 19, 1 << 20
#: Rows handed from Python to Spark together.
ROWS_OUT = 1 << 14
#: Size of the largest bitmap as a power of two: 32 MB.
MOST_BITS = 28
SEGMENT = 15
#: Rankings are made in this many parts before the last step.
PARTS = 64

BREAK = b"."
#: Upper to lower case; what ends a piece to BREAK, which no word holds; tabs to blanks.
NORMAL = bytes.maketrans(bytes(range(65, 91)) + b",;:!?\n\x0b\x0c\r\t", bytes(range(97, 123)) + BREAK * 9 + b" ")


def tokens(text: bytes, size: int = BLOCK) -> Iterator[list[bytes]]:
    """Words in order, with BREAK between pieces, in blocks."""
    start, blank = 0, re.compile(rb"[ \t\n.,;:!?]")
    while start < len(text):
        cut = blank.search(text, start + size)
        end = cut.end() if cut else len(text)
        yield text[start:end].translate(NORMAL).replace(BREAK, b" . ").split()
        start = end


def shard_salt(shard: int) -> int:
    return (shard + 1) * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF


def _signed(number: int) -> int:
    return number - (1 << 64) if number >> 63 else number


@dataclass(frozen=True)
class Bitmap:
    """Leading bits of hashes, one bit each, in memory of every task."""

    data: Broadcast
    bits: int

    def holds(self, keys: np.ndarray) -> np.ndarray:
        place = keys >> np.uint64(64 - self.bits)
        whole = np.frombuffer(self.data.value, np.uint8)
        return (whole[place >> np.uint64(3)] >> (place & np.uint64(7)).astype(np.uint8) & 1).astype(bool)


def bitmap(rows: DataFrame, key: Column, most: int = MOST_BITS) -> Bitmap:
    """The bitmap of ``key``, a 64-bit hash. It is put together in segments by as many tasks as
    there are partitions; what reaches the driver is the map itself."""
    spark = rows.sparkSession
    bits = min(most, max(SEGMENT, (16 * rows.count()).bit_length()))
    places = rows.select(F.shiftrightunsigned(key, 64 - bits).alias("place"))
    dealt = places.withColumn("segment", F.shiftright("place", SEGMENT)).repartition("segment")

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        segments: dict[int, np.ndarray] = {}
        for batch in batches:
            place, segment = (np.asarray(batch[c]) for c in ("place", "segment"))
            for s in np.unique(segment).tolist():
                held = segments.setdefault(s, np.zeros(1 << SEGMENT, bool))
                held[place[segment == s] & (1 << SEGMENT) - 1] = True
        if segments:
            packed = [np.packbits(x, bitorder="little").tobytes() for x in segments.values()]
            yield pa.RecordBatch.from_arrays([pa.array(list(segments), pa.int64()), pa.array(packed, pa.binary())], ["segment", "bits"])

    whole, size = bytearray(1 << bits - 3), 1 << SEGMENT - 3
    for row in dealt.mapInArrow(fill, "segment long, bits binary").toLocalIterator():
        whole[row.segment * size : (row.segment + 1) * size] = row.bits
    return Bitmap(spark.sparkContext.broadcast(bytes(whole)), bits)


# -- blocks of words ------------------------------------------------------------------

#: Consecutive words of many texts of one shard: their languages, how many words in a row have
#: which, the different words, and which of them follow each other. The first of the different
#: words is BREAK; the first ``counted`` words were in the block before, too. Words and ids are compressed
#: here and not by Parquet, whose codecs hold pages, here whole files, in memory beside the heap.
BLOCK_ROW = "shard int, langs array<string>, runs binary, words binary, ids binary, counted int"


def cut_blocks(batches: Iterator[pa.RecordBatch], overlap: int, size: int) -> Iterator[dict]:
    """Rows of :data:`BLOCK_ROW` from rows of ``lang, shard, text``."""
    numbers: defaultdict[bytes, int] = defaultdict()
    numbers.default_factory = numbers.__len__
    langs: dict[str, int] = {}
    ids: list[np.ndarray] = []
    runs: list[tuple[int, int]] = []
    held = counted = shard = 0
    compress = zstandard.ZstdCompressor(level=1).compress

    def start(last: list[bytes], lang: str) -> None:
        nonlocal held, counted
        numbers.clear()
        numbers[BREAK] = 0
        langs.clear()
        langs[lang] = 0
        ids[:] = [np.array([numbers[w] for w in last], "<u4")]
        runs[:] = [(0, len(last))]
        held = counted = len(last)

    def block() -> dict:
        return {
            "shard": shard,
            "langs": list(langs),
            "runs": np.array(runs, "<i4").tobytes(),
            "words": compress(b" ".join(numbers)),
            "ids": compress(np.concatenate(ids).tobytes()),
            "counted": counted,
        }

    start([], "")
    for batch in batches:
        for i in range(0, batch.num_rows, 64):
            for row in batch.slice(i, 64).to_pylist():
                if row["shard"] != shard:
                    if held > counted:
                        yield block()
                    shard = row["shard"]
                    start([], row["lang"])
                lang = langs.setdefault(row["lang"], len(langs))
                for part in (*tokens(row["text"] or b""), [BREAK]):
                    ids.append(np.fromiter(map(numbers.__getitem__, part), "<u4", len(part)))
                    runs.append((lang, len(part)))
                    held += len(part)
                    if held < size:
                        continue
                    yield block()
                    # The last words stay, for the phrases that they begin.
                    names, last = list(numbers), np.concatenate(ids[-overlap - 1 :])[-overlap:] if overlap else []
                    start([names[j] for j in last], row["lang"])
                    lang = 0
    if held > counted:
        yield block()


class Block:
    """A row of :data:`BLOCK_ROW` as arrays over its words; phrases that end before ``counted`` were
    counted in the block before."""

    def __init__(self, row: dict):
        from xxhash import xxh64_intdigest

        self.shard, self.langs, self.counted = row["shard"], row["langs"], row["counted"]
        self.ids = np.frombuffer(zstandard.decompress(row["ids"]), "<u4")
        self.words = zstandard.decompress(row["words"]).split(b" ")
        lang, length = np.frombuffer(row["runs"], "<i4").reshape(-1, 2).T
        self.lang = np.repeat(lang.astype(np.int32), length)
        hashes = np.fromiter(map(xxh64_intdigest, self.words), np.uint64, len(self.words))
        salts = np.array([xxh64_intdigest(name.encode(), 42) for name in self.langs], np.uint64)
        self.hash = hashes[self.ids]
        self.salt = np.uint64(shard_salt(self.shard))
        self._keys = {1: join64(salts[self.lang], self.hash)}
        self._whole = {1: self.ids > 0}

    def keys(self, n: int) -> np.ndarray:
        """Hashes of language and phrase for the phrases of ``n`` words from each place on."""
        if n not in self._keys:
            self._keys[n] = join64(self.keys(n - 1)[:-1], self.hash[n - 1 :])
        return self._keys[n]

    def local(self, n: int) -> np.ndarray:
        """:meth:`keys` of phrase and shard."""
        return self.keys(n) ^ self.salt

    def whole(self, n: int) -> np.ndarray:
        """Whether the ``n`` words from a place on are a phrase of one piece."""
        if n not in self._whole:
            self._whole[n] = self.whole(n - 1)[:-1] & self._whole[1][n - 1 :]
        return self._whole[n]

    def counts(self, n: int, chosen: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """One place and the number of each different phrase among the chosen places."""
        places = np.flatnonzero(chosen & self.whole(n))
        places = places[np.searchsorted(places, self.counted - n + 1) :]
        keys = self.keys(n)[places]
        order = np.argsort(keys)
        ordered = keys[order]
        first = np.flatnonzero(np.concatenate(([True], ordered[1:] != ordered[:-1]))) if len(keys) else order
        return places[order[first]], np.diff(np.append(first, len(keys)))

    def lang_names(self, places: np.ndarray) -> pa.Array:
        return pa.array(self.langs, pa.string()).take(pa.array(self.lang[places]))

    def phrases(self, places: np.ndarray, n: int) -> pa.Array:
        """Phrases as strings."""
        names = pa.array(self.words, pa.binary())
        parts = [names.take(pa.array(self.ids[places + i])) for i in range(n)]
        whole = pc.binary_join_element_wise(*parts, pa.scalar(b" ", pa.binary())) if n > 1 else parts[0]
        return whole.view(pa.string())


def _map_blocks(rows: DataFrame, function: Callable[[Block], Iterator[pa.RecordBatch]], schema: str) -> DataFrame:
    """``function`` over blocks. What it yields goes out in batches of ROWS_OUT rows, so neither side
    holds all rows of a block a second time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                for out in function(Block(batch.slice(i, 1).to_pylist()[0])):
                    for first in range(0, out.num_rows, ROWS_OUT):
                        yield out.slice(first, ROWS_OUT)

    return rows.mapInArrow(run, schema)


def _batch(**columns: pa.Array | np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c) for c in columns.values()], list(columns))


# -- passes ---------------------------------------------------------------------------


def _count_words(block: Block) -> Iterator[pa.RecordBatch]:
    places, n = block.counts(1, block.whole(1))
    yield _batch(
        lang=block.lang_names(places),
        shard=np.full(len(places), block.shard, np.int32),
        word=block.phrases(places, 1),
        key=block.keys(1)[places].view(np.int64),
        n=n.astype(np.int64),
    )


def _mine(n: int, parts: Bitmap) -> Callable[[Block], Iterator[pa.RecordBatch]]:
    """Phrases of ``n`` words whose parts of one word less are frequent in the shard."""

    def mine(block: Block) -> Iterator[pa.RecordBatch]:
        if len(block.ids) < n:
            return
        known = parts.holds(block.local(n - 1)) & block.whole(n - 1)
        places, number = block.counts(n, known[:-1] & known[1:])
        shard = np.full(len(places), block.shard, np.int32)
        yield _batch(shard=shard, key=block.keys(n)[places].view(np.int64), n=number.astype(np.int64))

    return mine


def _count(candidates: dict[int, Bitmap]) -> Callable[[Block], Iterator[pa.RecordBatch]]:
    def count(block: Block) -> Iterator[pa.RecordBatch]:
        for size, known in candidates.items():
            if len(block.ids) < size:
                continue
            places, number = block.counts(size, known.holds(block.keys(size)))
            yield _batch(
                lang=block.lang_names(places),
                phrase=block.phrases(places, size),
                size=np.full(len(places), size, np.int32),
                n=number.astype(np.int64),
            )

    return count


def _by_shard(values: Sequence[int]) -> Column:
    """One of ``values`` by the row's shard."""
    return F.element_at(F.array(*[F.lit(v).cast("long") for v in values]), F.col("shard") + 1)


def frequent(
    docs: DataFrame,
    text: str = "text",
    lang: str = "lang",
    support: int = SUPPORT,
    longest: int = LONGEST,
    shards: int = SHARDS,
) -> tuple[DataFrame, DataFrame]:
    """``(words, phrases)``: ``lang, word, n`` of all words; ``lang, phrase, size, n`` of the
    phrases of two to ``longest`` words that have ``support`` occurrences or more."""
    spark = docs.sparkSession
    dealt = docs.select(
        F.coalesce(F.col(lang).cast("string"), F.lit("und")).alias("lang"),
        (F.spark_partition_id() % shards).alias("shard"),
        F.col(text).cast("binary").alias("text"),
    )
    size = WORDS

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in cut_blocks(batches, longest - 1, size):
            yield pa.RecordBatch.from_pylist([row], arrow)

    arrow = to_arrow_schema(spark.createDataFrame([], BLOCK_ROW).schema)
    rows = materialize(dealt.mapInArrow(cut, BLOCK_ROW), "phrase-blocks", compression="uncompressed")
    schema = "lang string, shard int, word string, key long, n long"
    counted = _map_blocks(rows, _count_words, schema)
    words = materialize(counted.groupBy("lang", "shard", "word").agg(F.min("key").alias("key"), F.sum("n").alias("n")), "words")

    sizes = dict(words.groupBy("shard").agg(F.sum("n")).collect())
    total = max(sum(sizes.values()), 1)
    lowered = [max(1, -(-support * sizes.get(s, 0) // total)) for s in range(shards)]
    salts = [_signed(shard_salt(s)) for s in range(shards)]

    known, candidates = words.where(F.col("n") >= _by_shard(lowered)), {}
    for n in range(2, longest + 1):
        parts = bitmap(known, F.col("key").bitwiseXOR(_by_shard(salts)))
        sent = _map_blocks(rows, _mine(n, parts), "shard int, key long, n long")
        local = sent.groupBy("shard", "key").agg(F.sum("n").alias("n")).where(F.col("n") >= _by_shard(lowered))
        known = materialize(local, "local-phrases")
        candidates[n] = bitmap(known, F.col("key"))
    sent = _map_blocks(rows, _count(candidates), "lang string, phrase string, size int, n long")
    phrases = sent.groupBy("lang", "phrase", "size").agg(F.sum("n").alias("n")).where(F.col("n") >= support)
    return words.groupBy("lang", "word").agg(F.sum("n").alias("n")), materialize(phrases, "phrases")


def cut_score(a: Column, left: Column, right: Column) -> Column:
    """``floor(SCALE * a * a / (left * right))``, exactly, for counts of up to 16 digits."""
    exact = [c.cast("decimal(16,0)") for c in (a, left, right)]
    above = exact[0] * exact[0] * F.lit(SCALE).cast("decimal(7,0)")
    return F.call_function("div", above, exact[1] * exact[2])


def scored(words: DataFrame, phrases: DataFrame, longest: int = LONGEST) -> DataFrame:
    """``lang, phrase, a, l, r, score`` of all ``phrases``: of the ways to cut one in two, the one
    that scores least, of equal ones the first."""
    # A part of a frequent phrase is frequent itself: a word, or one of the phrases.
    least = phrases.agg(F.min("n")).scalar()
    parts = words.select("lang", F.col("word").alias("part"), "n").where(F.col("n") >= least)
    parts = parts.unionByName(phrases.select("lang", F.col("phrase").alias("part"), "n"))
    cuts = phrases.select(
        "lang", "phrase", F.col("n").alias("a"), F.split("phrase", " ").alias("w"), F.explode(F.sequence(F.lit(1), F.col("size") - 1)).alias("k")
    )
    left = F.array_join(F.slice("w", F.lit(1), F.col("k")), " ")
    right = F.array_join(F.slice("w", F.col("k") + 1, F.size("w")), " ")
    cuts = cuts.select("lang", "phrase", "a", "k", left.alias("left"), right.alias("right"))
    cuts = cuts.join(parts.select("lang", F.col("part").alias("left"), F.col("n").alias("l")), ["lang", "left"])
    cuts = cuts.join(parts.select("lang", F.col("part").alias("right"), F.col("n").alias("r")), ["lang", "right"])
    cut = F.struct(cut_score(F.col("a"), F.col("l"), F.col("r")).alias("score"), "k", "l", "r")
    best = cuts.groupBy("lang", "phrase", "a").agg(F.min(cut).alias("cut"))
    return best.select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score")


def not_inside(rows: DataFrame, phrases: DataFrame, longest: int = LONGEST, percent: int = INSIDE_PERCENT) -> DataFrame:
    """``rows (lang, phrase, a, …)`` without phrases inside a longer one of ``phrases`` that has
    ``percent`` of their occurrences."""

    def parts(n: int) -> Column:
        firsts = F.sequence(F.lit(1), F.col("size") - n + 1)
        each = F.transform(firsts, lambda i: F.array_join(F.slice("w", i, n), " "))
        return F.when(F.col("size") > n, each).otherwise(F.array().cast("array<string>"))

    if longest < 3:
        return rows
    inner = F.explode(F.concat(*[parts(n) for n in range(2, longest)])).alias("phrase")
    longer = phrases.where("size > 2").withColumn("w", F.split("phrase", " ")).select("lang", "n", inner)
    around = longer.groupBy("lang", "phrase").agg(F.max("n").alias("around"))
    joined = rows.join(around, ["lang", "phrase"], "left")
    return joined.where(F.col("around").isNull() | (100 * F.col("around") < percent * F.col("a"))).drop("around")


def top(rows: DataFrame, k: int = TOP) -> DataFrame:
    """The first ``k`` rows of each language, with their ``rank``. Each of PARTS parts ranks its
    own rows first, so the last step sees at most ``PARTS * k`` of a language."""
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    part = F.pmod(F.xxhash64("phrase"), F.lit(PARTS))
    split = rows.withColumn("_part", part)
    place = F.row_number().over(Window.partitionBy("lang", "_part").orderBy(*order))
    ahead = split.withColumn("rank", place).where(F.col("rank") <= k)
    last = F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")
    return ahead.drop("_part").withColumn("rank", last).where(F.col("rank") <= k)


def collocations(
    docs: DataFrame,
    text: str = "text",
    lang: str = "lang",
    support: int = SUPPORT,
    longest: int = LONGEST,
    shards: int = SHARDS,
    k: int = TOP,
) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score``: the first ``k`` phrases of each language."""
    words, phrases = frequent(docs, text, lang, support, longest, shards)
    left = not_inside(scored(words, phrases, longest), phrases, longest)
    sizes = words.groupBy("lang").agg(F.sum("n").alias("n"))
    ranked = top(left, k).join(sizes, "lang")
    return ranked.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
