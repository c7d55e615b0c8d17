"""Suffix-array dedup: bytes covered by a string of ``length`` bytes that starts elsewhere, too.

A window of ``length`` bytes has as its anchor the run of :data:`GRAM` bytes in it with the
smallest hash (the leftmost of those). Equal windows have equal anchors at the same place in
them, so only windows under equal anchors need comparing. The bytes of all windows under one
anchor are its context. Anchors that occur once are done with; contexts that occur twice, by
128 bits of hash, repeat whole. What is left are the edges of repeated passages: contexts that
are alike in part. Each different one is sent, once, to the shard of its anchor, where a suffix
array by induced sorting and permuted common prefixes tell which windows repeat.

An anchor with more than :data:`HOT` different contexts (the edge of a passage that very many
texts share) would make a shard of unbounded size. These contexts are compared by 128 bits of hash
instead, with counts added up before the shuffle; this is as complete. Blocks of neighbouring
windows come first: blocks that occur again repeat whole, and a block whose windows share bytes
that no other block of its place has repeats nowhere. Only the windows of the others, once of
each different block, are rows of their own.

Texts travel compressed, and twice: to cut contexts and to take the repeats out. Rows are named
by 80 bits of hash of key and text.

Defined results: strings are judged on the input and may overlap, within one text, too; a null
text is empty; texts shorter than ``length`` keep everything; rows that repeat key and text are
texts of their own, so they repeat each other; an empty table gives no rows; further columns are
not read. Removal may cut a UTF-8 character, so what is kept is bytes.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from replyloom.llm.common import map_rows
from replyloom.llm.suffixes import common_prefixes, suffix_array
from replyloom.session import materialize

LENGTH = 200
GRAM = 40
HOT = 2000
SHARD_BYTES = 1 << 20
#: Positions of a piece fit into 20 bits beside 44 bits of hash.
PIECE = 1 << 16


class Rolling:
    """Hashes of all substrings of one piece: differences of running sums of powers."""

    def __init__(self, seed: int, size: int):
        random = np.random.default_rng(seed)
        self.values = random.integers(0, 1 << 63, 256, np.uint64) * np.uint64(2) + np.uint64(1)
        base = int(random.integers(0, 1 << 62)) * 4 + 3
        inverse = pow(base, -1, 1 << 64)
        self.powers = np.cumprod(np.full(size, base, np.uint64))
        self.inverses = np.cumprod(np.full(size, inverse, np.uint64))

    def sums(self, piece: np.ndarray) -> np.ndarray:
        out = np.zeros(len(piece) + 1, np.uint64)
        np.cumsum(self.values[piece] * self.powers[: len(piece)], out=out[1:])
        return out

    def hashes(self, sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        h = (sums[ends] - sums[starts]) * self.inverses[starts]
        h ^= h >> np.uint64(32)
        h *= np.uint64(0x9FB21C651E98DF25)
        return h ^ (h >> np.uint64(29))


_ROLLING: dict[int, Rolling] = {}


def rolling(seed: int) -> Rolling:
    if seed not in _ROLLING:
        _ROLLING[seed] = Rolling(seed, PIECE + 4096)
    return _ROLLING[seed]


def sliding_minimum(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` values in a row, by running minima of blocks."""
    n = len(values)
    rows = -(-n // width)
    blocks = np.full(rows * width, np.iinfo(values.dtype).max, values.dtype)
    blocks[:n] = values
    blocks = blocks.reshape(rows, width)
    forward = np.minimum.accumulate(blocks, axis=1).ravel()
    backward = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(backward[: n - width + 1], forward[width - 1 : n])


def anchor_place(window: np.ndarray, gram: int) -> int:
    """Where the anchor of a window starts in it, as :func:`anchors` has it."""
    at = np.arange(len(window) - gram + 1)
    one = rolling(1)
    return int(np.argmin(one.hashes(one.sums(window), at, at + gram) >> np.uint64(20)))


def anchors(text: bytes, length: int, gram: int) -> Iterator[tuple[np.ndarray, ...]]:
    """``(anchor, context hash, first window, windows)`` arrays, piece by piece."""
    data = np.frombuffer(text, np.uint8)
    one, two = rolling(1), rolling(2)
    low = np.uint64((1 << 20) - 1)
    for base in range(0, len(data) - length + 1, PIECE):
        piece = data[base : base + PIECE + length - 1]
        at = np.arange(len(piece) - gram + 1)
        h = one.hashes(one.sums(piece), at, at + gram)
        least = sliding_minimum((h & ~low) | at.astype(np.uint64), length - gram + 1)
        place = (least & low).astype(np.int64)
        first = np.flatnonzero(np.diff(place, prepend=-1))
        windows = np.diff(first, append=len(place))
        context = two.hashes(two.sums(piece), first, first + windows + length - 1)
        # The place of the anchor in its context is part of what must agree.
        context ^= (place[first] - first).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        yield h[place[first]].view(np.int64), context.view(np.int64), base + first, windows


def named(docs: DataFrame, key: str, text: str) -> DataFrame:
    """``k, k2`` (name of the row), ``key`` and ``text`` as bytes."""
    content = F.coalesce(F.col(text), F.lit("")).cast("binary")
    return docs.select(
        F.xxhash64(F.col(key), content).alias("k"),
        F.xxhash64(content, F.col(key)).bitwiseAND(F.lit(0xFFFF)).alias("k2"),
        F.col(key).alias("key"),
        content.alias("text"),
    )


def packed(rows: DataFrame) -> DataFrame:
    """``named`` rows with the text compressed, as it travels."""
    kind = dict(rows.dtypes)["key"]

    def pack(rows: Iterator[dict]) -> Iterator[tuple]:
        compress = zstandard.ZstdCompressor(level=1).compress
        for row in rows:
            yield row["k"], row["k2"], row["key"], compress(row["text"])

    return map_rows(rows, pack, f"k bigint, k2 bigint, key {kind}, packed binary")


def all_anchors(rows: DataFrame, length: int, gram: int) -> DataFrame:
    """``k, k2, anchor, context, place`` of every anchor; place holds first window and count."""
    schema = pa.schema([(c, pa.int64()) for c in ("k", "k2", "anchor", "context", "place")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, batch.num_rows, 256):
                columns: list[list[np.ndarray]] = [[] for _ in range(5)]
                for row in batch.slice(i, 256).to_pylist():
                    for anchor, context, first, windows in anchors(row["text"], length, gram):
                        n = len(anchor)
                        for column, values in zip(
                            columns,
                            (np.full(n, row["k"]), np.full(n, row["k2"]), anchor, context, first << 16 | windows),
                            strict=True,
                        ):
                            column.append(values)
                if columns[0]:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.concatenate(c), pa.int64()) for c in columns], schema=schema
                    )

    return rows.select("k", "k2", "text").mapInArrow(
        run, "k bigint, k2 bigint, anchor bigint, context bigint, place bigint"
    )


def spans_of(agree: np.ndarray, first: int, length: int) -> Iterator[tuple[int, int]]:
    """Byte spans covered by the windows that agree, from consecutive windows' flags."""
    edges = np.flatnonzero(np.diff(agree.astype(np.int8), prepend=0, append=0))
    for start, stop in edges.reshape(-1, 2).tolist():
        yield first + start, first + stop - 1 + length


def repeated_spans(
    docs: DataFrame, length: int = LENGTH, gram: int = GRAM, hot: int = HOT, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """``k, k2, start, end``: byte spans of named rows that repeat; spans may overlap."""
    rows = named(docs, key, text)
    found = materialize(all_anchors(rows, length, gram), "anchors")
    again = found.groupBy("anchor").count().where("count > 1").select("anchor")
    shared = materialize(found.join(again, "anchor"), "shared")
    contexts = materialize(
        shared.groupBy("anchor", "context").agg(
            F.count("*").alias("n"), F.min(F.struct("k", "k2", "place")).alias("one")
        ),
        "contexts",
    )
    first, windows = F.shiftright("place", 16), F.col("place").bitwiseAND(F.lit(0xFFFF))
    whole = shared.join(contexts.where("n > 1").select("anchor", "context"), ["anchor", "context"]).select(
        "k", "k2", first.alias("start"), (first + windows - 1 + length).alias("end")
    )
    return whole.union(edge_spans(rows, contexts, length, gram, hot))


def edge_spans(rows: DataFrame, contexts: DataFrame, length: int, gram: int, hot: int) -> DataFrame:
    """Spans in contexts that occur once but may share windows with others of their anchor."""
    many = contexts.groupBy("anchor").agg(F.count("*").alias("contexts")).where("contexts > 1")
    open_ones = contexts.join(many, "anchor").select(
        "one.k",
        "one.k2",
        F.struct(
            "anchor",
            F.col("one.place").alias("place"),
            (F.col("n") == 1).alias("single"),
            (F.col("contexts") > hot).alias("hot"),
        ).alias("want"),
    )
    open_ones = materialize(open_ones, "open")
    wanted = open_ones.groupBy("k", "k2").agg(F.collect_list("want").alias("wants"))
    joined = packed(rows).join(wanted, ["k", "k2"]).select("k", "k2", "packed", "wants")
    schema = "k bigint, k2 bigint, anchor bigint, first bigint, single boolean, hot boolean, bytes binary"

    def cut(rows: Iterator[dict]) -> Iterator[tuple]:
        for row in rows:
            text = zstandard.decompress(row["packed"])
            for want in row["wants"]:
                first, windows = want["place"] >> 16, want["place"] & 0xFFFF
                data = text[first : first + windows - 1 + length]
                yield row["k"], row["k2"], want["anchor"], first, want["single"], want["hot"], data

    cuts = materialize(map_rows(joined, cut, schema), "cuts")
    size = cuts.where("not hot").agg(F.sum(F.length("bytes"))).first()[0] or 0
    shard = F.pmod(F.xxhash64("anchor"), F.lit(size // SHARD_BYTES + 1)).alias("shard")
    result = "k bigint, k2 bigint, start bigint, end bigint"

    def search(shard: pd.DataFrame) -> pd.DataFrame:
        return shard_spans(shard, length)

    cold = (
        cuts.where("not hot").select(shard, "k", "k2", "first", "single", "bytes")
        .groupBy("shard").applyInPandas(search, result)
    )

    return cold.union(hot_spans(cuts.where("hot"), length, gram))


def hot_spans(cuts: DataFrame, length: int, gram: int) -> DataFrame:
    """Spans of single contexts of anchors that very many contexts have, by hashes alone."""
    blocks = materialize(hot_blocks(cuts, length, gram), "blocks")
    alike = ["common1", "common2", "whole1", "whole2"]
    different = materialize(
        blocks.groupBy(*alike).agg(
            F.count("*").alias("n"), F.min(F.struct("k", "k2", "first", "start", "windows", "single")).alias("one")
        ),
        "different-blocks",
    )
    end = (F.col("start") + F.col("windows") - 1 + length).alias("end")
    again = different.where("n > 1").select(*alike)
    whole = blocks.where("single").join(again, alike).select("k", "k2", "start", end)
    windows = materialize(open_windows(cuts, different, length), "windows")
    twice = windows.groupBy("w1", "w2").count().where("count > 1").select("w1", "w2")
    parts = windows.where("single").join(twice, ["w1", "w2"])
    return whole.union(parts.select("k", "k2", "start", (F.col("start") + length).alias("end")))


def hot_blocks(cuts: DataFrame, length: int, gram: int) -> DataFrame:
    """Windows of contexts in blocks, with 128 bits of hash of the bytes that all windows of such a
    block have in ``common`` and of all its bytes here (``whole``).

    Blocks are cut by the place of the anchor in a window, so equal windows are in blocks of equal
    place, and these have the same bytes in common."""
    size = math.isqrt(length - gram) + 1
    schema = (
        "common1 bigint, common2 bigint, whole1 bigint, whole2 bigint, "
        "k bigint, k2 bigint, first bigint, start bigint, windows int, single boolean"
    )

    def blocks(rows: Iterator[dict]) -> Iterator[tuple]:
        both = rolling(3), rolling(4)
        for row in rows:
            data = np.frombuffer(row["bytes"], np.uint8)
            anchor = anchor_place(data[:length], gram)
            # The anchor's place in each window, and the first and last window of each block.
            place = anchor - np.arange(len(data) - length + 1)
            block = place // size
            first = np.flatnonzero(np.diff(block, prepend=-1))
            stop = np.append(first[1:], len(place))
            low = anchor - block[first] * size
            sums = [r.sums(data) for r in both]
            hashes = [r.hashes(x, low, low - size + 1 + length) for r, x in zip(both, sums, strict=True)]
            hashes += [r.hashes(x, first, stop - 1 + length) for r, x in zip(both, sums, strict=True)]
            hashes[0] ^= block[first].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
            found = [h.view(np.int64).tolist() for h in hashes]
            for *names, i, j in zip(*found, first.tolist(), stop.tolist(), strict=True):
                yield *names, row["k"], row["k2"], row["first"], row["first"] + i, j - i, row["single"]

    return map_rows(cuts.select("k", "k2", "first", "single", "bytes"), blocks, schema)


def open_windows(cuts: DataFrame, different: DataFrame, length: int) -> DataFrame:
    """Windows of one of each different block, for blocks that agree with others in part. Those of
    blocks that occur once in a single context are ``single``."""
    several = different.groupBy("common1", "common2").count().where("count > 1").select("common1", "common2")
    want = F.struct("one.start", "one.windows", (F.col("one.single") & (F.col("n") == 1)).alias("single"))
    wanted = different.join(several, ["common1", "common2"]).groupBy("one.k", "one.k2", "one.first")
    joined = cuts.select("k", "k2", "first", "bytes").join(wanted.agg(F.collect_list(want).alias("wants")), ["k", "k2", "first"])

    def windows(rows: Iterator[dict]) -> Iterator[tuple]:
        one, two = rolling(3), rolling(4)
        for row in rows:
            data = np.frombuffer(row["bytes"], np.uint8)
            sums = one.sums(data), two.sums(data)
            for want in row["wants"]:
                at = want["start"] - row["first"] + np.arange(want["windows"])
                w1 = one.hashes(sums[0], at, at + length).view(np.int64).tolist()
                w2 = two.hashes(sums[1], at, at + length).view(np.int64).tolist()
                for i, (a, b) in enumerate(zip(w1, w2, strict=True)):
                    yield a, b, row["k"], row["k2"], want["start"] + i, want["single"]

    schema = "w1 bigint, w2 bigint, k bigint, k2 bigint, start bigint, single boolean"
    return map_rows(joined, windows, schema)


def shard_spans(shard: pd.DataFrame, length: int) -> pd.DataFrame:
    """Spans of single contexts whose windows occur again in the shard."""
    parts = [np.frombuffer(data, np.uint8).astype(np.int16) + 1 for data in shard["bytes"]]
    sizes = np.array([len(p) + 1 for p in parts])
    offsets = np.cumsum(sizes) - sizes
    # Contexts end with a symbol that no byte has; the whole ends with a smaller one.
    joined = np.full(int(sizes.sum()) + 1, 257, np.int16)
    joined[-1] = 0
    for part, offset in zip(parts, offsets.tolist(), strict=True):
        joined[offset : offset + len(part)] = part
    order = suffix_array(joined, length)
    single = np.flatnonzero(shard["single"].to_numpy(bool))
    counts = sizes[single] - length
    at = np.repeat(offsets[single] - (np.cumsum(counts) - counts), counts) + np.arange(counts.sum())
    agree = common_prefixes(joined, order, at, length)
    out, done = [], 0
    names = shard[["k", "k2", "first"]].to_numpy(np.int64)[single].tolist()
    for (k, k2, first), n in zip(names, counts.tolist(), strict=True):
        out += [(k, k2, *span) for span in spans_of(agree[done : done + n], first, length)]
        done += n
    return pd.DataFrame(out, columns=["k", "k2", "start", "end"], dtype=np.int64)


def drop_repeats(docs: DataFrame, key: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """``key, n_bytes, n_removed, n_spans, kept`` (bytes) of every row of ``docs``."""
    rows = named(docs, key, text)
    kind = dict(docs.dtypes)[key]
    spans = repeated_spans(docs, key=key, text=text, **options)
    by_row = spans.groupBy("k", "k2").agg(F.collect_set(F.struct("start", "end")).alias("spans"))
    joined = packed(rows).join(by_row, ["k", "k2"], "left").select("key", "packed", "spans")

    def remove(rows: Iterator[dict]) -> Iterator[tuple]:
        for row in rows:
            content = zstandard.decompress(row["packed"])
            kept, end, n = [], 0, 0
            for span in sorted(row["spans"] or [], key=lambda s: (s["start"], s["end"])):
                if span["start"] > end or not n:
                    kept.append(content[end : span["start"]])
                    n += 1
                end = max(end, span["end"])
            kept.append(content[end:])
            left = b"".join(kept)
            yield row["key"], len(content), len(content) - len(left), n, left

    return map_rows(
        joined, remove, f"`{key}` {kind}, n_bytes bigint, n_removed bigint, n_spans bigint, kept binary"
    )
