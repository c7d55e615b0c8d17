"""Token ids in seekable binary files: written in key order, read whole or document by document.

A file is a sequence of independent zstandard frames:

* data frames: the ids of all documents one after the other, little-endian and unsigned, of two
  bytes each where the vocabulary fits and else four; ``frame_ids`` ids a frame, so that a document
  may end inside one and a long one spans several;
* index frames: per document its key (eight bytes), whether it has one (one byte) and its number
  of ids (eight bytes), ``INDEX_ROWS`` documents a frame;
* a skippable frame with a JSON description (:data:`DESCRIPTION`);
* a seek table as in the zstandard seekable format, in a skippable frame at the end: compressed
  size, size and checksum (the lower half of XXH64 of the content) of every frame before it.

Any zstandard tool unpacks such a file; :class:`TokenFile` finds a document's frames by the table,
unpacks only those and checks them.

Rows are dealt to tasks by ranges of (key, hash of the text), sorted, encoded and written by one
task each, so texts cross the network once and their ids never. A task writes under temporary
names and renames a file when it is whole; which files count, and where each document starts,
stands in the table ``locations`` that Spark commits at the end. A task that is run again writes
the same bytes under the same names. Files are reached through ``pyarrow.fs``.

Defined results: null and blank texts have the end id only; null keys come first; rows of one key
are ordered by the hash of their text, so that only equal rows are interchangeable; all rows of one
key *and* text are one task's work; a text of any length is encoded and written in blocks; an empty
table gives no files and no rows; further columns are not stored.
"""

from __future__ import annotations

import json
import os
import re
import struct
import sys
import uuid
from array import array
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import numpy as np
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from replyloom.llm.common import SPACE_BYTES, map_rows
from replyloom.session import new_path

FRAME_IDS = 1 << 15
INDEX_ROWS = 1 << 14
#: A file is closed after so many ids, and a task gets about so many bytes of text.
FILE_IDS = 1 << 24
TASK_BYTES = 64 << 20
#: Texts are encoded in blocks of this many bytes; a task remembers the ids of so many words.
BLOCK, WORDS = 1 << 20, 1 << 20
LEVEL = 3

#: Lower-case letters up to U+00FF, which no normalization changes, and marks behind them.
LATIN_AND_MARKS = re.compile("([a-zß-öø-ÿ]+)([.,;:!?]*)")
#: Byte-level tokenizers write a byte as the letter of that number, and those that are no visible
#: letter, in their order, as the letters from 256 on.
_VISIBLE = {*range(33, 127), *range(161, 173), *range(174, 256)}
BYTE_LETTERS = {b: 256 + i for i, b in enumerate(sorted(set(range(256)) - _VISIBLE))}

SKIPPABLE, SEEK_TABLE, SEEK_END = 0x184D2A50, 0x184D2A5E, 0x8F92EAB1
INDEX_ROW = np.dtype([("key", "<i8"), ("known", "u1"), ("n", "<u8")])
DESCRIPTION = ("ids", "documents", "bytes_per_id", "data_frames", "index_frames")
LOCATIONS = "file string, key bigint, first bigint, n bigint"


def store_of(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(path) if re.match(r"\w+:/", path) else (fs.LocalFileSystem(), path)


# -- encoding -----------------------------------------------------------------------


@dataclass(frozen=True)
class Encoding:
    """A tokenizer file, the id that ends a document, and what its words may be cut at.

    With ``by_word`` a text is cut at ASCII white space and the ids of a word are remembered,
    which is right for tokenizers that drop white space and never look beyond it. With ``folds``
    ASCII letters are lower-cased before, so that there are fewer different words; marks behind
    Latin letters are encoded apart from them, and such letters go to the tokenizer's model as
    the one byte-level piece that they are: right for tokenizers that do all this themselves.
    Texts that may hold a special token, which begins with ``special``, are left as they are.
    """

    path: str
    end_id: int
    by_word: bool = True
    folds: bool = False
    special: bytes = b"<|"

    def open(self) -> Encoder:
        return Encoder(self)


class Known(dict):
    """Ids of words, found when a word is first asked for."""

    def __init__(self, find: Callable[[bytes], bytes]):
        self.find = find

    def __missing__(self, word: bytes) -> bytes:
        found = self[word] = self.find(word)
        return found


class Encoder:
    """Ids of texts, as little-endian bytes in blocks, the end id last."""

    def __init__(self, encoding: Encoding):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(encoding.path)
        highest = max(self.tokenizer.get_vocab_size(with_added_tokens=True) - 1, encoding.end_id)
        self.width = 2 if highest < 1 << 16 else 4
        self.kind = "H" if self.width == 2 else "I"
        self.end = self._bytes([encoding.end_id])
        self.encoding = encoding
        self.known = Known(self._word)

    def _bytes(self, ids: list[int]) -> bytes:
        packed = array(self.kind, ids)
        if sys.byteorder == "big":
            packed.byteswap()
        return packed.tobytes()

    def _folded(self, block: bytes) -> bytes:
        if not self.encoding.folds or self.encoding.special in block:
            return block
        return block.lower()

    def _encode(self, text: bytes) -> bytes:
        return self._bytes(self.tokenizer.encode(text.decode("utf-8", "replace"), add_special_tokens=False).ids)

    def _word(self, word: bytes) -> bytes:
        plain = self.encoding.folds and LATIN_AND_MARKS.fullmatch(word.decode("utf-8", "replace"))
        if not plain:
            return self._encode(word)
        letters, marks = plain.groups()
        if marks:
            return self.known[letters.encode()] + self.known[marks.encode()]
        piece = letters.encode().decode("latin-1").translate(BYTE_LETTERS)
        return self._bytes([t.id for t in self.tokenizer.model.tokenize(piece)])

    def __call__(self, text: bytes | None) -> Iterator[bytes]:
        by_word = self.encoding.by_word
        if not by_word:
            yield self._encode(text or b"")
        for block in blocks(text or b"") if by_word else ():
            if len(self.known) > WORDS:
                self.known.clear()
            yield b"".join(map(self.known.__getitem__, self._folded(block).split()))
        yield self.end


def blocks(text: bytes, size: int = BLOCK) -> Iterator[bytes]:
    """``text`` in parts of about ``size`` bytes, cut at white space only."""
    start = 0
    space = re.compile(b"[" + re.escape(SPACE_BYTES) + b"]")
    while len(text) - start > size:
        cut = space.search(text, start + size)
        if not cut:
            break
        yield text[start : cut.start()]
        start = cut.end()
    yield text[start:]


# -- one file -----------------------------------------------------------------------


class TokenFileWriter:
    """Writes one file to an open binary stream; :meth:`close` adds index, description and table."""

    def __init__(self, out, width: int, frame_ids: int = FRAME_IDS, level: int = LEVEL):
        import zstandard

        self.out, self.width, self.frame_bytes = out, width, frame_ids * width
        self.packer = zstandard.ZstdCompressor(level=level, write_checksum=True, write_content_size=True)
        self.held = bytearray()
        self.ids = 0
        self.index: list[tuple[int, int, int]] = []
        self.table: list[tuple[int, int, int]] = []

    def _frame(self, content: bytes) -> None:
        from xxhash import xxh64_intdigest

        packed = self.packer.compress(content)
        self.out.write(packed)
        self.table.append((len(packed), len(content), xxh64_intdigest(content) & 0xFFFFFFFF))

    def _skippable(self, magic: int, content: bytes) -> int:
        self.out.write(struct.pack("<II", magic, len(content)) + content)
        return 8 + len(content)

    def add(self, key: int | None, parts: Iterable[bytes]) -> tuple[int, int]:
        """Append a document; returns its first place and its number of ids."""
        first, size = self.ids, 0
        for part in parts:
            self.held += part
            size += len(part)
            while len(self.held) >= self.frame_bytes:
                self._frame(bytes(self.held[: self.frame_bytes]))
                del self.held[: self.frame_bytes]
        n = size // self.width
        self.index.append((key or 0, key is not None, n))
        self.ids += n
        return first, n

    def close(self) -> None:
        from xxhash import xxh64_intdigest

        if self.held:
            self._frame(bytes(self.held))
        data = len(self.table)
        for i in range(0, len(self.index), INDEX_ROWS):
            self._frame(np.array(self.index[i : i + INDEX_ROWS], INDEX_ROW).tobytes())
        said = dict(zip(DESCRIPTION, (self.ids, len(self.index), self.width, data, len(self.table) - data), strict=True))
        size = self._skippable(SKIPPABLE, json.dumps(said).encode())
        self.table.append((size, 0, xxh64_intdigest(b"") & 0xFFFFFFFF))
        entries = np.asarray(self.table, "<u4").tobytes()
        self._skippable(SEEK_TABLE, entries + struct.pack("<IBI", len(self.table), 0x80, SEEK_END))


class TokenFile:
    """Reads a file of :class:`TokenFileWriter` from a seekable binary stream."""

    def __init__(self, source):
        import zstandard

        self.source, self.unpacker = source, zstandard.ZstdDecompressor()
        self.frames_read = 0
        end = source.seek(0, 2)
        frames, flags, magic = struct.unpack("<IBI", self._at(end - 9, 9))
        if magic != SEEK_END or flags != 0x80:
            raise ValueError("no seek table with checksums at the end")
        start = end - 9 - 12 * frames
        if struct.unpack("<II", self._at(start - 8, 8)) != (SEEK_TABLE, 12 * frames + 9):
            raise ValueError("the seek table does not fit its frame")
        self.table = np.frombuffer(self._at(start, 12 * frames), "<u4").reshape(-1, 3).astype(np.int64)
        self.starts = np.concatenate(([0], np.cumsum(self.table[:, 0])))
        place, size = int(self.starts[-2]), int(self.table[-1, 0])
        said = json.loads(self._at(place + 8, size - 8))
        self.ids, self.documents, self.width, self.data_frames, self.index_frames = (said[k] for k in DESCRIPTION)
        self.offsets = np.concatenate(([0], np.cumsum(self.table[: self.data_frames, 1])))

    def _at(self, place: int, size: int) -> bytes:
        self.source.seek(place)
        return self.source.read(size)

    def frame(self, i: int) -> bytes:
        """The content of a frame, compared with its checksum."""
        from xxhash import xxh64_intdigest

        packed, size, checksum = self.table[i].tolist()
        content = self.unpacker.decompress(self._at(int(self.starts[i]), packed), max_output_size=size)
        if len(content) != size or xxh64_intdigest(content) & 0xFFFFFFFF != checksum:
            raise ValueError(f"frame {i} differs from its checksum")
        self.frames_read += 1
        return content

    def index(self) -> Iterator[tuple[int | None, int, int]]:
        """``key, first, n`` of every document in order."""
        first = 0
        for i in range(self.data_frames, self.data_frames + self.index_frames):
            for key, known, n in np.frombuffer(self.frame(i), INDEX_ROW).tolist():
                yield key if known else None, first, n
                first += n

    def read(self, wanted: Iterable[tuple[int, int]]) -> Iterator[np.ndarray]:
        """The ids at ``(first, n)``, ascending; a frame is unpacked once for neighbours."""
        at, content = -1, b""
        for first, n in wanted:
            low, high = first * self.width, (first + n) * self.width
            parts = []
            i = int(np.searchsorted(self.offsets, low, side="right")) - 1
            while low < high:
                if i != at:
                    at, content = i, self.frame(i)
                begin = int(self.offsets[i])
                part = content[low - begin : high - begin]
                parts.append(part)
                low += len(part)
                i += 1
            yield np.frombuffer(b"".join(parts), f"<u{self.width}")


# -- folders of files -----------------------------------------------------------------


def write(
    docs: DataFrame,
    folder: str,
    encoding: Encoding,
    key: str = "doc_id",
    text: str = "text",
    file_ids: int = FILE_IDS,
    frame_ids: int = FRAME_IDS,
    task_bytes: int = TASK_BYTES,
) -> DataFrame:
    """Encode ``text`` and write files under ``folder``; returns their :data:`LOCATIONS`."""

    def put(rows: Iterator[dict]) -> Iterator[tuple]:
        encoder = encoding.open()
        store, root = store_of(folder)
        store.create_dir(root, recursive=True)
        task, number, row = TaskContext.get().partitionId(), 0, next(rows, None)
        while row is not None:
            name = f"tokens-{task:08d}-{number:06d}.zst"
            temporary = f"{root}/.{name}.{uuid.uuid4().hex}"
            with store.open_output_stream(temporary, compression=None) as out:
                file = TokenFileWriter(out, encoder.width, frame_ids)
                while row is not None and file.ids < file_ids:
                    yield name, row["key"], *file.add(row["key"], encoder(row["text"]))
                    row = next(rows, None)
                file.close()
            store.move(temporary, f"{root}/{name}")
            number += 1

    rows = docs.select(
        F.col(key).cast("long").alias("key"),
        F.xxhash64(F.coalesce(F.col(text), F.lit(""))).alias("tie"),
        F.col(text).cast("binary").alias("text"),
    )
    size = rows.agg(F.sum(F.coalesce(F.length("text"), F.lit(0)) + 64)).first()[0] or 0
    ordered = rows.repartitionByRange(size // task_bytes + 1, F.col("key").asc_nulls_first(), "tie")
    ordered = ordered.sortWithinPartitions(F.col("key").asc_nulls_first(), "tie").select("key", "text")
    map_rows(ordered, put, LOCATIONS).write.parquet(f"{folder}/locations")
    return locations(docs.sparkSession, folder)


def locations(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.schema(LOCATIONS).parquet(f"{folder}/locations")


def manifest(spark: SparkSession, folder: str) -> DataFrame:
    """``file, number, documents, ids, start`` of the files that count; ``start`` is the number of
    ids in the files before. Windows see one row per file."""
    files = locations(spark, folder).groupBy("file").agg(F.count("*").alias("documents"), F.sum("n").alias("ids"))
    order = Window.orderBy("file")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    return files.select(
        "file",
        (F.row_number().over(order) - 1).alias("number"),
        "documents",
        "ids",
        F.coalesce(F.sum("ids").over(before), F.lit(0)).alias("start"),
    )


FOUND = "file string, key bigint, start bigint, n bigint, ids binary"


def read(spark: SparkSession, folder: str) -> DataFrame:
    """``file, key, start, n, ids`` of every document, from the files alone: ``start`` counts the
    ids of all documents before, ``ids`` are unsigned numbers of four little-endian bytes.

    One task reads a file, frame by frame. Files that differ from the manifest fail the job.
    """

    def parse(rows: Iterator[dict]) -> Iterator[tuple]:
        store, root = store_of(folder)
        for row in rows:
            with store.open_input_file(f"{root}/{row['file']}") as source:
                file = TokenFile(source)
                if (file.ids, file.documents) != (row["ids"], row["documents"]):
                    raise ValueError(f"{row['file']} differs from the manifest")
                index = list(file.index())
                found = file.read((first, n) for _, first, n in index)
                for (key, first, n), ids in zip(index, found, strict=True):
                    yield row["file"], key, row["start"] + first, n, ids.astype("<u4").tobytes()

    files = manifest(spark, folder)
    count = locations(spark, folder).agg(F.count_distinct("file")).first()[0]
    dealt = files.repartitionById(max(count, 1), F.col("number").cast("int"))
    return map_rows(dealt, parse, FOUND)


def fetch(folder: str, wanted: DataFrame, key: str = "doc_id") -> DataFrame:
    """``file, key, start, n, ids`` of the documents whose keys stand in ``wanted``, as :func:`read`
    gives them, unpacking only the frames that hold them. A null key finds nothing."""
    spark = wanted.sparkSession
    keys = wanted.select(F.col(key).cast("long").alias("key")).distinct()
    starts = manifest(spark, folder).select("file", "start")
    places = locations(spark, folder).join(keys, "key").join(starts, "file")

    def parse(rows: Iterator[dict]) -> Iterator[tuple]:
        store, root = store_of(folder)
        name, source, file = None, None, None
        try:
            for row in rows:
                if row["file"] != name:
                    if source:
                        source.close()
                    name, source = row["file"], store.open_input_file(f"{root}/{row['file']}")
                    file = TokenFile(source)
                ids = next(file.read([(row["first"], row["n"])]))
                yield name, row["key"], row["start"] + row["first"], row["n"], ids.astype("<u4").tobytes()
        finally:
            if source:
                source.close()

    return map_rows(places.repartition("file").sortWithinPartitions("file", "first"), parse, FOUND)


def round_trip(docs: DataFrame, encoding: Encoding, **options) -> DataFrame:
    """Write ``docs`` to a new folder in the shared one, and what reading it back gives."""
    folder = new_path(docs.sparkSession, "tokens")
    write(docs, folder, encoding, **options)
    return read(docs.sparkSession, folder)
