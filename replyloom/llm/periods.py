"""Periodic runs of words, found with minimizers at many scales.

A run is a stretch of a text's words with smallest period ``q`` (words ``q`` apart are equal) that
holds at least ``repeats`` periods and ``least`` words and that no neighbouring word extends.

Periods up to ``SHORT`` are found by comparing the words with themselves ``q`` places on. Longer
ones belong to a scale: ``k`` words are hashed at every place, for periods above three quarters of
``k`` and up to ``k``. Two windows of such hashes that lie one period apart inside a run are equal
and so have equal minima, one period apart; as ``k`` words of a run recur at multiples of its
period only, these two are next to each other among the minima of one value. So the pairs of
neighbours of one value, at a distance of that scale, hold at least one pair of each run. Pairs are
then extended word by word in both directions, which decides alone what is a run: hashes can
bring pairs that fail, and lose none.

The texts of a batch are searched together, longest first, as one array of word numbers with a
different number between each two, so that a scale reads only texts that are long enough for it.

Defined results: a null, empty or blank text has no runs, no words and an empty rest; a text of
any length is searched whole, in memory of about 200 bytes a word; equal rows have equal results;
an empty table gives an empty one; columns are added last, and one of a name that is added is
replaced.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from replyloom.llm.common import join64, mix64

#: A run has this many words and periods at least.
LEAST, REPEATS = 24, 3
#: Periods up to here are found by direct comparison.
SHORT = 8
#: Words that are searched together, unless one text has more.
TOGETHER = 1 << 18
RUNS = "array<struct<start:bigint,length:bigint,period:bigint>>"
FOUND = f"struct<n_words:bigint,runs:{RUNS},collapsed:string>"

Run = tuple[int, int, int]


def _sliding(values: np.ndarray, width: int, pick: np.ufunc) -> np.ndarray:
    """The least or greatest of each ``width`` neighbours."""
    spread, done = values, 1
    while done * 2 <= width:
        spread = pick(spread[:-done], spread[done:])
        done *= 2
    rest = width - done
    return pick(spread[: len(spread) - rest], spread[rest:]) if rest else spread


def _stretches(places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First places and lengths of the stretches of consecutive numbers."""
    cuts = np.flatnonzero(np.diff(places) != 1)
    first = np.concatenate(([0], cuts + 1))
    last = np.concatenate((cuts, [len(places) - 1]))
    return places[first], last - first + 1


def _extended(x: np.ndarray, p: int, q: int) -> tuple[int, int]:
    """The longest stretch of places around ``p`` where the word ``q`` places on is the same."""
    start, end, n = p, p, len(x) - q
    step = 64
    while end < n:
        differ = x[end : min(end + step, n)] != x[end + q : min(end + step, n) + q]
        if differ.any():
            end += int(differ.argmax())
            break
        end, step = end + len(differ), step * 2
    step = 64
    while start > 0:
        low = max(start - step, 0)
        differ = (x[low:start] != x[low + q : start + q])[::-1]
        if differ.any():
            start -= int(differ.argmax())
            break
        start, step = low, step * 2
    return start, end


def scales(longest: int) -> Iterator[tuple[int, int]]:
    """``(low, k)``: the periods above ``low`` and up to ``k`` are found with ``k`` words."""
    low = SHORT
    while low < longest:
        k = max(low + 1, low * 4 // 3)
        yield low, k
        low = k


def _pairs(h: np.ndarray, low: int, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Places and distances of neighbouring equal minima of ``h``, the hashes of ``k`` words."""
    # Two windows one period apart have to fit into three periods, for the least period of the scale.
    width = min(2 * (low + 1) - k + 1, len(h))
    least = _sliding(h, width, np.minimum)
    edge = np.zeros(width - 1, np.uint64)
    greatest = _sliding(np.concatenate((edge, least, edge)), width, np.maximum)
    chosen = np.flatnonzero(greatest == h)
    value = h[chosen]
    order = np.argsort(value, kind="stable")
    chosen, value = chosen[order], value[order]
    distance = np.diff(chosen)
    pair = np.flatnonzero((value[1:] == value[:-1]) & (distance > low) & (distance <= k))
    return chosen[pair], distance[pair]


def _search(x: np.ndarray, upto: list[int], sizes: list[int], least: int, repeats: int) -> dict[tuple[int, int], int]:
    """Smallest period of each run in ``x``; the ``i``-th longest text ends before ``upto[i]``."""

    def long_enough(words: int) -> int:
        n = int(np.searchsorted(-np.asarray(sizes), -words, side="right"))
        return upto[n - 1] if n else 0

    found: dict[tuple[int, int], int] = {}

    def add(start: int, end: int, q: int) -> None:
        if end - start + q >= max(least, repeats * q):
            run = start, end + q
            found[run] = min(q, found.get(run, q))

    for q in range(1, SHORT + 1):
        need = max(least, repeats * q)
        end = long_enough(need)
        same = np.flatnonzero(x[: max(end - q, 0)] == x[q:end])
        if len(same):
            first, length = _stretches(same)
            for i in np.flatnonzero(length >= need - q).tolist():
                add(int(first[i]), int(first[i] + length[i]), q)

    power, hashes = 1, mix64(x.astype(np.uint64))
    for low, k in scales(sizes[0] // repeats if sizes else 0):
        end = long_enough(max(least, repeats * (low + 1)))
        while power * 2 <= k:
            hashes = join64(hashes[:-power], hashes[power:])
            power *= 2
        size = end - k + 1
        if size < 1:
            break
        h = join64(hashes[:size], hashes[k - power : k - power + size])
        places, distances = _pairs(h, low, k)
        seen, q = 0, 0
        for i in np.lexsort((places, distances)).tolist():
            p, d = int(places[i]), int(distances[i])
            if d == q and p < seen:
                continue  # in a stretch that is known
            start, seen = _extended(x, p, d)
            q = d
            add(start, seen, d)
    return found


def find_runs(texts: list[np.ndarray], least: int = LEAST, repeats: int = REPEATS) -> list[list[Run]]:
    """``(start, length, period)`` of the runs of each text, a text being an array of word numbers
    from 0 on; by start, then period. ``repeats`` is three or more."""
    if repeats < 3:
        raise ValueError("a run has three periods or more")
    found: list[list[Run]] = [[] for _ in texts]
    order = sorted((i for i, t in enumerate(texts) if len(t) >= least), key=lambda i: -len(texts[i]))
    if not order:
        return found
    sizes = [len(texts[i]) for i in order]
    upto = np.cumsum(np.asarray(sizes) + 1)
    parts = []
    for number, i in enumerate(order):
        parts += [texts[i].astype(np.int64), np.array([-1 - number])]
    runs = _search(np.concatenate(parts), upto.tolist(), sizes, least, repeats)
    for (start, end), q in runs.items():
        number = int(np.searchsorted(upto, start, side="right"))
        begin = int(upto[number]) - sizes[number] - 1
        found[order[number]].append((start - begin, end - start, q))
    for runs_of_text in found:
        runs_of_text.sort(key=lambda r: (r[0], r[2]))
    return found


def strongest(runs: list[Run]) -> Run | None:
    """The run of the greatest length in periods, exactly; the first of equal ones."""
    best = None
    for run in runs:
        if best is None or run[1] * best[2] > best[1] * run[2]:
            best = run
    return best


def kept_words(n: int, runs: list[Run]) -> np.ndarray:
    """Which of ``n`` words are in no run behind its first period."""
    kept = np.ones(n, bool)
    for start, length, q in runs:
        kept[start + q : start + length] = False
    return kept


def _batches(texts: list[bytes | None]) -> Iterator[list[list[bytes]]]:
    held, size = [], 0
    for text in texts:
        words = (text or b"").split()
        held.append(words)
        size += len(words)
        if size >= TOGETHER:
            yield held
            held, size = [], 0
    yield held


def collapse(column: Column, least: int = LEAST, repeats: int = REPEATS) -> Column:
    """:data:`FOUND` of a text: its words' number, its runs, and its words without the repeats."""

    @F.arrow_udf(FOUND)
    def found(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        from pyspark.sql.pandas.types import to_arrow_type

        arrow = to_arrow_type(found.returnType)
        for column in texts:
            rows = []
            for batch in _batches(column.to_pylist()):
                numbers: defaultdict[bytes, int] = defaultdict()
                numbers.default_factory = numbers.__len__
                coded = [np.fromiter(map(numbers.__getitem__, words), np.int64, len(words)) for words in batch]
                for words, runs in zip(batch, find_runs(coded, least, repeats), strict=True):
                    left = words
                    if runs:
                        left = [words[i] for i in np.flatnonzero(kept_words(len(words), runs)).tolist()]
                    listed = [{"start": s, "length": n, "period": q} for s, n, q in runs]
                    rows.append({"n_words": len(words), "runs": listed, "collapsed": b" ".join(left).decode("utf-8", "replace")})
            yield pa.array(rows, arrow)

    return found(column.cast("binary"))


def find_periods(df: DataFrame, text: str = "text", least: int = LEAST, repeats: int = REPEATS) -> DataFrame:
    """``df`` with ``n_words``, ``runs`` and ``collapsed`` of its texts (see :data:`FOUND`)."""
    names = [c for c in df.columns if c not in ("n_words", "runs", "collapsed")]
    found = collapse(F.col(text), least, repeats)
    return df.select(*names, found.alias("_found")).select(*names, "_found.*")


def strongest_run(runs: Column) -> Column:
    """The run of the greatest exact length in periods; of equal ones the first in order."""

    def better(a: Column, b: Column) -> Column:
        return F.when(b["length"] * a["period"] > a["length"] * b["period"], b).otherwise(a)

    return F.reduce(F.slice(runs, 2, F.size(runs)), F.try_element_at(runs, F.lit(1)), better)
