"""Runs of periodically repeated words, by the branching-tandem test on an enhanced suffix array."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rareflow.llm.common import text_of

MIN_EXPONENT = 4
MIN_WORDS = 6
#: Words whose suffixes are sorted together; a longer text is sorted on its own.
BLOCK_WORDS = 200_000
#: Suffixes of smaller children that are tested together.
TESTED = 1_000_000
WORD = r"[^\x20\x09-\x0D]+"


def _heads(keys: np.ndarray) -> np.ndarray:
    """True where a value differs from the one before."""
    found = np.ones(len(keys), dtype=bool)
    found[1:] = keys[1:] != keys[:-1]
    return found


def _ragged(starts: np.ndarray, widths: np.ndarray) -> np.ndarray:
    """The numbers start..start+width-1 of each pair, one after the other."""
    ends = np.cumsum(widths)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - ends + widths, widths)


class SuffixArray:
    """Sorted suffixes of several texts of word numbers, none of which reaches into the next text.

    ``order`` has the places by suffix, text by text; ``place`` is its inverse; ``lcp[k]`` is the number of words that the
    suffixes k - 1 and k share. ``ranks[m]`` tells strings of 2^m words apart. A suffix that is unique is not sorted any further.
    """

    def __init__(self, words: np.ndarray, text: np.ndarray, end: np.ndarray) -> None:
        n = len(words)
        self.end, every = end, np.arange(n)
        width = int(words.max()) + 2
        following = np.zeros(n, dtype=np.int64)
        following[:-1] = np.where(every[:-1] + 1 < end[:-1], words[1:] + 1, 0)
        one = text * width + words
        key = one * width + following
        order = np.argsort(key, kind="stable")
        head = _heads(key[order])
        rank = np.empty(n, dtype=np.int64)
        rank[order] = np.maximum.accumulate(np.where(head, every, 0))
        self.ranks = [one, rank]
        apart = np.where(head, 0, -1)  # the stage that told a suffix from the one before
        while len(slots := np.flatnonzero(~(head & np.append(head[1:], True)))):
            mine = order[slots]
            later = mine + (1 << (len(self.ranks) - 1))
            second = np.where(later < end[mine], rank[np.minimum(later, n - 1)] + 1, 0)
            key = rank[mine] * (n + 1) + second
            by_key = np.argsort(key, kind="stable")
            mine = order[slots] = mine[by_key]
            fresh = _heads(key[by_key])
            apart[slots[fresh & ~head[slots]]] = len(self.ranks) - 1
            head[slots] = fresh
            rank = rank.copy()
            rank[mine] = np.maximum.accumulate(np.where(fresh, slots, 0))
            self.ranks.append(rank)
        self.order, self.place = order, np.empty(n, dtype=np.int64)
        self.place[order] = every
        self.lcp = self._shared(apart)

    def _shared(self, apart: np.ndarray) -> np.ndarray:
        """Words shared by neighbours, from the stage that parted them down to single words."""
        found = np.where(apart > 0, 1 << np.maximum(apart, 0), 0)
        found[0] = 0
        left, right = np.append(self.order[:1], self.order[:-1]), self.order
        for m in reversed(range(max(1, int(apart.max())))):
            at = np.flatnonzero((apart > m) | ((apart == 0) & (m == 0)))
            at = at[at > 0]
            i, j = left[at] + found[at], right[at] + found[at]
            there = (i < self.end[left[at]]) & (j < self.end[right[at]])
            i, j, at = i[there], j[there], at[there]
            same = self.ranks[m][i] == self.ranks[m][j]
            found[at[same]] += 1 << m
        return found

    def shared_before(self, i: np.ndarray, j: np.ndarray, start: np.ndarray) -> np.ndarray:
        """Words that are equal before the places i and j > i, from the nearest on, of texts that begin at ``start``."""
        found = np.zeros(len(i), dtype=np.int64)
        for m in reversed(range(len(self.ranks))):
            a, b = i - found - (1 << m), j - found - (1 << m)
            at = np.flatnonzero(a >= start)
            same = self.ranks[m][a[at]] == self.ranks[m][b[at]]
            found[at[same]] += 1 << m
        return found

    def intervals(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each k in ``at``: the widest first <= k - 1 and last (exclusive) whose suffixes share ``lcp[k]`` words."""
        return self._reach(at, -1), self._reach(at, 1)

    def _reach(self, at: np.ndarray, step: int) -> np.ndarray:
        """Where the values stop being at least ``lcp[at]``, going left or right in doubling steps over range minima."""
        lows, wanted = [self.lcp], self.lcp[at]
        edge = at.copy() if step < 0 else at + 1
        n, level, moving = len(self.lcp), np.zeros(len(at), dtype=np.int64), np.arange(len(at))

        def whole(rows, m):
            width = 1 << m
            a = edge[rows] - width if step < 0 else edge[rows]
            fits = (a >= 0) & (a + width <= n)
            fits[fits] = lows[m][a[fits]] >= wanted[rows[fits]]
            return fits

        m = 0
        while len(moving):
            if m == len(lows):
                low, half = lows[-1], 1 << (m - 1)
                if len(low) <= half:
                    break
                lows.append(np.minimum(low[:-half], low[half:]))
            fits = whole(moving, m)
            moving = moving[fits]
            edge[moving] += step << m
            m += 1
            level[moving] = m
        for m in reversed(range(int(level.max()) if len(level) else 0)):
            rows = np.flatnonzero(level > m)
            rows = rows[whole(rows, m)]
            edge[rows] += step << m
        return edge - 1 if step < 0 else edge


def branching_squares(array: SuffixArray, start: np.ndarray, min_exponent: int, min_words: int) -> tuple[np.ndarray, np.ndarray]:
    """Places i and periods q whose 2q words are a square that does not go on: the suffixes i and i + q share q words exactly.

    Both then lie in the interval of depth q, below different children. Every suffix of all children but the largest looks
    whether the place q before or behind it is in the interval as well, so a suffix is tested a logarithmic number of
    times. A run of exponent e has e occurrences of its last period, so smaller intervals are left out.
    """
    at = np.flatnonzero(array.lcp > 0)
    first, last = array.intervals(at)
    depth = array.lcp[at]
    least = np.maximum(min_exponent, min_words // depth)
    wide = last - first >= least
    at, first, last, depth = at[wide], first[wide], last[wide], depth[wide]
    if not len(at):
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
    # the children of an interval begin at its first suffix and at each k with its depth
    by_interval = np.lexsort((at, depth, first))
    at, first, last, depth = at[by_interval], first[by_interval], last[by_interval], depth[by_interval]
    fresh = _heads(first) | _heads(depth)
    number = np.cumsum(fresh) - 1
    opens = np.flatnonzero(fresh)
    child = np.concatenate([at, first[opens]])
    of = np.concatenate([number, np.arange(len(opens))])
    by_child = np.lexsort((child, of))
    child, of = child[by_child], of[by_child]
    ends = np.append(child[1:], 0)
    closing = np.append(of[1:] != of[:-1], True)
    ends[closing] = last[opens][of[closing]]
    size = ends - child
    largest = np.lexsort((-size, of))
    smaller = np.ones(len(child), dtype=bool)
    smaller[largest[_heads(of[largest])]] = False
    child, ends, size, of = child[smaller], ends[smaller], size[smaller], of[smaller]
    low, high, depth = first[opens][of], last[opens][of], depth[opens][of]
    places, periods = [], []
    cuts = np.searchsorted(np.cumsum(size), np.arange(TESTED, int(size.sum()) + TESTED, TESTED), side="left") + 1
    a = 0
    for z in np.minimum(cuts, len(size)).tolist():
        part, a = slice(a, z), z
        row = np.repeat(np.arange(part.start, z), size[part])
        i, q = array.order[_ragged(child[part], size[part])], depth[row]
        for other, lead in ((i + q, 0), (i - q, 1)):
            inside = np.flatnonzero((other >= start[i]) & (other < array.end[i]))
            there = array.place[other[inside]]
            r = row[inside]
            hit = (there >= low[r]) & (there < high[r]) & ((there < child[r]) | (there >= ends[r]))
            hit = inside[hit]
            places.append(i[hit] - lead * q[hit])
            periods.append(q[hit])
    return np.concatenate(places), np.concatenate(periods)


def runs_of(
    words: np.ndarray, lengths: np.ndarray, min_exponent: int = MIN_EXPONENT, min_words: int = MIN_WORDS
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """``(text, start, length, period)`` of the runs of several texts of word numbers that stand one after the other.

    Squares that branch are rotated to the left as long as they stay squares, in doubling steps; where they come to rest
    they make a run. A run found with several periods keeps the smallest, of which the others are multiples.
    """
    none = (np.zeros(0, dtype=np.int64),) * 4
    if not len(words):
        return none
    text = np.repeat(np.arange(len(lengths)), lengths)
    ends = np.cumsum(lengths)
    start = (ends - lengths)[text]
    array = SuffixArray(words, text, ends[text])
    place, period = branching_squares(array, start, min_exponent, min_words)
    first = place - array.shared_before(place, place + period, start[place])
    last = place + 2 * period
    long = last - first >= np.maximum(min_words, min_exponent * period)
    first, last, period = first[long], last[long], period[long]
    order = np.lexsort((period, last, first))
    first, last, period = first[order], last[order], period[order]
    one = _heads(first) | _heads(last)
    first, last, period = first[one], last[one], period[one]
    order = np.lexsort((period, first))
    first, last, period = first[order], last[order], period[order]
    return text[first], first - start[first], last - first, period


def _strongest(runs: list[tuple[int, int, int]]) -> tuple[int, int, int] | None:
    """The run with the most repeats, of equal ones the first, then the one of the smaller period."""
    best = None
    for run in runs:  # by start and period, so only a greater exponent takes the place
        if best is None or run[1] * best[2] > best[1] * run[2]:
            best = run
    return best


RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
FOUND = pa.struct([("n_words", pa.int64()), ("runs", pa.list_(RUN)), ("strongest", RUN), ("collapsed", pa.string())])


def _blocks(texts: Iterable[list[bytes]]) -> Iterator[list[list[bytes]]]:
    """Texts of ``BLOCK_WORDS`` words together, or one longer text."""
    block, held = [], 0
    for words in texts:
        if block and held + len(words) > BLOCK_WORDS:
            yield block
            block, held = [], 0
        block.append(words)
        held += len(words)
    if block:
        yield block


def _found(texts: Iterable[list[bytes]], min_exponent: int, min_words: int) -> Iterator[dict]:
    """For each text of words its runs and what is left of it, in blocks of texts."""
    for block in _blocks(texts):
        lengths = np.array([len(w) for w in block], dtype=np.int64)
        flat = np.empty(int(lengths.sum()), dtype=object)
        flat[:] = [w for words in block for w in words]
        numbers = pd.factorize(flat)[0].astype(np.int64)
        text, start, length, period = runs_of(numbers, lengths, min_exponent, min_words)
        cuts = np.searchsorted(text, np.arange(len(block) + 1)).tolist()
        triples = list(zip(start.tolist(), length.tolist(), period.tolist()))
        for words, a, z in zip(block, cuts, cuts[1:]):
            runs = triples[a:z]
            if runs:
                gone = np.zeros(len(words) + 1, dtype=np.int64)
                np.add.at(gone, start[a:z] + period[a:z], 1)
                np.add.at(gone, start[a:z] + length[a:z], -1)
                kept = (np.cumsum(gone)[:-1] == 0).tolist()
                left = [w for w, k in zip(words, kept) if k]
            else:
                left = words
            yield {"n_words": len(words), "runs": runs, "strongest": _strongest(runs), "collapsed": b" ".join(left)}


def _as_runs(runs: list) -> pa.Array:
    columns = [pa.array([None if r is None else r[k] for r in runs], pa.int64()) for k in range(3)]
    return pa.StructArray.from_arrays(columns, fields=list(RUN), mask=pa.array([r is None for r in runs], pa.bool_()))


def with_runs(
    docs: DataFrame, column: str = "found", text: Column | None = None, min_exponent: int = MIN_EXPONENT, min_words: int = MIN_WORDS
) -> DataFrame:
    """``docs`` with a struct ``n_words, runs, strongest, collapsed`` of each whole text (or of the column ``text``) added.

    A run is a stretch of words (between white space) with smallest period q and at least ``max(min_words, min_exponent * q)``
    words that no neighbouring word extends. ``runs`` has all of them by start and period, ``strongest`` the one with the greatest
    length / period (ties: smallest start, then period; null without a run), ``collapsed`` the words, joined by one space,
    that no run contains after its first q words.

    Every row is judged by itself, so nothing is shuffled and repeated rows get equal results; a null or empty text has no words, no
    runs and an empty ``collapsed``; an empty table stays empty; all columns of ``docs`` stay, and a ``column`` that it has already is an
    error. A text of n words needs memory for n log n numbers in its task, where the logarithm is that of its longest repeat.
    """
    if column.lower() in {c.lower() for c in docs.columns}:
        raise ValueError(f"there is a column {column} already")
    if min_exponent < 2:
        raise ValueError("a run holds two periods at least")

    run = "struct<start: bigint, length: bigint, period: bigint>"

    @F.arrow_udf(f"struct<n_words: bigint, runs: array<{run}>, strongest: {run}, collapsed: string>")
    def search(texts: pa.Array) -> pa.Array:
        # the texts are cut into words a block at a time
        found = list(_found((t.as_py().split() for t in texts.cast(pa.binary())), min_exponent, min_words))
        offsets = np.concatenate([[0], np.cumsum([len(f["runs"]) for f in found])]).astype(np.int32)
        arrays = [
            pa.array([f["n_words"] for f in found], pa.int64()),
            pa.ListArray.from_arrays(pa.array(offsets), _as_runs([r for f in found for r in f["runs"]])),
            _as_runs([f["strongest"] for f in found]),
            pa.array([f["collapsed"] for f in found], pa.binary()).cast(pa.string()),
        ]
        return pa.StructArray.from_arrays(arrays, fields=list(FOUND))

    # marked as non-deterministic so that Spark runs it once however many fields are read
    once = search.asNondeterministic()
    return docs.withColumn(column, once(text_of() if text is None else F.coalesce(text, F.lit(""))))


def periodic_texts(docs: DataFrame) -> DataFrame:
    """``(doc_id, text)``: the texts, those of doc_ids whose crc32 is divisible by 10 with a period from some word on, as ``op13`` asks.

    With h the crc32 of the decimal doc_id, g = floor(h / 10) and n words, each word i from a = g % n on becomes the
    word a + (i - a) % p, where p = 1 + floor((n - a) / (3 + g % 8)). Without a doc_id the text stays as it is, a null text is empty.
    """
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    cut = F.when(h % F.lit(10) == 0, F.regexp_extract_all(text_of(), F.lit(WORD), F.lit(0)))
    # the words are a column of their own, so that they are cut once for each text and not for each word
    rows = docs.select("doc_id", text_of().alias("text"), F.floor(h / F.lit(10)).alias("g"), cut.alias("words"))
    n, g = F.size("words"), F.col("g")
    a = F.pmod(g, n)
    p = F.lit(1) + F.floor((n - a) / (F.lit(3) + F.pmod(g, F.lit(8))))
    repeated = F.transform("words", lambda _, i: F.get("words", F.when(i < a, i).otherwise(a + F.pmod(i - a, p)).cast("int")))
    return rows.select("doc_id", F.when(F.col("words").isNotNull(), F.array_join(repeated, " ")).otherwise(F.col("text")).alias("text"))
