"""Removal of byte strings that an earlier document holds too, by prefix doubling over sampled positions."""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rareflow.llm.common import settled, text_of
from rareflow.llm.tokens import forget

LENGTH = 50
#: Bytes of the first rank; a window of LENGTH bytes holds LENGTH - FIRST + 1 places for it.
FIRST = 16
#: Positions that one task groups at a time.
GROUP_POSITIONS = 500_000
#: A batch sends the number of a rank's places from this many on; of fewer the bucket assumes the most there may be.
COUNTED_PLACES = 8
#: Marks a place in a document's list that stands for all equal windows of the document.
EVERYWHERE = 1 << 31
#: Names of hot ranks that travel to every task, 24 MB; more are joined to the documents that hold them.
HOT_NAMES = 4_000_000
#: Parts that the documents' ranks are dealt into for that join, as a hot rank may be in a third of all documents.
HOT_PARTS = 32
#: Places whose windows are compared at a time, so that they stay in a core's cache.
CACHED_PLACES = 4_000
#: Bytes that are ranked at a time, so that the arrays stay in a core's cache.
SLICE = 1 << 17

_RANDOM = np.random.default_rng(42)
_BYTE_RANK = _RANDOM.integers(0, 2**64, 256, dtype=np.uint64)
_STEPS = _RANDOM.integers(0, 2**64, 64, dtype=np.uint64) | np.uint64(1)


def _pair(left: np.ndarray, right: np.ndarray, step: int) -> np.ndarray:
    """The rank of a string from the ranks of its two halves: a name that equal strings share."""
    mixed = left * _STEPS[step] + right
    mixed ^= mixed >> np.uint64(29)
    mixed *= _STEPS[step + 32]
    return mixed ^ (mixed >> np.uint64(32))


def ranks(codes: np.ndarray, length: int) -> np.ndarray:
    """Ranks of the strings of ``length`` bytes that start at each place (last axis), by doubling."""
    rank, known, step = _BYTE_RANK[codes], 1, 0
    while known < length:
        more = min(known, length - known)
        rank = _pair(rank[..., : rank.shape[-1] - more], rank[..., more:], step)
        known, step = known + more, step + 1
    return rank


def _lowest(rank: np.ndarray, width: int) -> np.ndarray:
    """Place of the leftmost smallest rank among the ``width`` from each place on."""
    place, known = np.arange(len(rank), dtype=np.int32), 1
    while known < width:
        more = min(known, width - known)
        left, right = rank[: len(rank) - more], rank[more:]
        place = np.where(right < left, place[more:], place[: len(place) - more])
        rank, known = np.minimum(left, right), known + more
    return place


def sampled(codes: np.ndarray, ends: np.ndarray, length: int, first: int):
    """Sampled places of a buffer of documents: ``(place, rank, from, to)``.

    Every window of ``length`` bytes inside a document chooses the leftmost smallest rank of its strings of ``first`` bytes; so equal
    windows choose alike, wherever they stand. ``from``..``to`` are the starts of the windows that chose the place.
    """
    n, width = len(codes), length - first + 1
    empty = np.zeros(0, dtype=np.int64)
    if n < length:
        return empty, np.zeros(0, dtype=np.uint64), empty, empty
    rank = ranks(codes, first)
    place = _lowest(rank, width)
    end = np.repeat(ends, np.diff(np.concatenate([[0], ends])))
    start = np.flatnonzero(np.arange(len(place)) + length <= end[: len(place)])
    chosen = place[start]
    head = np.flatnonzero(np.concatenate([[True], chosen[1:] != chosen[:-1]])) if len(chosen) else empty
    tail = np.append(head[1:], len(chosen)) - 1
    return chosen[head], rank[chosen[head]], start[head], start[tail] if len(chosen) else empty


def _slices(codes: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[int, int]]:
    """Ranges of whole documents with about SLICE bytes."""
    at, n = 0, len(offsets) - 1
    while at < n:
        to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + SLICE, side="right")) - 1)
        yield at, to
        at = to


def _samples(codes, offsets, length, first):
    """The sampled places of a batch: place in the buffer, document's number, rank, first and last window."""
    found = []
    for a, z in _slices(codes, offsets):
        base = offsets[a]
        place, rank, lo, hi = sampled(codes[base : offsets[z]], offsets[a + 1 : z + 1] - base, length, first)
        found.append((place + base, rank, lo + base, hi + base))
    place, rank, lo, hi = (np.concatenate(x) for x in zip(*found))
    return place, np.searchsorted(offsets, place, side="right") - 1, rank >> np.uint64(16), lo, hi


def _buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a binary column without nulls."""
    column = column.cast(pa.large_binary())
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    codes = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, dtype=np.uint8)
    return codes[offsets[0] : offsets[-1]], offsets - offsets[0]


def _six(names: np.ndarray) -> bytes:
    return names.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6].tobytes()


def _from_six(data: bytes) -> np.ndarray:
    wide = np.zeros((len(data) // 6, 8), dtype=np.uint8)
    wide[:, :6] = np.frombuffer(data, dtype=np.uint8).reshape(-1, 6)
    return wide.view("<u8").reshape(-1)


def _runs(number: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Values and lengths of the runs of an array."""
    if not len(number):
        return number, np.zeros(0, dtype=np.int64)
    head = np.flatnonzero(np.concatenate([[True], number[1:] != number[:-1]]))
    return number[head], np.diff(np.append(head, len(number)))


def _place_in_run(head: np.ndarray) -> np.ndarray:
    """For runs that begin where ``head`` is true: the number of each element in its run."""
    at = np.arange(len(head))
    return at - np.maximum.accumulate(np.where(head, at, 0))


def _u32(values) -> bytes:
    return np.asarray(values).astype("<u4").tobytes()


def _i64(values) -> bytes:
    return np.asarray(values).astype("<i8").tobytes()


def _starts(values: np.ndarray) -> np.ndarray:
    return np.concatenate([[True], values[1:] != values[:-1]]) if len(values) else np.zeros(0, dtype=bool)


FIRST_SCHEMA = "bucket long, known boolean, ids binary, marks binary, counts binary, names binary, many binary, times binary"
ALIVE_SCHEMA = "id long, mark long, names binary, hot binary"
SECOND_SCHEMA = "bucket long, known boolean, ids binary, marks binary, counts binary, places binary, bits binary, froms binary, tos binary, contexts binary"
FOUND_SCHEMA = "id long, mark long, places binary, bits binary"


def _rows(schema: str, rows: list[tuple]) -> pa.RecordBatch:
    kinds = {"long": pa.int64(), "boolean": pa.bool_(), "binary": pa.binary()}
    fields = [f.split() for f in schema.split(", ")]
    columns = list(zip(*rows)) or [()] * len(fields)
    arrays = [pa.array(c, kinds[k]) for c, (_, k) in zip(columns, fields)]
    return pa.RecordBatch.from_arrays(arrays, [name for name, _ in fields])


def _dealt(bucket: np.ndarray, number: np.ndarray, ids, marks, blobs):
    """For each bucket: its documents, how many entries each has, and the entries' values."""
    bits = np.uint64(max(1, int(len(ids)).bit_length()))
    at = np.arange(len(bucket), dtype=np.uint64)
    low = np.uint64(max(1, len(bucket).bit_length()))
    key = (bucket.astype(np.uint64) << bits) | number.astype(np.uint64)
    order = np.argsort(key, kind="stable") if int(key.max(initial=0)).bit_length() + int(low) > 64 else None
    if order is None:
        order = (np.sort((key << low) | at) & ((np.uint64(1) << low) - np.uint64(1))).astype(np.int64)
    bucket, number = bucket[order], number[order]
    values, sizes = _runs(bucket)
    at = 0
    for b, size in zip(values.tolist(), sizes.tolist()):
        docs, counts = _runs(number[at : at + size])
        mine = order[at : at + size]
        yield b, _i64(ids[docs]), _i64(marks[docs]), _u32(counts), [blob(mine) for blob in blobs]
        at += size


def _first_rows(ids, marks) -> np.ndarray:
    """For each row the number of the first row with its id and mark."""
    order = np.lexsort((marks, ids))
    head = _starts(ids[order]) | _starts(marks[order])
    first = np.empty(len(ids), dtype=np.int64)
    first[order] = order[np.maximum.accumulate(np.where(head, np.arange(len(ids)), 0))]
    return first


NO_COUNTS = (b"", b"")


def _many(name: np.ndarray, buckets: int) -> dict[int, tuple[bytes, bytes]]:
    """For each bucket its ranks with many places, and how many; ``name`` must ascend."""
    names, sizes = _runs(name)
    often = sizes >= COUNTED_PLACES
    names, sizes = names[often], sizes[often]
    bucket = (names % np.uint64(buckets)).astype(np.int64)
    order = np.argsort(bucket, kind="stable")
    names, sizes, (values, widths) = names[order], sizes[order], _runs(bucket[order])
    ends = np.cumsum(widths).tolist()
    return {b: (_six(names[z - w : z]), _i64(sizes[z - w : z])) for b, w, z in zip(values.tolist(), widths.tolist(), ends)}


#: Rows whose numbers fit into the 16 bits beside a rank.
BATCH_ROWS = 1 << 16


def _of_few_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The batches in parts whose rows can be numbered, whatever size the session's Arrow batches have."""
    for batch in batches:
        for at in range(0, batch.num_rows, BATCH_ROWS):
            yield batch.slice(at, BATCH_ROWS)


def _first_ranks(length: int, first: int, buckets: int):
    """Batches of documents to sampled ranks per bucket.

    A rank that a batch holds in three documents or more is known to be shared; only its first two documents
    are sent to the rank's bucket, the others pass in one of their own, so a string that a third of all rows hold costs two entries for each batch.
    Rows with one id and mark are one document here as in the bucket. Ranks with many places go with their number of places.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        for batch in _of_few_rows(batches):
            codes, offsets = _buffer(batch.column("text"))
            if not len(codes):
                continue
            ids, marks = (batch.column(c).to_numpy() for c in ("id", "mark"))
            _, number, name, _, _ = _samples(codes, offsets, length, first)
            number = _first_rows(ids, marks)[number]
            # 48 bits of rank and 16 of document: the sort of plain numbers is far faster than that of places
            both = np.sort((name << np.uint64(16)) | (number % 65536).astype(np.uint64))
            many = _many(both >> np.uint64(16), buckets)
            both = both[_starts(both)]
            number, name = (both & np.uint64(65535)).astype(np.int64), both >> np.uint64(16)
            known = _place_in_run(_starts(name)) >= 2
            rows = []
            for flag in (False, True):
                mine, names = number[known == flag], name[known == flag]
                bucket = ids[mine] % buckets if flag else (names % np.uint64(buckets)).astype(np.int64)
                for b, i, m, c, (n,) in _dealt(bucket, mine, ids, marks, [lambda at, names=names: _six(names[at])]):
                    rows.append((b, flag, i, m, c, n, *(many.get(b, NO_COUNTS) if not flag else NO_COUNTS)))
            yield _rows(FIRST_SCHEMA, rows)

    return run


def _unpacked(row: dict):
    ids, marks = (np.frombuffer(row[c], dtype="<i8") for c in ("ids", "marks"))
    counts = np.frombuffer(row["counts"], dtype="<u4")
    return np.repeat(ids, counts), np.repeat(marks, counts)


def _by_document(ids, marks, blobs):
    """One row for each document: its entries' values."""
    order = np.lexsort((marks, ids))
    head = np.flatnonzero(_starts(ids[order]) | _starts(marks[order]))
    for a, z in zip(head.tolist(), [*head[1:].tolist(), len(order)]):
        mine = order[a:z]
        yield int(ids[mine[0]]), int(marks[mine[0]]), *[blob(mine) for blob in blobs]


def _hot_ranks(names: np.ndarray, sent: list[dict], most: int) -> np.ndarray:
    """Ranks that may have more than ``most`` places, from those of the bucket's documents (``names`` ascends) and the counts sent."""
    values, entries = _runs(names)
    places = entries * (COUNTED_PLACES - 1)
    many = np.concatenate([_from_six(r["many"]) for r in sent])
    at = np.searchsorted(values, many)
    there = np.append(values, np.uint64(0))[at] == many
    np.add.at(places, at[there], np.frombuffer(b"".join(r["times"] for r in sent), dtype="<i8")[there])
    return values[places > most]


def _shared_ranks(most: int):
    """The entries of a bucket whose rank two documents hold; the others are unique and end here.

    A row without a document has the ranks that may have more than ``most`` places in all.
    """

    def shared(table: pa.Table) -> pa.Table:
        rows = table.to_pylist()
        sent, out = [r for r in rows if not r["known"]], []
        if sent:
            ids, marks = (np.concatenate(x) for x in zip(*map(_unpacked, sent)))
            names = np.concatenate([_from_six(r["names"]) for r in sent])
            order = np.lexsort((marks, ids, names))
            ids, marks, names = ids[order], marks[order], names[order]
            fresh = _starts(names)
            other = _starts(ids) | _starts(marks)
            group = np.cumsum(fresh) - 1
            several = np.bincount(group, weights=other & ~fresh) > 0
            keep = several[group]
            ids, marks, names = ids[keep], marks[keep], names[keep]
            out += [(*r, None) for r in _by_document(ids, marks, [lambda at: _six(names[at])])]
            if len(hot := _hot_ranks(names, sent, most)):
                out.append((None, None, None, _six(hot)))
        for r in (r for r in rows if r["known"]):
            i, m = _unpacked(r)
            n = _from_six(r["names"])
            out += [(*r, None) for r in _by_document(i, m, [lambda at, n=n: _six(n[at])])]
        return pa.Table.from_batches([_rows(ALIVE_SCHEMA, out)])

    return shared


def _contexts(codes, place, lo, hi, length, first):
    """For each place the bytes of its windows, zero outside of them; equal ones have equal windows."""
    reach = length - first
    width = 2 * reach + first
    padded = np.pad(codes, (reach, width))
    context = np.lib.stride_tricks.sliding_window_view(padded, width)[place].copy()
    column = np.arange(width, dtype=np.int16)
    context[column < (lo - place + reach).astype(np.int16)[:, None]] = 0
    context[column >= (hi - place + reach + length).astype(np.int16)[:, None]] = 0
    return context


def _as_words(context: np.ndarray) -> np.ndarray:
    """The rows' bytes as 64-bit words, filled up with zeros."""
    wide = np.zeros((len(context), -(-context.shape[1] // 8) * 8), dtype=np.uint8)
    wide[:, : context.shape[1]] = context
    return wide.view("<u8")


def _all_bits(first_bit, last_bit):
    one = np.uint64(1)
    return ((one << (last_bit - first_bit + 1).astype(np.uint64)) - one) << first_bit.astype(np.uint64)


def _hot_windows(codes, place, lo, hi, local, ids, marks, length: int, first: int, buckets: int) -> Iterator[list[tuple]]:
    """The rows to send, some at a time, for places of hot ranks, which are dealt by the names of their windows in place of the rank.

    Of equal windows one is sent, of the smallest id; it stands for all of its document. The others with a larger id are known
    to be repeats. ``ids, marks`` are those of the places.
    """
    reach = length - first
    for a in range(0, len(place), 10_000):
        rows = []
        mine = a + np.lexsort((marks[a : a + 10_000], ids[a : a + 10_000]))
        context = _contexts(codes, place[mine], lo[mine], hi[mine], length, first)
        low, high, at, owner, mark = lo[mine] - place[mine] + reach, hi[mine] - place[mine] + reach, local[mine], ids[mine], marks[mine]
        row, column, name, order, leader = _equal_windows(context, low, high, length, reach + 1)
        again = owner[row[leader]] < owner[row[order]]
        bits = _as_bits(row[order[again]], column[order[again]], len(mine))
        hit = np.flatnonzero(bits)
        for b, i, m, c, (p, w) in _dealt(
            owner[hit] % buckets, np.arange(len(hit)), owner[hit], mark[hit], [lambda x: _u32(at[hit[x]]), lambda x: bits[hit[x]].astype("<u8").tobytes()]
        ):
            rows.append((b, True, i, m, c, p, w, b"", b"", b""))
        order, leader = order[~again], leader[~again]
        one = np.flatnonzero(_starts(leader) | _starts(mark[row[order]]))
        alone = np.diff(np.append(one, len(order))) == 1
        order, name = order[one], name[leader[one]]
        row, column = row[order], column[order]
        places = np.where(alone, at[row], at[row] | EVERYWHERE)
        blobs = [
            lambda x: _u32(places[x]),
            lambda x: column[x].astype(np.uint8).tobytes(),
            lambda x: _one_window(context[row[x]], column[x], length).tobytes(),
        ]
        bucket = (name % np.uint64(buckets)).astype(np.int64)
        for b, i, m, c, (p, w, shown) in _dealt(bucket, np.arange(len(row)), owner[row], mark[row], blobs):
            rows.append((b, False, i, m, c, p, b"", w, w, shown))
        yield rows


def _one_window(context: np.ndarray, column: np.ndarray, length: int) -> np.ndarray:
    """The contexts with zeros outside of the window at each one's column."""
    at = np.arange(context.shape[1])
    return np.where((at >= column[:, None]) & (at < column[:, None] + length), context, 0).astype(np.uint8)


def _ranks_in_rows(schema: str, *columns: str):
    """A row for each rank of a column of lists of ranks, with the other ``columns``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 100):
                part = batch.slice(at, 100)
                names = [_from_six(x) for x in part.column("names").to_pylist()]
                row = np.repeat(np.arange(len(names)), [len(n) for n in names])
                made = [part.column(c).take(pa.array(row)) for c in columns]
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(names).astype(np.int64)), *made], ["name", *columns])

    return lambda df: df.mapInArrow(run, schema)


def _hot_of_documents(alive: DataFrame) -> DataFrame:
    """``id, mark, hot``: the hot ranks of every document that holds one, by a join dealt by rank and part.

    The hot ranks go to every part, a document's ranks to one, so a rank that a third of all documents hold meets
    them in HOT_PARTS tasks.
    """
    part = F.pmod(F.xxhash64("id", "mark"), F.lit(HOT_PARTS))
    own = alive.where("id is not null").select("id", "mark", "names")
    own = _ranks_in_rows("name long, id long, mark long", "id", "mark")(own).select("*", part.alias("part"))
    hot = _ranks_in_rows("name long")(alive.where("hot is not null").select(F.col("hot").alias("names")))
    hot = hot.select("name", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(HOT_PARTS - 1).cast("long"))).alias("part"))
    return own.join(hot.hint("shuffle_hash"), ["name", "part"]).groupBy("id", "mark").agg(F.collect_list("name").alias("hot"))


def _second_ranks(length: int, first: int, buckets: int, hot_ranks: np.ndarray | None):
    """Batches of documents with their shared ranks to the surroundings of the shared places, per bucket.

    Of places with equal surroundings in a batch only those of the smallest doc_id are sent on: all windows
    of the others are known to be repeats. Places of the ranks ``hot_ranks`` (ascending; None: those that the column ``hot`` of
    the documents holds) are sent by their windows.
    """
    reach = length - first

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        for batch in _of_few_rows(batches):
            codes, offsets = _buffer(batch.column("text"))
            if not len(codes):
                continue
            ids, marks = (batch.column(c).to_numpy() for c in ("id", "mark"))
            alive = []
            for number, lists in enumerate(batch.column("names").to_pylist()):
                mine = np.concatenate([_from_six(x) for x in lists])
                alive.append((mine << np.uint64(16)) | np.uint64(number % 65536))
            alive = np.sort(np.concatenate(alive))
            place, number, name, lo, hi = _samples(codes, offsets, length, first)
            key = (name << np.uint64(16)) | (number % 65536).astype(np.uint64)
            at = np.minimum(np.searchsorted(alive, key), len(alive) - 1)
            keep = alive[at] == key
            place, number, name, lo, hi = place[keep], number[keep], name[keep], lo[keep], hi[keep]
            rows, sent, bits, shown = [], [], [], []
            hot = _hot_in_batch(batch) if hot_ranks is None else hot_ranks
            if len(hot):
                much = hot[np.minimum(np.searchsorted(hot, name), len(hot) - 1)] == name
                by_name = np.flatnonzero(much)[np.argsort(name[much], kind="stable")]
                p, n = place[by_name], number[by_name]
                for part in _hot_windows(codes, p, lo[by_name], hi[by_name], p - offsets[n], ids[n], marks[n], length, first, buckets):
                    yield _rows(SECOND_SCHEMA, part)
                place, number, name, lo, hi = place[~much], number[~much], name[~much], lo[~much], hi[~much]
            for a in range(0, len(place), 20_000):
                part = slice(a, a + 20_000)
                context = _contexts(codes, place[part], lo[part], hi[part], length, first)
                again = _known_copies(context, ids[number[part]])
                sent.append(~again)
                shown.append(context[~again])
                bits.append(_all_bits(lo[part] - place[part] + reach, hi[part] - place[part] + reach))
            if not sent:
                continue
            sent, bits, shown = np.concatenate(sent), np.concatenate(bits), np.concatenate(shown)
            local = place - offsets[number]
            row_of = np.cumsum(sent) - 1
            for flag in (False, True):
                chosen = np.flatnonzero(sent != flag)
                bucket = ids[number[chosen]] % buckets if flag else (name[chosen] % np.uint64(buckets)).astype(np.int64)
                pick = lambda values, chosen=chosen: (lambda at: values[chosen[at]])
                places, window, low, high = (pick(v) for v in (local, bits, lo - place + reach, hi - place + reach))
                blobs = [
                    lambda at, f=places: _u32(f(at)),
                    lambda at, f=window, flag=flag: f(at).astype("<u8").tobytes() if flag else b"",
                    lambda at, f=low, flag=flag: b"" if flag else f(at).astype(np.uint8).tobytes(),
                    lambda at, f=high, flag=flag: b"" if flag else f(at).astype(np.uint8).tobytes(),
                    lambda at, chosen=chosen, flag=flag: b"" if flag else shown[row_of[chosen[at]]].tobytes(),
                ]
                for b, i, m, c, more in _dealt(bucket, number[chosen], ids, marks, blobs):
                    rows.append((b, flag, i, m, c, *more))
            yield _rows(SECOND_SCHEMA, rows)

    return run


def _hot_in_batch(batch: pa.RecordBatch) -> np.ndarray:
    """The hot ranks that the batch's documents hold, ascending."""
    held = batch.column("hot").drop_null()
    return np.unique(held.flatten().to_numpy(zero_copy_only=False).astype(np.uint64))


def _known_copies(context: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """True for rows whose bytes a row with a smaller id has too."""
    words = _as_words(context)
    name = np.zeros(len(words), dtype=np.uint64)
    for k in range(words.shape[1]):
        name = (name ^ (name >> np.uint64(29))) * _STEPS[k] + words[:, k] * _STEPS[k + 32]
    order = np.lexsort((ids, name))
    leader = order[np.maximum.accumulate(np.where(_starts(name[order]), np.arange(len(order)), 0))]
    copy = np.zeros(len(name), dtype=bool)
    copy[order] = (ids[leader] < ids[order]) & (words[leader] == words[order]).all(axis=1)
    return copy


def _repeats(length: int, first: int):
    """A bucket's places to the windows that a smaller doc_id has too, as bits for each place."""
    reach = length - first
    width = reach + 1

    def repeats(table: pa.Table) -> pa.Table:
        rows = table.to_pylist()
        sent, out = [r for r in rows if not r["known"]], []
        if sent:
            ids, marks = (np.concatenate(x) for x in zip(*map(_unpacked, sent)))
            joined = {c: b"".join(r[c] for r in sent) for c in ("places", "froms", "tos", "contexts")}
            places = np.frombuffer(joined["places"], dtype="<u4")
            lo, hi = (np.frombuffer(joined[c], dtype=np.uint8) for c in ("froms", "tos"))
            context = np.frombuffer(joined["contexts"], dtype=np.uint8).reshape(len(places), -1)
            anchor = ranks(context[:, reach : reach + first], first)[:, 0]
            # plain numbers sort faster than places; ranks that share their upper bits are taken together
            low = np.uint64((1 << max(1, len(places).bit_length())) - 1)
            packed = np.sort((anchor & ~low) | np.arange(len(places), dtype=np.uint64))
            order = (packed & low).astype(np.int64)
            bits = np.zeros(len(places), dtype=np.uint64)
            head = np.append(np.flatnonzero(_starts(packed & ~low)), len(order))
            at = 0
            while at < len(head) - 1:
                to = max(at + 1, int(np.searchsorted(head, head[at] + CACHED_PLACES, side="right")) - 1)
                mine = np.sort(order[head[at] : head[to]])
                mine = mine[np.argsort(ids[mine], kind="stable")]
                repeated = _repeated_windows if len(mine) <= 50_000 else _repeated_by_column
                bits[mine] = repeated(context[mine], lo[mine], hi[mine], ids[mine], length, width)
                at = to
            hit = bits != 0
            p, b = places[hit], bits[hit]
            out += _by_document(ids[hit], marks[hit], [lambda at: _u32(p[at]), lambda at: b[at].astype("<u8").tobytes()])
        for r in (r for r in rows if r["known"]):
            i, m = _unpacked(r)
            p, b = np.frombuffer(r["places"], dtype="<u4"), np.frombuffer(r["bits"], dtype="<u8")
            out += _by_document(i, m, [lambda at, p=p: _u32(p[at]), lambda at, b=b: b[at].tobytes()])
        return pa.Table.from_batches([_rows(FOUND_SCHEMA, out)])

    return repeats


def _equal_windows(context, lo, hi, length, width):
    """The windows ``lo``..``hi`` of each row: their row, column and name, their order by content, and the first of the same content for each so ordered."""
    name = np.empty((len(context), width), dtype=np.uint64)
    for a in range(0, len(context), 512):  # rows that stay in a core's cache
        name[a : a + 512] = ranks(context[a : a + 512, : width + length - 1], length)
    columns = np.arange(width)
    row, column = np.nonzero((columns >= lo[:, None]) & (columns <= hi[:, None]))
    name = name[row, column]
    n = len(name)
    low = np.uint64((1 << max(1, n.bit_length())) - 1)
    packed = np.sort((name & ~low) | np.arange(n, dtype=np.uint64))
    order = (packed & low).astype(np.int64)
    head = np.concatenate([[True], (packed[1:] ^ packed[:-1]) > low]) if n else np.zeros(0, dtype=bool)
    leader = order[np.maximum.accumulate(np.where(head, np.arange(n), 0))]
    if not _same_bytes(context, row, column, leader, order, length):  # two strings with one shortened rank
        strings = np.lib.stride_tricks.sliding_window_view(context, length, axis=1)[row, column]
        _, number = np.unique(strings, axis=0, return_inverse=True)
        order = np.argsort(number.reshape(-1), kind="stable")
        leader = order[np.maximum.accumulate(np.where(_starts(number.reshape(-1)[order]), np.arange(n), 0))]
    return row, column, name, order, leader


def _as_bits(row, column, n: int) -> np.ndarray:
    on = np.zeros((n, 64), dtype=bool)
    on[row, column] = True
    return np.packbits(on, axis=1, bitorder="little").view("<u8").reshape(-1)


def _repeated_windows(context, lo, hi, ids, length, width):
    """Bit j of a row: its window at j is also a window of a row with a smaller id; ``ids`` must ascend."""
    row, column, _, order, leader = _equal_windows(context, lo, hi, length, width)
    # rows ascend by id, so the first place of a string is that of its smallest id
    hit = order[ids[row[leader]] < ids[row[order]]]
    return _as_bits(row[hit], column[hit], len(context))


def _repeated_by_column(context, lo, hi, ids, length, width):
    """As ``_repeated_windows`` for places of one rank, in less memory: equal windows choose alike, so theirs are in one column."""
    bits = np.zeros(len(context), dtype=np.uint64)
    for j in range(width):
        rows = np.flatnonzero((lo <= j) & (hi >= j))
        at = np.zeros(len(rows), dtype=np.uint8)
        if len(rows):
            bits[rows] |= _repeated_windows(context[rows, j : j + length], at, at, ids[rows], length, 1) << np.uint64(j)
    return bits


def _same_bytes(context, row, column, leader, order, length):
    """Whether every window has the bytes of its leader, compared as 64-bit words at any byte."""
    other = np.flatnonzero(leader != order)
    x, y = leader[other], order[other]
    flat = np.pad(np.ascontiguousarray(context).reshape(-1), (0, 8))
    words = np.ndarray(len(flat) - 8, dtype="<u8", buffer=flat, strides=(1,))
    x, y = (row[p] * context.shape[1] + column[p] for p in (x, y))
    steps = sorted({*range(0, length - 7, 8), length - 8})
    return all((words[x + k] == words[y + k]).all() for k in steps)


def _everywhere(text: bytes, starts: np.ndarray, length: int) -> np.ndarray:
    """The starts of all windows of a document that equal one of those at ``starts``."""
    codes = np.frombuffer(text, dtype=np.uint8)
    windows = np.lib.stride_tricks.sliding_window_view(codes, length)
    names, at = np.unique(ranks(windows[starts], length)[:, 0], return_index=True)
    asked, found = starts[at], [starts]
    if not (windows[asked[np.searchsorted(names, ranks(windows[starts], length)[:, 0])]] == windows[starts]).all():
        strings = {text[s : s + length] for s in starts.tolist()}  # two strings with one rank
        return np.array([s for s in range(len(windows)) if text[s : s + length] in strings])
    for a in range(0, len(windows), SLICE):
        rank = ranks(codes[a : a + SLICE + length - 1], length)
        number = np.minimum(np.searchsorted(names, rank), len(names) - 1)
        hit = np.flatnonzero(names[number] == rank)
        same = (windows[a + hit] == windows[asked[number[hit]]]).all(axis=1)
        found.append(a + hit[same])
    return np.concatenate(found)


def _spans(text: bytes, places: list[bytes], bits: list[bytes], length: int, first: int) -> np.ndarray:
    """Maximal removed runs (from, to) of a document."""
    place = np.frombuffer(b"".join(places), dtype="<u4").astype(np.int64)
    all_equal, place = place >= EVERYWHERE, place % EVERYWHERE - (length - first)
    bit = np.frombuffer(b"".join(bits), dtype="<u8")
    on = np.unpackbits(bit.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    row, column = np.nonzero(on)
    start = place[row] + column
    if all_equal.any():
        start = np.concatenate([start, _everywhere(text, np.unique(start[all_equal[row]]), length)])
    start = np.unique(start)
    head = np.flatnonzero(np.concatenate([[True], start[1:] > start[:-1] + length]))
    return np.stack([start[head], start[np.append(head[1:], len(start)) - 1] + length], axis=1)


OUT = (
    "n_bytes long, n_removed long, n_spans long, kept_sha256 string, "
    "spans array<struct<start:bigint,end:bigint>>, kept binary, kept_text string"
)


def _removal(length: int, first: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
        for batch in batches:
            texts, places, bits = (batch.column(c).to_pylist() for c in ("text", "places", "bits"))
            rows = []
            for text, p, b in zip(texts, places, bits):
                spans = _spans(text, p, b, length, first).tolist() if p else []
                cuts = [0, *[x for s in spans for x in s], len(text)]
                kept = b"".join(text[a:z] for a, z in zip(cuts[::2], cuts[1::2]))
                found = [{"start": a, "end": z} for a, z in spans]
                digest = hashlib.sha256(kept).hexdigest()
                rows.append((len(text), len(text) - len(kept), len(spans), digest, found, kept, kept.decode("utf-8", "ignore")))
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(), span, pa.binary(), pa.string()]
            made = [pa.array(c, k) for c, k in zip(list(zip(*rows)) or [()] * 7, kinds)]
            rest = [c for c in batch.schema.names if c not in ("text", "places", "bits")]
            names = ["n_bytes", "n_removed", "n_spans", "kept_sha256", "spans", "kept", "kept_text"]
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in rest], *made], [*rest, *names])

    return run


def remove_repeats(
    docs: DataFrame,
    length: int = LENGTH,
    first: int = FIRST,
    group_positions: int = GROUP_POSITIONS,
    carry: Sequence[str] = (),
    hot_names: int = HOT_NAMES,
) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept_sha256, spans, kept, kept_text``, a row for each row of ``docs``.

    Removed is each byte that is covered by a string of ``length`` bytes which also starts in a document with a smaller
    doc_id; strings are taken from whole texts as UTF-8 and never cross documents. Null texts are empty; rows
    with a null doc_id are kept whole and repeat nothing; rows with one doc_id don't count as earlier than each other.
    ``kept_text`` is without the rest of a character that a removed run cuts in two. ``carry``: columns that pass unchanged, as
    one struct column ``row``.

    Prefix doubling, with a sample of the positions in place of all: every window of ``length`` bytes chooses the smallest
    rank of its strings of ``first`` bytes, about one position in eighteen, and equal windows choose alike. Ranks of 1, 2,
    4, ... bytes are paired to the first rank; the positions are shuffled and sorted by it, and those whose rank is unique
    to a document end there. Ranks that may have more than half of ``group_positions`` places are hot, at most one for some 31,000 sampled
    places; up to ``hot_names`` of their names are known to all tasks, more are joined to the documents that hold them, with the same
    result. Their places go on by the names of their windows, one for each string and part of a batch, so no
    group has all places of one rank. The rest are sorted by it again with their surroundings, and their windows ranked by pairs
    at growing offsets up to the threshold. Ranks are 64-bit names; the last ones are compared byte by byte, the first only
    decide what is looked at.
    """
    if not 2 * first <= length or length - first > 63:
        raise ValueError("first must be at most half of length, and at most 63 less than it")
    rows = docs.select(
        F.col("doc_id").cast("long").alias("id"),
        F.xxhash64(text_of()).alias("mark"),
        text_of().cast("binary").alias("text"),
        F.struct(*[F.col(f"`{c}`") for c in carry] or [F.lit(0).alias("none")]).alias("row"),
    )
    total = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = max(64, math.ceil(2 * total / (length - first + 2) / group_positions))
    named = rows.where(f"id is not null and octet_length(text) >= {length}").select("id", "mark", "text")

    ranked = named.mapInArrow(_first_ranks(length, first, buckets), FIRST_SCHEMA)
    shared = ranked.groupBy("bucket").applyInArrow(_shared_ranks(group_positions // 2), ALIVE_SCHEMA)
    alive = settled(shared, "ranks")
    lists = alive.where("id is not null").groupBy("id", "mark").agg(F.collect_list("names").alias("names"))
    placed = named.join(lists.hint("shuffle_hash"), ["id", "mark"]).select("id", "mark", "text", "names")
    found_hot = alive.where("hot is not null").select("hot")
    hot = None
    if (found_hot.agg(F.sum(F.octet_length("hot"))).first()[0] or 0) <= 6 * hot_names:
        hot = np.sort(_from_six(b"".join(r["hot"] for r in found_hot.collect())))
    else:
        of_documents = settled(_hot_of_documents(alive), "hot")
        placed = placed.join(of_documents.hint("shuffle_hash"), ["id", "mark"], "left").select("id", "mark", "text", "names", "hot")
    around = placed.mapInArrow(_second_ranks(length, first, buckets, hot), SECOND_SCHEMA)
    windows = settled(around.groupBy("bucket").applyInArrow(_repeats(length, first), FOUND_SCHEMA), "windows")
    found = windows.groupBy("id", "mark").agg(F.collect_list("places").alias("places"), F.collect_list("bits").alias("bits"))
    both = rows.join(found.hint("shuffle_hash"), ["id", "mark"], "left")
    removed = both.select(F.col("id").alias("doc_id"), "row", "text", "places", "bits")
    schema = T.StructType(removed.select("doc_id", "row").schema.fields + T.StructType.fromDDL(OUT).fields)
    return removed.mapInArrow(_removal(length, first), schema)


def without_repeats(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """``docs`` with the repeated bytes taken out of ``text``; all rows and columns stay.

    ``n_chars``, where there is one, follows the text. A null text becomes an empty one.
    """
    rest = [c for c in docs.columns if c != "text"]
    found = remove_repeats(docs, length, carry=rest)
    made = {"text": F.col("kept_text"), "n_chars": F.length("kept_text").cast("long")}
    return found.select(*[made[c].alias(c) if c in made else F.col(f"row.`{c}`").alias(c) for c in docs.columns])
