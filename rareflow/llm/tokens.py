"""Token ids of whole texts by public tokenizers, with a cache of the pieces that texts share."""

from __future__ import annotations

import ctypes
import gc
import os
from itertools import repeat

import numpy as np
import pyarrow as pa
from tokenizers import Tokenizer

END_ID = 1
#: Pieces kept before the cache starts anew, and the most bytes of a piece that is kept.
CACHED_PIECES = 900_000
CACHED_BYTES = 48

_RANDOM = np.random.default_rng(7)
_BYTE = _RANDOM.integers(0, 2**64, 256, dtype=np.uint64)
_PLACE = _RANDOM.integers(0, 2**64, CACHED_BYTES + 1, dtype=np.uint64) | np.uint64(1)

_WHITE, _LETTER, _MARK = (np.zeros(256, dtype=bool) for _ in range(3))
_WHITE[[9, 10, 11, 12, 13, 32]] = True
_LETTER[[*range(65, 91), *range(97, 123)]] = True
_MARK[list(b"!#$%&*+,./:;?@|")] = True
#: First bytes of characters that may be white space or combine with the one before; texts with them are encoded whole.
_RARE = np.zeros(256, dtype=bool)
_RARE[[0xCC, 0xCD, 0xE1, 0xE2, 0xE3]] = True


def vocabulary(name: str) -> str:
    """Path of a public tokenizer's file on this machine."""
    import public_tokenizers

    return public_tokenizers.path(name)


def piece_starts(codes: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Where pieces of texts start: places that no token reaches across, whatever surrounds them.

    ``first`` marks the first byte of each text. A piece starts before a single space between two words, before and behind any other single
    white space between words, and between a Latin letter and a mark.
    """
    n = len(codes)
    word = ~_WHITE[codes]
    word_before, word_after = np.zeros(n, dtype=bool), np.zeros(n, dtype=bool)
    word_before[1:] = word[:-1] & ~first[1:]
    word_after[:-1] = word[1:] & ~first[1:]
    single = ~word & word_before & word_after
    starts = first | single
    starts[1:] |= (single & (codes != 32))[:-1]
    starts[1:] |= _LETTER[codes[:-1]] & _MARK[codes[1:]]
    return np.flatnonzero(starts)


def _names(codes: np.ndarray, start: np.ndarray, width: np.ndarray) -> np.ndarray:
    """A 64-bit name of each piece, a running number where it is too long to be kept."""
    name = np.empty(len(start), dtype=np.uint64)
    for a in range(0, len(start), 32_768):
        head, wide = start[a : a + 32_768], width[a : a + 32_768]
        part = codes[head[0] : head[-1] + wide[-1]]
        place = np.arange(len(part)) - np.repeat(head - head[0], wide)
        value = _BYTE[part] * _PLACE[np.minimum(place, CACHED_BYTES)]
        name[a : a + 32_768] = np.add.reduceat(value, head - head[0])
    name = (name ^ (name >> np.uint64(31))) * _PLACE[0] + width.astype(np.uint64) * _PLACE[1]
    long = width > CACHED_BYTES
    name[long] = np.arange(long.sum(), dtype=np.uint64)
    return name


def _distinct(name: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where each distinct name stands, and for each name which of them it is."""
    n = len(name)
    bits = max(1, n.bit_length())
    low = np.uint64((1 << bits) - 1)
    # the sort of plain numbers is far faster than that of places, so the places ride in the low bits
    packed = np.sort((name & ~low) | np.arange(n, dtype=np.uint64))
    order = (packed & low).astype(np.int64)
    ordered = name[order]
    same = np.concatenate([[False], (packed[1:] ^ packed[:-1]) <= low]) if n else np.zeros(0, dtype=bool)
    if (ordered[1:][same[1:]] != ordered[:-1][same[1:]]).any():
        order = np.argsort(name, kind="stable")
        ordered = name[order]
        same = np.concatenate([[False], ordered[1:] == ordered[:-1]])
    slot = np.empty(n, dtype=np.int64)
    slot[order] = np.cumsum(~same) - 1
    return order[~same], slot


class Encoder:
    """Ids of texts as ``tokenizer.encode(text, add_special_tokens=False)`` gives them.

    A text falls into pieces at places where no token can reach across; equal pieces are found by their names (hashes of 64
    bits over bytes and length), and those seen before come from a cache of bounded size, which holds names and ids but no text. Texts that hold a special
    token's beginning, or rare characters that act on their neighbours, are encoded whole.
    """

    def __init__(self, path: str, cached: int = CACHED_PIECES):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        self.tokenizer = Tokenizer.from_file(path)
        self.special = sorted({t.content[:2].encode() for t in self.tokenizer.get_added_tokens_decoder().values()})
        self.lower = self.tokenizer.normalizer is not None
        self.cached = cached
        self._clear()

    def _clear(self):
        self.names = np.zeros(0, dtype=np.uint64)  # ascending, with the slot of each beside it
        self.slots = np.zeros(0, dtype=np.int64)
        self.starts = np.zeros(0, dtype=np.int64)
        self.lengths = np.zeros(0, dtype=np.int64)
        self.ids = np.zeros(0, dtype=np.uint32)

    def _slots(self, named: np.ndarray, short: np.ndarray) -> np.ndarray:
        """The slot of each named piece in the cache, -1 for those that it does not hold."""
        if not len(self.names):
            return np.full(len(named), -1, dtype=np.int64)
        place = np.minimum(np.searchsorted(self.names, named), len(self.names) - 1)
        return np.where(short & (self.names[place] == named), self.slots[place], -1)

    def _whole(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        lists = [e.ids for e in self.tokenizer.encode_batch(texts, add_special_tokens=False)]
        lengths = np.fromiter(map(len, lists), dtype=np.int64, count=len(lists))
        ids = np.fromiter((i for x in lists for i in x), dtype=np.uint32, count=int(lengths.sum()))
        return np.cumsum(lengths) - lengths, lengths, ids

    def _joined(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """As ``_whole``, in one text with line feeds between the pieces, which costs less than a text for each.

        Pieces that could join with the line feed (white space at their end, or more than one space at their beginning) go the other way.
        """
        plain = np.array([not (p[-1].isspace() or p[:1].isspace() and (p[0] != " " or p[1:2].isspace())) for p in pieces])
        lone = [pieces[i] for i in np.flatnonzero(~plain).tolist()]
        together = [pieces[i] for i in np.flatnonzero(plain).tolist()]
        found = self.tokenizer.encode("\n".join(together), add_special_tokens=False)
        width = np.fromiter(map(len, together), dtype=np.int64, count=len(together)) + 1
        begin = np.cumsum(width) - width
        begins = np.fromiter((a for a, _ in found.offsets), dtype=np.int64, count=len(found))
        owner = np.searchsorted(begin, begins, side="right") - 1
        inside = begins < (begin + width - 1)[owner] if len(together) else np.zeros(0, dtype=bool)
        counts = np.bincount(owner[inside], minlength=len(together))
        starts, lengths = np.zeros(len(pieces), dtype=np.int64), np.zeros(len(pieces), dtype=np.int64)
        ids = np.array(found.ids, dtype=np.uint32)[inside]
        lengths[plain], starts[plain] = counts, np.cumsum(counts) - counts
        if lone:
            more, wide, other = self._whole(lone)
            starts[~plain], lengths[~plain] = more + len(ids), wide
            ids = np.append(ids, other)
        return starts, lengths, ids

    def _pieces(self, raw: bytes, sizes: np.ndarray):
        """Slot of each piece in the tables of starts, lengths and ids, the tables, and the pieces of each text."""
        codes = np.frombuffer(raw, dtype=np.uint8)
        if self.lower:
            codes = _lower(codes)
            codes[codes == 10] = 32  # white space is all alike where it is dropped
            raw = codes.tobytes()
        edges = np.concatenate([[0], np.cumsum(sizes)])
        first = np.zeros(len(codes), dtype=bool)
        first[edges[:-1][sizes > 0]] = True
        start = piece_starts(codes, first)
        stop = np.append(start[1:], len(codes))
        width = stop - start
        name = _names(codes, start, width)
        at, slot = _distinct(name)
        named, begin, end = name[at], start[at], stop[at]
        short = end - begin <= CACHED_BYTES
        of = self._slots(named, short)
        if (of < 0).any() and len(self.names) + int(((of < 0) & short).sum()) > self.cached:
            self._clear()
            of[:] = -1

        def texts(which: np.ndarray) -> list[str]:
            return [raw[a:z].decode("utf-8") for a, z in zip(begin[which].tolist(), end[which].tolist())]

        fresh = np.flatnonzero((of < 0) & short)
        if len(fresh):
            starts, lengths, ids = self._joined(texts(fresh))
            of[fresh] = len(self.names) + np.arange(len(fresh))
            order = fresh[np.argsort(named[fresh])]
            places = np.searchsorted(self.names, named[order])
            self.names = np.insert(self.names, places, named[order])
            self.slots = np.insert(self.slots, places, of[order])
            self.starts = np.concatenate([self.starts, starts + len(self.ids)])
            self.lengths = np.concatenate([self.lengths, lengths])
            self.ids = np.concatenate([self.ids, ids])
        table = (self.starts, self.lengths, self.ids)
        rest = np.flatnonzero(of < 0)
        if len(rest):
            starts, lengths, ids = self._whole(texts(rest))
            of[rest] = len(self.starts) + np.arange(len(rest))
            table = (np.append(self.starts, starts + len(self.ids)), np.append(self.lengths, lengths), np.append(self.ids, ids))
        return of[slot], table, np.searchsorted(start, edges)

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All texts' ids one after the other, and how many each text has."""
        raws = [t.encode("utf-8") for t in texts]
        odd = [i for i, r in enumerate(raws) if self._odd(r)]
        whole = self._whole([texts[i] for i in odd]) if odd else None
        for i in odd:
            raws[i] = b""
        slot, (starts, lengths, ids), edges = self._pieces(b"".join(raws), np.array([len(r) for r in raws], dtype=np.int64))
        wide = lengths[slot]
        ends = np.concatenate([[0], np.cumsum(wide)])
        at = np.repeat(starts[slot] - ends[:-1], wide) + np.arange(int(ends[-1]))
        counts = np.diff(ends[edges])
        every = ids[at]
        if whole is None:
            return every, counts
        at = np.cumsum(counts) - counts
        parts, last = [], 0
        for k, i in enumerate(odd):
            parts += [every[last : at[i]], whole[2][whole[0][k] : whole[0][k] + whole[1][k]]]
            last, counts[i] = at[i], whole[1][k]
        return np.concatenate([*parts, every[last:]]), counts

    def _odd(self, raw: bytes) -> bool:
        if any(s in raw for s in self.special):
            return True
        if raw.isascii():
            return False
        codes = np.frombuffer(raw, dtype=np.uint8)
        # 0xC2 0x85 and 0xC2 0xA0 are white space too
        return bool(_RARE[codes].any()) or b"\xc2\x85" in raw or b"\xc2\xa0" in raw


def _lower(codes: np.ndarray) -> np.ndarray:
    """Lower case of the letters A to Z and of the capitals from U+00C0 to U+00DE."""
    out = codes.copy()
    out[(codes >= 65) & (codes <= 90)] += 32
    second = np.flatnonzero(codes[:-1] == 0xC3) + 1
    follows = codes[second]
    out[second[(follows >= 0x80) & (follows <= 0x9E) & (follows != 0x97)]] += 32
    return out


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """One encoder for each file and worker, so that later tasks find the cache filled."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


def forget() -> None:
    """Give back what earlier tasks of this worker keep: encoders, and memory that was freed but not returned.

    Workers live on between the stages of a pipeline; a stage that encodes nothing starts with this.
    """
    _ENCODERS.clear()
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def encode_in_parts(path: str, texts: list[str], chars: int = 2_000_000):
    """(from, to, ids, counts) for ranges of texts of about ``chars`` characters."""
    at = 0
    while at < len(texts):
        to, held = at, 0
        while to < len(texts) and (to == at or held + len(texts[to]) <= chars):
            held += len(texts[to])
            to += 1
        yield at, to, *encoder(path).encode(texts[at:to])
        at = to


def with_end(ids: np.ndarray, counts: np.ndarray, end: int = END_ID) -> tuple[np.ndarray, np.ndarray]:
    """The same with one end id behind each text's ids."""
    return np.insert(ids, np.cumsum(counts), end), counts + 1
