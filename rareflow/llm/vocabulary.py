"""A sorted vocabulary as minimal acyclic transducers, which give every term its place in the order."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np

#: Every byte that is no ASCII letter becomes a space and A-Z lower case; bytes of other characters stay.
_FOLD = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
#: Between words that travel together; no term holds it.
GAP = b"\n"


def terms_of(text: bytes) -> list[bytes]:
    """Stretches of letters and of characters beyond ASCII, with A-Z lower-cased."""
    return text.translate(_FOLD).split()


class Transducer:
    """The smallest automaton that accepts some words and writes each one's number among them, in the order of their bytes.

    Arcs are sorted by (state, byte): ``keys`` is state * 256 + byte, ``target`` the state behind, ``output`` how many words are passed
    over by taking the arc. The outputs on the way to a word add up to its number. State 0 is the start.
    """

    def __init__(self, keys, target, output, final, longest: int) -> None:
        self.keys, self.target, self.output, self.final, self.longest = keys, target, output, final, longest

    @classmethod
    def build(cls, words: Iterable[bytes]) -> Transducer:
        """From distinct words in ascending order, one after the other.

        Only the states along the newest word may still change. As soon as a word leaves that path, the states that it leaves are replaced
        by equal ones, which accept the same endings, if there are such.
        """
        known: dict[tuple, int] = {}
        arcs: list[list[tuple[int, int]]] = []  # of the states that are done
        final: list[bool] = []
        path: list[list] = [[False, []]]  # final?, arcs (byte, state) of the states along the newest word
        before, longest = b"", 0

        def finish(down_to: int) -> None:
            while len(path) > down_to + 1:
                ends, out = path.pop()
                signature = (ends, *out)
                state = known.get(signature)
                if state is None:
                    state = known[signature] = len(arcs)
                    arcs.append(out)
                    final.append(ends)
                path[-1][1].append((before[len(path) - 1], state))

        for word in words:
            shared, most = 0, min(len(word), len(before))
            while shared < most and word[shared] == before[shared]:
                shared += 1
            if before and word <= before:
                raise ValueError("words must be distinct and ascending")
            finish(shared)
            path += [[False, []] for _ in range(len(word) - shared)]
            path[-1][0] = True
            before, longest = word, max(longest, len(word))
        finish(0)
        start = len(arcs)
        arcs.append(path[0][1])
        final.append(path[0][0])
        # states behind come before those in front, so one pass counts the words from each state on
        below = [0] * len(arcs)
        rows: list[tuple[int, int, int]] = []
        for state, (out, ends) in enumerate(zip(arcs, final)):
            number = int(ends)
            for byte, to in out:
                rows.append(((start - state) * 256 + byte, start - to, number))
                number += below[to]
            below[state] = number
        rows.sort()
        keys, target, output = (np.array(x, dtype=np.int64) for x in (zip(*rows) if rows else ((), (), ())))
        return cls(keys, target, output, np.array(final[::-1], dtype=bool), longest)

    def to_bytes(self) -> bytes:
        head = np.array([len(self.keys), len(self.final), self.longest], dtype="<i8")
        return head.tobytes() + np.concatenate([self.keys, self.target, self.output]).astype("<i8").tobytes() + self.final.tobytes()

    @classmethod
    def from_bytes(cls, raw: bytes) -> Transducer:
        arcs, _, longest = np.frombuffer(raw, dtype="<i8", count=3).tolist()
        numbers = np.frombuffer(raw, dtype="<i8", count=3 * arcs, offset=24).reshape(3, arcs)
        return cls(*numbers, np.frombuffer(raw, dtype=bool, offset=24 + 24 * arcs), longest)

    def _step(self, state: np.ndarray, byte: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(arc, whether there is one) from each state by each byte."""
        key = state * 256 + byte
        arc = np.minimum(np.searchsorted(self.keys, key), max(0, len(self.keys) - 1))
        return arc, (self.keys[arc] == key) if len(self.keys) else np.zeros(len(key), dtype=bool)

    def numbers(self, words: bytes, prefix: bytes = b"") -> np.ndarray:
        """The number of each of the words, which stand in ``words`` with gaps between them, behind ``prefix``; -1 where there is none."""
        codes = np.frombuffer(words + GAP, dtype=np.uint8)
        ends = np.flatnonzero(codes == GAP[0])
        starts = np.append(0, ends[:-1] + 1)
        state, passed = 0, 0
        for byte in prefix:
            arc, there = self._step(np.array([state]), np.array([byte]))
            if not there[0]:
                return np.full(len(ends), -1)
            state, passed = int(self.target[arc[0]]), passed + int(self.output[arc[0]])
        states, number = np.full(len(ends), state), np.full(len(ends), passed)
        length = ends - starts
        alive = np.flatnonzero(length <= self.longest - len(prefix))
        number[length > self.longest - len(prefix)] = -1
        at = 0
        while len(alive := alive[length[alive] > at]):
            arc, there = self._step(states[alive], codes[starts[alive] + at].astype(np.int64))
            number[alive[~there]] = -1
            alive, arc = alive[there], arc[there]
            states[alive] = self.target[arc]
            number[alive] += self.output[arc]
            at += 1
        number[(number >= 0) & ~self.final[states]] = -1
        return number

    def word(self, number: int) -> bytes:
        """The word of a number: at each state the last arc that does not pass over it."""
        state, rest, out = 0, number, bytearray()
        while not (self.final[state] and rest == 0):
            a, z = np.searchsorted(self.keys, [state * 256, state * 256 + 256])
            arc = a + int(np.searchsorted(self.output[a:z], rest, side="right")) - 1
            out.append(int(self.keys[arc]) - state * 256)
            state, rest = int(self.target[arc]), rest - int(self.output[arc])
        return bytes(out)


def shards_of(words: Iterator[bytes], most: int) -> Iterator[tuple[bytes, int, bytes]]:
    """``(first word, number of words, transducer)`` for stretches of at most ``most`` of the ascending words."""
    held: list[bytes] = []
    for word in words:
        held.append(word)
        if len(held) == most:
            yield held[0], len(held), Transducer.build(held).to_bytes()
            held = []
    if held:
        yield held[0], len(held), Transducer.build(held).to_bytes()
