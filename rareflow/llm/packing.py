"""Order-preserving packing of documents into windows by dynamic programming."""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from rareflow.llm.common import text_of
from rareflow.llm.tokens import encode_in_parts, vocabulary, with_end

WINDOW = 2048
TOKENIZER = "byte_bpe_50k.json"
#: Price of a cut in padding tokens: behind a sentence, and inside one. A cut behind a document is free.
SENTENCE_CUT = 2
INNER_CUT = 8
#: Tokens that one run of the programme sees; documents are never parted between runs.
BLOCK_TOKENS = 1 << 18
FAR = np.int64(1) << 40


@cache
def sentence_ends(path: str) -> np.ndarray:
    """For each id whether its token ends a sentence or a line; made once for each file and worker."""
    tokenizer = Tokenizer.from_file(path)
    ends = np.zeros(tokenizer.get_vocab_size(), dtype=bool)
    for token, i in tokenizer.get_vocab().items():
        # \\u010a is how byte-level vocabularies write the line feed
        ends[i] = token.endswith((".", "!", "?", "Ċ"))
    return ends


def cut_windows(price: np.ndarray, window: int = WINDOW) -> np.ndarray:
    """Cuts 0 < c1 < ... < n = len(price) with the least padding plus price, ``price[j]`` for a cut behind token j.

    The best cost of a cut at j is its price plus the smallest of cost[i] + window - (j - i) over the starts i with
    half a window < j - i <= window, or of cost[j - half] for a window of half the length, which needs no padding. The minimum over
    the sliding range of starts is that of a monotone queue, kept as two stacks: suffix minima of the starts that leave the range
    during a stretch of half a window, and prefix minima of those that enter it. All costs of a stretch so follow at once.

    What is left behind the last such cut is written as windows of falling powers of two, which need no padding.
    """
    n, half = len(price), window // 2
    cost = np.full(n + 1, FAR, dtype=np.int64)
    back = np.zeros(n + 1, dtype=np.int64)
    cost[0] = 0
    prices = np.concatenate([[0], price])
    queue = np.full(n + window + 1, FAR, dtype=np.int64)  # (cost[i] + i) with i in its low bits, shifted by a window
    places = np.arange(n + 1)
    bits = max(1, int(n).bit_length())
    queue[window] = 0
    for a in range(half, n + 1, half):
        j = places[a : a + half]
        width = len(j)
        leaving = np.minimum.accumulate(queue[window + a - window : window + a - half][::-1])[::-1][:width]
        entering = queue[window + a - half : window + a - 1]
        both = leaving.copy()
        if width > 1:
            both[1:] = np.minimum(leaving[1:], np.minimum.accumulate(entering)[: width - 1])
        best = (both >> bits) + window - j
        start = both & ((1 << bits) - 1)
        exact = cost[j - half]
        shorter = exact <= best
        cost[j] = np.minimum(np.minimum(exact, best) + prices[j], FAR)
        back[j] = np.where(shorter, j - half, start)
        queue[window + j] = np.where(cost[j] < FAR, ((cost[j] + j) << bits) | j, FAR << 20)
    last = places[max(0, n - window + 1) :]
    rest = n - last
    total = cost[last] + INNER_CUT * np.bitwise_count(rest.astype(np.uint64)).astype(np.int64)
    at = int(last[np.argmin(total)])
    tail, to = [], at
    for power in range(window.bit_length() - 1, -1, -1):
        if (n - at) >> power & 1:
            to += 1 << power
            tail.append(to)
    cuts = []
    while at > 0:
        cuts.append(at)
        at = int(back[at])
    return np.array(cuts[::-1] + tail, dtype=np.int64)


def _pieces(ids, counts, docs, ends_sentence, window, first_window):
    """The pieces of a block of documents as columns, and how many windows they take."""
    n = len(ids)
    price = np.where(ends_sentence[np.minimum(ids, len(ends_sentence) - 1)], SENTENCE_CUT, INNER_CUT)
    doc_end = np.cumsum(counts)
    price[doc_end - 1] = 0
    cuts = cut_windows(price, window)
    edges = np.union1d(np.concatenate([[0], doc_end]), cuts)
    start, stop = edges[:-1], edges[1:]
    doc = np.searchsorted(doc_end, start, side="right")
    number = np.searchsorted(cuts, start, side="right")
    window_start = np.concatenate([[0], cuts])[number]
    raw = ids.astype("<u4")
    made = {
        "doc_id": [docs[d] for d in doc.tolist()],
        "start": start - (doc_end - counts)[doc],
        "length": stop - start,
        "ids": [raw[a:z].tobytes() for a, z in zip(start.tolist(), stop.tolist())],
        "doc_tokens": counts[doc],
        "sequence_id": first_window + number,
        "offset": start - window_start,
    }
    frame = pd.DataFrame(made)
    frame["doc_id"] = frame["doc_id"].astype("Int64")
    if n != int(frame["length"].sum()):
        raise RuntimeError("the pieces do not hold all ids of a block")
    return frame, len(cuts)


def pack(
    docs: DataFrame, path: str | None = None, window: int = WINDOW, partitions: int | None = None, block: int = BLOCK_TOKENS
) -> DataFrame:
    """Pieces ``(doc_id, start, length, ids, doc_tokens, sequence_id, offset)`` of all documents.

    ``ids`` holds the piece's token ids as little-endian unsigned 32-bit integers; a sequence is its pieces' ids by ``offset``.

    Documents follow each other by doc_id (null first, equal ones by text); each has the ids of its whole text and the end id, a null
    text as an empty one has the end id alone. Sequences hold ``window`` ids at most and are gapless; cuts fall behind documents or sentences where
    that is cheaper than the padding. ``sequence_id`` ascends with the documents and leaves gaps between the ranges that were packed apart.
    Repeated rows are packed each; an empty table gives no rows.

    The order comes from ranges of doc_id, one shuffle of the texts; each range is packed as a stream in blocks, so a task holds one block.
    """
    path = path or vocabulary(TOKENIZER)
    wide = partitions or int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        ends_sentence = sentence_ends(path)
        first = TaskContext.get().partitionId() << 40
        held_ids, held_counts, held_docs, held = [], [], [], 0
        for batch in batches:
            docs_of = [None if pd.isna(d) else int(d) for d in batch["doc_id"]]
            for a, z, ids, counts in encode_in_parts(path, batch["text"].tolist()):
                ids, counts = with_end(ids, counts)
                held_ids.append(ids)
                held_counts.append(counts)
                held_docs += docs_of[a:z]
                held += len(ids)
                if held >= block:
                    frame, used = _pieces(np.concatenate(held_ids), np.concatenate(held_counts), held_docs, ends_sentence, window, first)
                    yield frame
                    first += used
                    held_ids, held_counts, held_docs, held = [], [], [], 0
        if held:
            yield _pieces(np.concatenate(held_ids), np.concatenate(held_counts), held_docs, ends_sentence, window, first)[0]

    ordered = rows.repartitionByRange(wide, "doc_id", F.xxhash64("text")).sortWithinPartitions("doc_id", "text")
    schema = "doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long"
    return ordered.mapInPandas(run, schema)
