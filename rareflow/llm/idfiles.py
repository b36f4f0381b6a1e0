"""Files of token ids in Simple-8b blocks."""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from rareflow.llm.common import text_of
from rareflow.llm.tokens import encode_in_parts, vocabulary, with_end

TOKENIZER = "word_bpe_49k.json"
#: Ids that close a block; documents are never parted between blocks.
BLOCK_IDS = 1 << 16

# fixed values: how many ids a 64-bit word holds and how many bits each takes, by selector
SELECTORS = (
    (60, 1), (30, 2), (20, 3), (15, 4), (12, 5), (10, 6), (8, 7), (7, 8), (6, 10), (5, 12), (4, 15), (3, 20), (2, 30), (1, 60),
)
MAGIC = b"S8B1"
#: What stands for an id too large for a word; the id itself is in the block's list of escapes.
ESCAPE = (1 << 60) - 1
_HEAD = struct.Struct("<4sIIII")


_BITS = np.zeros(1 << 16, dtype=np.uint8)
for _, _width in reversed(SELECTORS):
    _BITS[: 1 << min(_width, 16)] = _width


def _needed_bits(values: np.ndarray) -> np.ndarray:
    """Bits of each value, at least 1, rounded up to a width that a word has."""
    if not len(values) or int(values.max()) < len(_BITS):
        return _BITS[values]
    bits = np.ones(len(values), dtype=np.uint8)
    for _, width in SELECTORS[:-1]:
        bits = np.where(values >> np.uint64(width) > 0, width + 1, bits)
    return bits


def _window_max(values: np.ndarray, width: int, known: dict[int, np.ndarray]) -> np.ndarray:
    """Largest of the ``width`` values from each place on, from maxima over powers of two."""
    power = 1 << (width.bit_length() - 1)
    if power not in known:
        below = _window_max(values, power // 2, known)
        known[power] = np.maximum(below[: len(values) - power + 1], below[power // 2 :])
    top = known[power]
    return top if power == width else np.maximum(top[: len(values) - width + 1], top[width - power :])


def pack_words(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Words and escapes of unsigned 64-bit ids; each word takes as many of the next ids as fit."""
    values = values.astype(np.uint64)
    large = values >= np.uint64(ESCAPE)
    escapes = values[large]
    values = np.where(large, np.uint64(ESCAPE), values)
    n = len(values)
    bits = _needed_bits(values)
    selector = np.full(n, len(SELECTORS) - 1, dtype=np.int64)
    known = {1: bits}
    for s in range(len(SELECTORS) - 2, -1, -1):
        count, width = SELECTORS[s]
        if count > n:
            break
        selector[: n - count + 1][_window_max(bits, count, known) <= width] = s
    takes = np.array([c for c, _ in SELECTORS])[selector].tolist()
    heads, at = [], 0
    while at < n:
        heads.append(at)
        at += takes[at]
    heads = np.array(heads, dtype=np.int64)
    chosen = selector[heads] if n else np.zeros(0, dtype=np.int64)
    words = chosen.astype(np.uint64) << np.uint64(60)
    for s, (count, width) in enumerate(SELECTORS):
        mine = np.flatnonzero(chosen == s)
        for k in range(count if len(mine) else 0):
            words[mine] |= values[heads[mine] + k] << np.uint64(k * width)
    return words, escapes


def unpack_words(words: np.ndarray, escapes: np.ndarray) -> np.ndarray:
    """The ids again, all words of a selector at once."""
    selector = (words >> np.uint64(60)).astype(np.int64)
    counts = np.array([c for c, _ in SELECTORS])[selector]
    ends = np.cumsum(counts)
    values = np.empty(int(ends[-1]) if len(ends) else 0, dtype=np.uint64)
    for s, (count, width) in enumerate(SELECTORS):
        mine = np.flatnonzero(selector == s)
        if len(mine):
            shifts = (np.arange(count) * width).astype(np.uint64)
            values[(ends[mine] - count)[:, None] + np.arange(count)] = (words[mine, None] >> shifts) & np.uint64((1 << width) - 1)
    values[values == np.uint64(ESCAPE)] = escapes
    return values


def write_block(docs: list[int | None], counts: np.ndarray, ids: np.ndarray) -> bytes:
    """One block: sizes, null flags, doc_ids, ids per document, words, escapes."""
    words, escapes = pack_words(ids)
    nulls = np.array([d is None for d in docs], dtype=np.uint8)
    numbers = np.array([d or 0 for d in docs], dtype="<i8")
    head = _HEAD.pack(MAGIC, len(docs), len(ids), len(words), len(escapes))
    return head + b"".join(
        (nulls.tobytes(), numbers.tobytes(), np.asarray(counts, dtype="<u4").tobytes(), words.astype("<u8").tobytes(), escapes.astype("<u8").tobytes())
    )


def read_block(data: bytes) -> tuple[list[int | None], np.ndarray, np.ndarray]:
    """Documents, ids per document, and all ids of a block."""
    magic, n_docs, n_ids, n_words, n_escapes = _HEAD.unpack_from(data)
    if magic != MAGIC:
        raise ValueError("not a block of token ids")
    at, parts = _HEAD.size, []
    for kind, n in (("u1", n_docs), ("<i8", n_docs), ("<u4", n_docs), ("<u8", n_words), ("<u8", n_escapes)):
        parts.append(np.frombuffer(data, dtype=kind, count=n, offset=at))
        at += parts[-1].nbytes
    nulls, numbers, counts, words, escapes = parts
    ids = unpack_words(words, escapes)
    if len(ids) != n_ids:
        raise ValueError("the block's words do not hold its ids")
    return [None if null else d for null, d in zip(nulls.tolist(), numbers.tolist())], counts.astype(np.int64), ids


def write_ids(docs: DataFrame, out: str, path: str | None = None, partitions: int | None = None, block: int = BLOCK_IDS) -> None:
    """Write all texts' ids, each with the end id, in ascending doc_id order to the folder ``out``.

    A file is a Parquet container of rows ``(part, start, docs, ids, block)``: ``start`` is the number of ids before the block in
    its part, so any block can be read on its own. Null texts are empty; null doc_ids come first, equal ones follow by text.
    The order comes from ranges of doc_id, one shuffle of the texts; a task holds one block.
    """
    path = path or vocabulary(TOKENIZER)
    wide = partitions or int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        part, start = TaskContext.get().partitionId(), 0
        for batch in batches:
            numbers = [None if pd.isna(d) else int(d) for d in batch["doc_id"]]
            for a, z, ids, counts in encode_in_parts(path, batch["text"].tolist()):
                ids, counts = with_end(ids, counts)
                ends = np.concatenate([[0], np.cumsum(counts)])
                at = 0
                while at < len(counts):
                    to = min(len(counts), int(np.searchsorted(ends, ends[at] + block)))
                    to = max(to, at + 1)
                    data = write_block(numbers[a + at : a + to], counts[at:to], ids[ends[at] : ends[to]])
                    held = int(ends[to] - ends[at])
                    yield pd.DataFrame({"part": [part], "start": [start], "docs": [to - at], "ids": [held], "block": [data]})
                    start, at = start + held, to

    ordered = rows.repartitionByRange(wide, "doc_id", F.xxhash64("text")).sortWithinPartitions("doc_id", "text")
    blocks = ordered.mapInPandas(run, "part long, start long, docs long, ids long, block binary")
    blocks.write.option("compression", "zstd").mode("overwrite").parquet(out)


def read_ids(spark: SparkSession, path: str) -> DataFrame:
    """``(doc_id, start, n_tokens, ids)`` of every document in the files: ``start`` counts the ids of all documents before it."""
    blocks = spark.read.parquet(path)
    # one row for each range of the writer, so the running total over all is over few rows
    parts = blocks.groupBy("part").agg(F.sum("ids").alias("n"))
    before = W.orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    parts = parts.select(F.col("part").alias("of"), F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for part, start, data in zip(batch["part"], batch["start"], batch["block"]):
                docs, counts, ids = read_block(data)
                ends = np.cumsum(counts)
                yield pd.DataFrame({
                    "part": part,
                    "doc_id": pd.array(docs, dtype="Int64"),
                    "in_part": start + ends - counts,
                    "n_tokens": counts,
                    "ids": np.split(ids.astype(np.int64), ends[:-1]),
                })

    read = blocks.select("part", "start", "block").mapInPandas(run, "part long, doc_id long, in_part long, n_tokens long, ids array<long>")
    joined = read.join(parts, read["part"] == parts["of"])
    return joined.select("doc_id", (F.col("before") + F.col("in_part")).alias("start"), "n_tokens", "ids")


def read_digests(spark: SparkSession, path: str) -> DataFrame:
    """``(doc_id, start, n_tokens, ids_crc32)``: as ``read_ids``, with the checksum of the ids as 32-bit integers in their place."""
    blocks = spark.read.parquet(path)
    parts = blocks.groupBy("part").agg(F.sum("ids").alias("n"))
    before = W.orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    parts = parts.select(F.col("part").alias("of"), F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for part, start, data in zip(batch["part"], batch["start"], batch["block"]):
                docs, counts, ids = read_block(data)
                raw, ends = ids.astype("<u4"), np.cumsum(counts)
                crc = [zlib.crc32(raw[a:z].tobytes()) for a, z in zip((ends - counts).tolist(), ends.tolist())]
                yield pd.DataFrame({
                    "part": part,
                    "doc_id": pd.array(docs, dtype="Int64"),
                    "in_part": start + ends - counts,
                    "n_tokens": counts,
                    "ids_crc32": crc,
                })

    read = blocks.select("part", "start", "block").mapInPandas(run, "part long, doc_id long, in_part long, n_tokens long, ids_crc32 long")
    joined = read.join(parts, read["part"] == parts["of"])
    return joined.select("doc_id", (F.col("before") + F.col("in_part")).alias("start"), "n_tokens", "ids_crc32")
