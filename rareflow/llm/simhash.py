"""SimHash near-duplicates through a Gray-order hierarchical index."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rareflow.llm.common import by_key, free_name, settled, smallest_in_set, text_of
from rareflow.llm.components import components
from rareflow.llm.tokens import forget

SHINGLE_WORDS = 3
MAX_BITS = 3
#: Rows of one group of the index; larger groups are parted by further bits.
GROUP_ROWS = 2_000
#: Rows below each node of the index, from the top level down.
FANS = (256, 16, 1)
#: Queries that go down the index together.
QUERIES = 2_000
SEED = 42


def simhash(text: str, words: int = SHINGLE_WORDS) -> int:
    """64 bits, each 1 if set in more than half the hashes of the text's word shingles; 0 without a word."""
    parts = text.encode("utf-8", "surrogatepass").lower().split()
    if not parts:
        return 0
    joined = b" ".join(parts)
    ends = np.cumsum([len(p) + 1 for p in parts]) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    k = min(words, len(parts))
    hashed = np.fromiter(
        (xxhash.xxh64_intdigest(joined[a:b], SEED) for a, b in zip(starts[: len(parts) - k + 1].tolist(), ends[k - 1 :].tolist())),
        dtype="<u8",
        count=len(parts) - k + 1,
    )
    counts = np.zeros(64, dtype=np.int64)
    for at in range(0, len(hashed), 100_000):
        bits = np.unpackbits(hashed[at : at + 100_000].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(counts * 2 > len(hashed), bitorder="little").view("<u8")[0])


def gray_rank(codes: np.ndarray) -> np.ndarray:
    """Place of each code in the reflected Gray sequence, where neighbours differ in one bit."""
    rank = codes.astype(np.uint64)
    for shift in (1, 2, 4, 8, 16, 32):
        rank = rank ^ (rank >> np.uint64(shift))
    return rank


def near_pairs(codes: np.ndarray, groups: np.ndarray, max_bits: int = MAX_BITS) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs (i < j) within a group whose codes differ in at most ``max_bits`` bits.

    ``groups`` must be ascending and ``codes`` in Gray order within each group. Consecutive
    codes hang below a node that holds the bits they all share (mask and pattern); a query adds the differences in the
    bits that a node newly shares to those of the node above and leaves the whole node as soon as they exceed the bound.
    """
    n = len(codes)
    first = np.concatenate([[True], groups[1:] != groups[:-1]])
    start = np.flatnonzero(first)
    number = np.cumsum(first) - 1
    place = np.arange(n) - start[number]
    size = np.diff(np.append(start, n))
    levels, above = [], None
    for fan in FANS:
        head = np.flatnonzero(first | (place % fan == 0))
        together = np.bitwise_and.reduceat(codes, head)
        either = np.bitwise_or.reduceat(codes, head)
        mask = ~(together ^ either)
        if above is None:
            fresh, child = mask, None
        else:
            up = np.searchsorted(above[0], head, side="right") - 1
            fresh = mask & ~above[1][up]
            child = np.searchsorted(head, np.append(above[0], n))
        levels.append((fresh, together & mask, child))
        above = (head, mask)
        if len(levels) == 1:
            tops = np.searchsorted(head, np.append(start, n))
    found = [_search(levels, codes, np.arange(at, min(n, at + QUERIES)), tops, number, max_bits) for at in range(0, n, QUERIES)]
    left, right = (np.concatenate(x) if x else np.zeros(0, dtype=np.int64) for x in (list(zip(*found)) or ([], [])))
    return left, right


def _search(levels, codes, query, tops, number, max_bits):
    """Pairs (query, later code) found by going down the levels with the differences so far."""
    roots = np.diff(tops)[number[query]]
    node = _ranges(tops[number[query]], roots)
    query = np.repeat(query, roots)
    apart = np.zeros(len(query), dtype=np.int64)
    for depth, (fresh, pattern, _) in enumerate(levels):
        apart = apart + np.bitwise_count((codes[query] ^ pattern[node]) & fresh[node])
        near = apart <= max_bits
        query, node, apart = query[near], node[near], apart[near]
        if depth + 1 < len(levels):
            child = levels[depth + 1][2]
            width = child[node + 1] - child[node]
            query, apart = np.repeat(query, width), np.repeat(apart, width)
            node = _ranges(child[node], width)
    ahead = query < node
    return query[ahead], node[ahead]


def _ranges(starts, widths):
    """The numbers start..start+width-1 of each pair, one after the other."""
    if not len(starts):
        return np.zeros(0, dtype=np.int64)
    shift = np.repeat(starts - np.concatenate([[0], np.cumsum(widths)[:-1]]), widths)
    return shift + np.arange(len(shift))


def fingerprints(docs: DataFrame, words: int = SHINGLE_WORDS, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``(doc_id, code)``: the SimHash of every whole text as a signed long; null and empty texts have 0."""
    return with_codes(docs.select(F.col(doc_id).cast("long").alias("doc_id"), text_of(text).alias("text")), words)


def with_codes(rows: DataFrame, words: int = SHINGLE_WORDS) -> DataFrame:
    """``rows``, which end in a ``text`` that is not null, with its SimHash ``code`` in the text's place."""
    names = [*rows.columns[:-1], "code"]

    def codes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        for batch in batches:
            found = np.array([simhash(t.as_py(), words) for t in batch.column("text")], dtype=np.uint64)
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(found.view(np.int64))], names=names)

    kinds = dict(rows.dtypes) | {"code": "long"}
    return rows.mapInArrow(codes, ", ".join(f"{n} {kinds[n]}" for n in names))


def _parts(bits: list[int], count: int) -> list[int]:
    """The bits dealt into ``count`` masks of consecutive bits."""
    cuts = [len(bits) * i // count for i in range(count + 1)]
    return [sum(1 << b for b in bits[a:z]) for a, z in zip(cuts, cuts[1:])]


def _signed(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


def near_links(codes: DataFrame, max_bits: int = MAX_BITS, group_rows: int = GROUP_ROWS) -> DataFrame:
    """Links ``(a, b)`` between the ``doc`` of distinct ``(code, doc)`` rows that hold together all codes within ``max_bits`` bits.

    Two codes that differ in at most k bits agree in one of k + 1 parts of their bits, so the shared
    masked pattern of a part is the uppermost node of the distributed index. Nodes with more than ``group_rows``
    codes are parted again by the bits that are left, until a node is small or too few bits are left to hold more codes; below, each
    group is indexed in Gray order. A group gives a star for each of its components, never all pairs.
    """
    ways = max_bits + 1
    rows = codes.select("code", "doc", F.explode(F.lit([_signed(m) for m in _parts(list(range(64)), ways)])).alias("mask"))
    rows = rows.withColumn("pattern", F.col("code").bitwiseAND(F.col("mask")))
    small = None
    while True:
        sizes = rows.groupBy("mask", "pattern").agg(F.count("*").alias("rows")).where("rows > 1")
        sized = settled(rows.join(sizes, ["mask", "pattern"]), "simhash")
        large = (F.col("rows") > group_rows) & (F.bit_count("mask") < 64 - 11)
        done = sized.where(~large)
        small = done if small is None else small.unionByName(done)
        masks = [r["mask"] for r in sized.where(large).select("mask").distinct().collect()]  # bounded by the number of masks
        if not masks:
            break
        finer = {}
        for mask in masks:
            free = [b for b in range(64) if not (mask >> b) & 1]
            finer[mask] = [_signed((mask % (1 << 64)) | part) for part in _parts(free, ways)]
        pick = F.create_map(*[c for m, parts in finer.items() for c in (F.lit(m), F.lit(parts))])
        rows = sized.where(large).select("code", "doc", F.explode(pick[F.col("mask")]).alias("mask"))
        rows = rows.withColumn("pattern", F.col("code").bitwiseAND(F.col("mask")))

    def stars(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for bundle in by_key(batches, ["mask", "pattern"], 20_000):
            code = bundle["code"].to_numpy().astype(np.int64).view(np.uint64)
            keys = bundle[["mask", "pattern"]].to_numpy(dtype=np.int64)
            group = np.cumsum(np.concatenate([[True], (keys[1:] != keys[:-1]).any(axis=1)]))
            order = np.lexsort((gray_rank(code), group))
            doc = bundle["doc"].to_numpy()[order]
            left, right = near_pairs(code[order], group[order], max_bits)
            by_doc = np.argsort(doc, kind="stable")
            place = np.empty(len(doc), dtype=np.int64)
            place[by_doc] = np.arange(len(doc))
            root = smallest_in_set(len(doc), place[left], place[right])
            linked = root != np.arange(len(root))
            yield pd.DataFrame({"a": doc[by_doc][linked], "b": doc[by_doc][root[linked]]})

    keyed = small.select("mask", "pattern", "code", "doc").repartition("mask", "pattern")
    return keyed.sortWithinPartitions("mask", "pattern").mapInPandas(stars, "a long, b long").distinct()


def simhash_components(
    docs: DataFrame, words: int = SHINGLE_WORDS, max_bits: int = MAX_BITS, group_rows: int = GROUP_ROWS
) -> DataFrame:
    """``(doc_id, code, component_id)`` per row: component_id is the smallest doc_id reachable over links.

    Equal codes are one node, named by its smallest doc_id, so copies cost one row each and no link.
    A null doc_id takes part with its code but never names a component; rows that reach no
    doc_id have a null component. Repeated rows stay. An empty table gives no rows.
    """
    codes = settled(fingerprints(docs, words), "codes")
    nodes = codes.groupBy("code").agg(F.min("doc_id").alias("doc"))
    # a code that only rows without doc_id have still links others; a name below all ids would clash, so one above them
    nodes = settled(nodes.select("code", "doc", F.coalesce("doc", F.lit(2**62) + F.pmod("code", F.lit(2**61))).alias("name")), "nodes")
    linked = components(near_links(nodes.select("code", F.col("name").alias("doc")), max_bits, group_rows))
    named = nodes.join(linked, nodes["name"] == linked["node"], "left")
    found = F.coalesce("component", "name")
    found = F.when(F.col("doc").isNotNull() | (found < 2**62), found)
    return codes.join(named.select("code", found.alias("component_id")), "code").select("doc_id", "code", "component_id")


def one_of_each(docs: DataFrame, words: int = SHINGLE_WORDS, max_bits: int = MAX_BITS) -> DataFrame:
    """The rows of ``docs`` but for all near copies: of each component one row stays, with all its columns.

    That is the row with the smallest doc_id (one without comes last), of several with it the one with the smallest hash
    over all columns; of wholly equal rows one stays. So repeated rows and rows without a doc_id go like any other copy. Rows
    without a word have the code zero and are copies of each other, and an empty table stays empty. Columns that hold a map cannot tell
    rows apart.
    """
    hashed = F.xxhash64(*[F.col(f"`{c}`") for c, kind in docs.dtypes if "map<" not in kind])
    key = {"no_id": F.col("doc_id").isNull(), "id": F.coalesce(F.col("doc_id").cast("long"), F.lit(0)), "hash": hashed}
    rows = docs.select(*[c.alias(n) for n, c in key.items()], text_of().alias("text"))
    rows = settled(with_codes(rows, words), "codes")
    nodes = settled(rows.groupBy("code").agg(F.min(F.struct(*key)).alias("best")), "nodes")
    linked = components(near_links(nodes.select("code", F.col("code").alias("doc")), max_bits))
    named = nodes.join(linked, nodes["code"] == linked["node"], "left").select(F.coalesce("component", "code").alias("component"), "best")
    chosen = named.groupBy("component").agg(F.min("best").alias("best"))
    names = {n: free_name(docs, f"one_{n}") for n in key}
    chosen = chosen.select(*[F.col(f"best.{n}").alias(names[n]) for n in key])
    kept = docs.withColumns({names[n]: c for n, c in key.items()}).join(chosen, list(names.values()), "left_semi")
    return kept.dropDuplicates(list(names.values())).select(*[F.col(f"`{c}`") for c in docs.columns])
