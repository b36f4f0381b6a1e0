"""Near-duplicate vectors by a forest of random-projection trees with spill."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rareflow.llm.common import settled, smallest_in_set
from rareflow.llm.components import components

MIN_COSINE = 0.98
TREES = 3
#: Vectors that are compared in one go; a larger node is split on.
LEAF_ROWS = 2_000
#: Vectors of a node, chosen by their hashes, that its splits are made from, and levels split before nodes are counted anew.
SAMPLE_ROWS, LEVELS = 4_000, 5
#: Half width of the strip around a split whose vectors go to both sides, as a share of the distance that a link spans at most.
SPILL = 0.12
#: Countings of the nodes; what is still too large then is compared in blocks.
ROUNDS = 12
SEED = 5


def _unit(vectors: np.ndarray) -> np.ndarray:
    return vectors / np.sqrt(np.einsum("ij,ij->i", vectors, vectors))[:, None]


def _direction(tree: int, node: int, width: int) -> np.ndarray:
    """The random unit vector of a tree's node."""
    found = np.random.default_rng([SEED, tree, node % (1 << 63)]).standard_normal(width)
    return found / np.linalg.norm(found)


def _child(node: int, right: bool) -> int:
    """Number of a node's child: 63 hash bits, so that a path of any length is one number."""
    mixed = ((node * 2 + int(right) + 1) * 0x9E3779B97F4A7C15) % (1 << 64)
    mixed = ((mixed ^ (mixed >> 29)) * 0xBF58476D1CE4E5B9) % (1 << 64)
    return (mixed ^ (mixed >> 32)) >> 1


def _splits(tree: int, node: int, vectors: np.ndarray, wanted: int, reach: float) -> list[tuple[int, float]]:
    """Nodes below ``node`` that split, with their thresholds: medians over the sample, a level per halving wanted."""
    found, front = [], [(node, vectors)]
    for _ in range(wanted):
        deeper = []
        for at, mine in front:
            if len(mine) < 2:
                continue
            along = mine @ _direction(tree, at, mine.shape[1])
            cut = float(np.median(along))
            left, right = mine[along <= cut + reach], mine[along > cut - reach]
            if max(len(left), len(right)) > 0.9 * len(mine):
                continue  # nearly all lie within the strip, a split would only copy them
            found.append((at, cut))
            deeper += [(_child(at, False), left), (_child(at, True), right)]
        front = deeper
    return found


def _leaves(tree: int, node: int, vectors: np.ndarray, cuts: dict[int, float], reach: float) -> Iterator[tuple[int, np.ndarray]]:
    """(node, rows) where the rows come to rest; rows in a split's strip go both ways."""
    front = [(node, np.arange(len(vectors)))]
    while front:
        at, rows = front.pop()
        if at not in cuts:
            yield at, rows
            continue
        along = vectors[rows] @ _direction(tree, at, vectors.shape[1])
        for right in (False, True):
            mine = rows[along > cuts[at] - reach] if right else rows[along <= cuts[at] + reach]
            if len(mine):
                front.append((_child(at, right), mine))


def vector_classes(vectors: DataFrame) -> DataFrame:
    """``(label, vector, doc, copies)``: distinct vectors that can link at all, their smallest id and how many rows have them."""
    values = F.transform("embedding", lambda x: x.cast("double"))
    rows = vectors.select(F.col("vec_id").cast("long").alias("doc"), "label", values.alias("vector"))
    fine = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    fine = fine & F.exists("vector", lambda x: x != 0)
    rows = rows.where(F.col("label").isNotNull() & F.col("vector").isNotNull() & fine & F.col("doc").isNotNull())
    return rows.groupBy("label", "vector").agg(F.min("doc").alias("doc"), F.count("*").alias("copies"))


def _matrix(column: pd.Series) -> np.ndarray:
    return np.stack([np.asarray(v, dtype=np.float64) for v in column])


def _linked_in(table: pd.DataFrame, leaf: int, across: bool, min_cosine: float) -> tuple[np.ndarray, np.ndarray]:
    """For each row of a leaf (or of two blocks of one) the copies that it links with first here, and the smallest row linked by steps.

    Two vectors may meet in several leaves; a pair is counted in the first that both are in, which their lists of leaves tell.
    """
    vectors = _matrix(table["vector"])
    norms = np.sqrt(np.einsum("ij,ij->i", vectors, vectors))
    doc, copies, block = (table[c].to_numpy() for c in ("doc", "copies", "mine"))
    lists = [np.asarray(x, dtype=np.int64) for x in table["leaves"]]
    flat, owner = np.concatenate(lists), np.repeat(np.arange(len(lists)), [len(x) for x in lists])
    before = flat < leaf
    names, column = np.unique(flat[before], return_inverse=True)
    held = np.zeros((len(doc), len(names)), dtype=np.float32)
    held[owner[before], column] = 1
    held = held[:, held.sum(axis=0) > 1]
    counts, root = np.zeros(len(doc), dtype=np.int64), np.arange(len(doc))
    for a in range(0, len(doc), 1_000):
        near = (vectors[a : a + 1_000] @ vectors.T) / (norms[a : a + 1_000, None] * norms) >= min_cosine
        near &= doc[a : a + 1_000, None] != doc
        if across:
            near &= block[a : a + 1_000, None] != block
        i, j = np.nonzero(near)
        # links found so far are folded into the roots, so no list of all pairs is kept
        root = smallest_in_set(len(doc), np.concatenate([np.arange(len(doc)), a + i]), np.concatenate([root, j]))
        if held.shape[1]:
            near &= held[a : a + 1_000] @ held.T == 0
        counts[a : a + 1_000] += near @ copies
    return counts, root


def near_links(classes: DataFrame, min_cosine: float = MIN_COSINE, trees: int = TREES, leaf_rows: int = LEAF_ROWS) -> DataFrame:
    """``(doc, n, root)`` rows over classes of one label and vector length whose cosine reaches ``min_cosine``.

    The sum of ``n`` is how many rows of other classes the class ``doc`` links with, and all ``(doc, root)`` together hold the classes
    that hang together. A leaf writes one row for each class that links there, however many pairs that makes.

    Each label and length is the root of ``trees`` trees. A node with more than ``leaf_rows`` vectors is split at medians along random directions,
    taken from a sample of it, a few levels at a time; vectors near a split go to both sides, so a close pair is
    rarely parted and hardly ever in all trees. Every vector is put into every tree. Nodes that no split makes smaller, as of
    thousands of vectors that all link, are compared whole: their rows are dealt to blocks, and every two blocks meet in
    a task of their own. All pairs within leaves are verified by their cosine in double precision.
    """
    width = np.sqrt(max(0.0, 2 - 2 * min_cosine))
    reach = SPILL * width
    node = F.explode(F.sequence(F.lit(0), F.lit(trees - 1))).alias("tree")
    label = F.concat_ws(":", F.size("vector"), F.col("label").cast("string")).alias("label")
    rows = classes.select(label, node, F.lit(1).cast("long").alias("node"), F.xxhash64("doc", "vector").alias("place"), "doc", "copies", "vector")
    keys = ["label", "tree", "node"]

    def plan(key, table: pd.DataFrame) -> pd.DataFrame:
        _, tree, at = key
        wanted = int(min(LEVELS, np.ceil(np.log2(table["rows"].iloc[0] / leaf_rows))))
        found = _splits(int(tree), int(at), _unit(_matrix(table["vector"])), wanted, reach)
        return pd.DataFrame({
            "label": key[0], "tree": tree, "node": at, "heads": [[h for h, _ in found]], "cuts": [[c for _, c in found]]
        })

    def route(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for (tree, at), part in batch.groupby(["tree", "node"], sort=False).indices.items():
                # all rows of a label's node have its splits, and vectors of one length
                for label, mine in batch.iloc[part].groupby("label", sort=False).indices.items():
                    mine = part[mine]
                    first = batch.iloc[mine[0]]
                    cuts = dict(zip(list(first["heads"]), list(first["cuts"])))
                    vectors = _unit(_matrix(batch["vector"].iloc[mine]))
                    for leaf, which in _leaves(int(tree), int(at), vectors, cuts, reach):
                        out = batch.iloc[mine[which]][["label", "tree", "place", "doc", "copies", "vector"]]
                        yield out.assign(node=leaf, stuck=not cuts)

    leaves, schema = None, "label string, tree int, node long, place long, doc long, copies long, vector array<double>"
    rows = rows.withColumn("stuck", F.lit(False))
    for turn in range(ROUNDS):
        sizes = rows.groupBy(*keys).agg(F.count("*").alias("rows"))
        counted = settled(rows.join(sizes, keys), "nodes")
        large = (F.col("rows") > leaf_rows) & ~F.col("stuck") & F.lit(turn < ROUNDS - 1)
        rest = counted.where(~large)
        leaves = rest if leaves is None else leaves.unionByName(rest)
        rows = counted.where(large)
        if rows.isEmpty():
            break
        share = F.lit(float(SAMPLE_ROWS)) / F.col("rows")
        chosen = rows.where(F.pmod(F.xxhash64("place", F.lit(turn)), F.lit(1 << 20)) < share * (1 << 20))
        splits = chosen.select(*keys, "rows", "vector").groupBy(*keys).applyInPandas(plan, "label string, tree int, node long, heads array<long>, cuts array<double>")
        splits = settled(splits, "splits")
        joined = rows.drop("rows", "stuck").join(splits, keys)
        rows = joined.mapInPandas(route, f"{schema}, stuck boolean")

    leaves = settled(leaves.withColumn("leaf", F.xxhash64(*keys)), "leaves")
    lists = leaves.groupBy("label", "place").agg(F.collect_list("leaf").alias("leaves"))  # a few for each vector
    # a block is a share of a node's rows by their hash; two blocks meet in the group (low, high)
    blocks = F.ceil(F.col("rows") / F.lit(leaf_rows)).cast("long")
    mine = F.pmod(F.xxhash64("place", F.lit(-1)), blocks)
    dealt = leaves.join(lists, ["label", "place"])
    dealt = dealt.withColumn("mine", mine).withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), blocks - 1)))
    dealt = dealt.withColumn("low", F.least("mine", "other")).withColumn("high", F.greatest("mine", "other"))

    def compare(key, table: pd.DataFrame) -> pd.DataFrame:
        table = table.sort_values(["doc", "place"], kind="stable", ignore_index=True)
        counts, root = _linked_in(table, int(key[0]), key[1] != key[2], min_cosine)
        linked = (counts > 0) | (root != np.arange(len(root)))
        doc = table["doc"].to_numpy()
        return pd.DataFrame({"doc": doc[linked], "n": counts[linked], "root": doc[root[linked]]})

    grouped = dealt.select("leaf", "low", "high", "mine", "place", "doc", "copies", "vector", "leaves").groupBy("leaf", "low", "high")
    return grouped.applyInPandas(compare, "doc long, n long, root long")


def near_vectors(vectors: DataFrame, min_cosine: float = MIN_COSINE, trees: int = TREES, leaf_rows: int = LEAF_ROWS) -> DataFrame:
    """``(vec_id, n_links, component_id, kept)`` for each row of ``vectors(vec_id, embedding, label)``.

    ``n_links`` counts the other rows linked directly, copies included; ``component_id`` is the smallest vec_id reachable. Equal vectors
    of a label are compared once; labels may be of any type that can be cast to a string, and vectors of different lengths never link. Rows
    without a label or a usable vector (null, zero, null or non-finite components) link with none of the others; so do rows
    without a vec_id, whose component is null.
    """
    classes = settled(vector_classes(vectors), "classes")
    found = settled(near_links(classes, min_cosine, trees, leaf_rows), "links")
    linked = components(found.select(F.col("doc").alias("a"), F.col("root").alias("b")))
    counted = found.groupBy(F.col("doc").alias("a")).agg(F.sum("n").alias("n"))
    named = classes.join(counted, classes["doc"] == counted["a"], "left").join(linked, classes["doc"] == linked["node"], "left")
    named = named.select(
        F.col("label").alias("of"),
        "vector",
        (F.col("copies") - 1 + F.coalesce("n", F.lit(0))).alias("n_links"),
        F.coalesce("component", "doc").alias("component_id"),
    )
    values = F.transform("embedding", lambda x: x.cast("double"))
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "label", values.alias("value"))
    joined = rows.join(named, (rows["label"] == named["of"]) & (rows["value"] == named["vector"]) & rows["vec_id"].isNotNull(), "left")
    component = F.coalesce("component_id", "vec_id")
    return joined.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"), (F.col("vec_id") == component).alias("kept"))
