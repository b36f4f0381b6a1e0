"""Nearest vectors by cosine, through a vantage-point tree in each shard of the vectors."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rareflow.llm.common import settled

NEAREST = 5
#: Vectors of a shard, on the average; a shard is one tree.
SHARD_ROWS = 8_192
#: Vectors of a leaf, which are compared with a query one and all.
LEAF_ROWS = 256
#: Queries that go down a tree in one task; the tree is sent once for each such slab.
SLAB_ROWS = 20_000
#: By how much the reach of a query is divided before a subtree is pruned; 1 is the exact search.
RELAXED = 1.0
#: Vantage points that are tried for a node, and vectors that they are judged by.
TRIED, JUDGED = 8, 64
#: Allowance for rounding when distances are compared.
ROUNDING = 1e-9
SEED = 11


def usable(vectors: DataFrame) -> DataFrame:
    """Distinct ``(vec_id, vector, size)`` of the rows that can be compared: an id and finite components that are not all zero."""
    values = F.transform("embedding", lambda x: x.cast("double"))
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), values.alias("vector"))
    fine = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    fine = fine & F.exists("vector", lambda x: x != 0)
    # -0.0 is the same component as 0.0
    rows = rows.where(F.col("vec_id").isNotNull() & fine).withColumn("vector", F.transform("vector", lambda x: x + F.lit(0.0)))
    return rows.distinct().withColumn("size", F.size("vector"))


def _matrix(column: pd.Series) -> np.ndarray:
    return np.stack([np.asarray(v, dtype=np.float64) for v in column])


def _unit(vectors: np.ndarray) -> np.ndarray:
    scaled = vectors / np.abs(vectors).max(axis=1)[:, None]  # so that no square overflows or vanishes
    return scaled / np.sqrt(np.einsum("ij,ij->i", scaled, scaled))[:, None]


def _dot(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    total = np.zeros(len(a))
    for k in range(a.shape[1]):
        total = total + a[:, k] * b[:, k]
    return total


def cosines(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The cosine of each row of ``a`` with the same row of ``b``, every pair summed up from the first component to the last."""
    scale_a, scale_b = np.abs(a).max(axis=1), np.abs(b).max(axis=1)
    plain = (np.minimum(scale_a, scale_b) > 1e-70) & (np.maximum(scale_a, scale_b) < 1e70)
    if not plain.all():
        a = np.where(plain[:, None], a, a / scale_a[:, None])
        b = np.where(plain[:, None], b, b / scale_b[:, None])
    return _dot(a, b) / np.sqrt(_dot(a, a) * _dot(b, b))


def _apart(rows: np.ndarray, point: np.ndarray) -> np.ndarray:
    """Distances of unit vectors: the chord, which grows as the cosine falls and obeys the triangle inequality."""
    gap = rows - point
    return np.sqrt(np.einsum("ij,ij->i", gap, gap))


class Tree:
    """A vantage-point tree as arrays; a node's rows are ``order[lo:hi]``, the nearer half of them first.

    ``inner`` is the number of the node's first child, or -1 for a leaf; the second child follows it. ``near`` and ``far`` bound
    the distances of the first and of the second child's rows from the vantage point: (lowest, highest) of each.
    """

    def __init__(self, order, lo, hi, inner, point, near, far) -> None:
        self.order, self.lo, self.hi, self.inner, self.point, self.near, self.far = order, lo, hi, inner, point, near, far

    @classmethod
    def build(cls, unit: np.ndarray, leaf_rows: int) -> Tree:
        """Halves every node by the distances from the vantage point, of some, from which they spread the most."""
        chosen = np.random.default_rng(SEED)
        order = np.arange(len(unit))
        nodes, at = [[0, len(unit), -1, -1, (0.0, 0.0), (0.0, 0.0)]], 0
        while at < len(nodes):
            lo, hi = nodes[at][:2]
            if hi - lo > leaf_rows:
                rows = order[lo:hi]
                tried = chosen.choice(rows, min(TRIED, len(rows)), replace=False)
                judged = unit[chosen.choice(rows, min(JUDGED, len(rows)), replace=False)]
                spread = [np.var(_apart(judged, unit[t])) for t in tried]
                point = int(tried[int(np.argmax(spread))])
                apart = _apart(unit[rows], unit[point])
                by_distance = np.argsort(apart, kind="stable")
                order[lo:hi], apart = rows[by_distance], apart[by_distance]
                half = (hi - lo) // 2
                nodes[at][2:] = len(nodes), point, (apart[0], apart[half - 1]), (apart[half], apart[-1])
                nodes += [[lo, lo + half, -1, -1, (0.0, 0.0), (0.0, 0.0)], [lo + half, hi, -1, -1, (0.0, 0.0), (0.0, 0.0)]]
            at += 1
        lo, hi, inner, point, near, far = zip(*nodes)
        return cls(order, np.array(lo), np.array(hi), np.array(inner), np.array(point), np.array(near), np.array(far))

    def to_row(self) -> dict[str, bytes]:
        numbers = [self.order, np.stack([self.lo, self.hi, self.inner, self.point], axis=1)]
        edges = np.concatenate([self.near, self.far], axis=1)
        return {"order": numbers[0].astype("<i4").tobytes(), "nodes": numbers[1].astype("<i4").tobytes(), "edges": edges.astype("<f8").tobytes()}

    @classmethod
    def from_row(cls, row) -> Tree:
        order, nodes = (np.frombuffer(row[c], dtype="<i4").astype(np.int64) for c in ("order", "nodes"))
        nodes, edges = nodes.reshape(-1, 4), np.frombuffer(row["edges"], dtype="<f8").reshape(-1, 4)
        return cls(order, *nodes.T, edges[:, :2], edges[:, 2:])


class Search:
    """The nearest rows of one tree for many queries, which go down it together."""

    def __init__(self, tree: Tree, ids, vectors, query_ids, queries, nearest: int, relaxed: float) -> None:
        self.tree, self.ids, self.vectors, self.unit = tree, ids, vectors, _unit(vectors)
        self.query_ids, self.queries, self.query_unit = query_ids, queries, _unit(queries)
        self.nearest, self.relaxed = nearest, relaxed
        self.score = np.full((len(queries), nearest), -np.inf)
        self.found = np.full((len(queries), nearest), np.iinfo(np.int64).max)
        self.tested = 0

    def run(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """``(query row, vec_id, score)`` of the rows found, not more than ``nearest`` a query."""
        self._visit(0, np.arange(len(self.queries)))
        row, place = np.nonzero(self.score > -np.inf)
        return row, self.found[row, place], self.score[row, place]

    def _reach(self, rows: np.ndarray) -> np.ndarray:
        """Distance within which a row may still be among the nearest of each query, over the factor."""
        worst = np.clip(self.score[rows, -1], -1, 1)
        return np.where(self.score[rows, -1] == -np.inf, np.inf, np.sqrt(2 - 2 * worst) / self.relaxed) + ROUNDING

    def _visit(self, node: int, rows: np.ndarray) -> None:
        tree, first = self.tree, int(self.tree.inner[node])
        if not len(rows):
            return
        if first < 0:
            self._compare(tree.order[tree.lo[node] : tree.hi[node]], rows)
            return
        apart = _apart(self.query_unit[rows], self.unit[tree.point[node]])
        near, far = tree.near[node], tree.far[node]
        # by the triangle inequality no row of a child is nearer to the query than this
        below = [np.maximum(low - apart, apart - high) for low, high in (near, far)]
        inside = apart <= (near[1] + far[0]) / 2
        for begin, mine in ((0, inside), (1, ~inside)):
            for child in (begin, 1 - begin):
                at = np.flatnonzero(mine)
                at = at[below[child][at] <= self._reach(rows[at])]
                self._visit(first + child, rows[at])

    def _compare(self, members: np.ndarray, rows: np.ndarray) -> None:
        self.tested += len(members) * len(rows)
        for a in range(0, len(rows), 2_000):
            mine = rows[a : a + 2_000]
            close = self.query_unit[mine] @ self.unit[members].T
            fits = close >= self.score[mine, -1][:, None] - ROUNDING
            fits &= self.query_ids[mine][:, None] != self.ids[members]
            if fits.sum(axis=1).max(initial=0) > self.nearest:
                # of many only those that reach the last wanted place, rounding aside
                kept = np.where(fits, close, -np.inf)
                worst = -np.partition(-kept, self.nearest - 1, axis=1)[:, self.nearest - 1]
                fits &= close >= worst[:, None] - ROUNDING
            q, m = np.nonzero(fits)
            if len(q):
                self._keep(mine[q], members[m])

    def _keep(self, rows: np.ndarray, members: np.ndarray) -> None:
        """Merges pairs (query row, member) into the nearest so far by exact score, then by smaller id."""
        exact = np.concatenate([cosines(self.queries[rows[a : a + 20_000]], self.vectors[members[a : a + 20_000]]) for a in range(0, len(rows), 20_000)])
        those = np.unique(rows)
        old_row = np.repeat(those, self.nearest)
        row = np.concatenate([old_row, rows])
        score = np.concatenate([self.score[those].ravel(), exact])
        ident = np.concatenate([self.found[those].ravel(), self.ids[members]])
        order = np.lexsort((ident, -score, row))
        row, score, ident = row[order], score[order], ident[order]
        # rows of one id with several vectors count once, by their best
        again = np.lexsort((np.arange(len(row)), ident, row))
        twin = np.zeros(len(row), dtype=bool)
        twin[again[1:]] = (row[again[1:]] == row[again[:-1]]) & (ident[again[1:]] == ident[again[:-1]]) & (score[again[1:]] > -np.inf)
        row, score, ident = row[~twin], score[~twin], ident[~twin]
        head = np.concatenate([[0], np.flatnonzero(row[1:] != row[:-1]) + 1])
        place = np.arange(len(row)) - np.repeat(head, np.diff(np.append(head, len(row))))
        best = place < self.nearest
        self.score[row[best], place[best]] = score[best]
        self.found[row[best], place[best]] = ident[best]


def build_index(rows: DataFrame, shard_rows: int = SHARD_ROWS, leaf_rows: int = LEAF_ROWS) -> DataFrame:
    """A tree for each shard of ``usable`` rows: ``(size, shard, shards, ids, vectors, order, nodes, edges)``, written to the shared folder.

    Vectors of one length are dealt to shards by their hash, so a shard has about ``shard_rows`` of them however many rows there are.
    """
    sizes = rows.groupBy("size").agg(F.count("*").alias("rows"))
    dealt = rows.join(sizes, "size").withColumn("shards", F.ceil(F.col("rows") / F.lit(shard_rows)).cast("long"))
    dealt = dealt.withColumn("shard", F.pmod(F.xxhash64("vec_id", "vector"), F.col("shards")))

    def plant(key, table: pd.DataFrame) -> pd.DataFrame:
        table = table.sort_values("vec_id", kind="stable")
        vectors = _matrix(table["vector"])
        tree = Tree.build(_unit(vectors), leaf_rows)
        blobs = {"ids": table["vec_id"].to_numpy("<i8").tobytes(), "vectors": vectors.astype("<f8").tobytes(), **tree.to_row()}
        return pd.DataFrame([{"size": key[0], "shard": key[1], "shards": table["shards"].iloc[0], **blobs}])

    schema = "size int, shard long, shards long, ids binary, vectors binary, order binary, nodes binary, edges binary"
    planted = dealt.select("size", "shard", "shards", "vec_id", "vector").groupBy("size", "shard").applyInPandas(plant, schema)
    return settled(planted, "trees")


def search(index: DataFrame, queries: DataFrame, nearest: int = NEAREST, relaxed: float = RELAXED, slab_rows: int = SLAB_ROWS) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: the ``nearest`` rows found in ``index`` for each of ``queries(vec_id, vector, size)``.

    Each query meets every shard of its vectors' length: a task has one tree and a slab of queries. In a tree a
    subtree is left out if the triangle inequality puts all of it farther away than the worst of the nearest found so far, with that distance
    divided by ``relaxed``: at 1 nothing is missed, above 1 more is left out. The shards' findings are then ranked per query.
    """
    if relaxed < 1 or nearest < 1:
        raise ValueError("relaxed must be 1 or more, nearest too")
    counted = queries.groupBy("size").agg(F.count("*").alias("asked"))
    trees = index.select("size", "shards").distinct()
    asked = queries.join(trees, "size").join(counted, "size")
    slabs = F.ceil(F.col("asked") / F.lit(slab_rows)).cast("long")
    asked = asked.withColumn("slab", F.pmod(F.xxhash64("vec_id"), slabs))
    asked = asked.withColumn("shard", F.explode(F.sequence(F.lit(0).cast("long"), F.col("shards") - 1)))
    sent = index.join(counted, "size").withColumn("slab", F.explode(F.sequence(F.lit(0).cast("long"), slabs - 1)))

    def nearest_of(key, left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if not len(left) or not len(right):
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": []})
        row = right.iloc[0]
        vectors = np.frombuffer(row["vectors"], dtype="<f8").reshape(-1, key[0])
        ids = np.frombuffer(row["ids"], dtype="<i8")
        query_ids = left["vec_id"].to_numpy()
        found = Search(Tree.from_row(row), ids, vectors, query_ids, _matrix(left["vector"]), nearest, relaxed)
        q, vec_id, score = found.run()
        return pd.DataFrame({"query_id": query_ids[q], "vec_id": vec_id, "score": score})

    keys = ["size", "shard", "slab"]
    mine = asked.select(*keys, "vec_id", "vector").groupBy(*keys)
    theirs = sent.select(*keys, "ids", "vectors", "order", "nodes", "edges").groupBy(*keys)
    found = mine.cogroup(theirs).applyInPandas(nearest_of, "query_id long, vec_id long, score double")
    # ids with several vectors may come from several shards
    found = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    place = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", place).where(F.col("rank") <= nearest).select("query_id", "rank", "vec_id", "score")


def nearest_vectors(
    vectors: DataFrame,
    every: int = 50,
    nearest: int = NEAREST,
    relaxed: float = RELAXED,
    shard_rows: int = SHARD_ROWS,
    leaf_rows: int = LEAF_ROWS,
    slab_rows: int = SLAB_ROWS,
) -> DataFrame:
    """``(query_id, rank, vec_id, score)`` for the rows of ``vectors(vec_id, embedding)`` whose vec_id is divisible by ``every``.

    ``score`` is the cosine of the original vectors in double precision; the nearest comes first, of equal scores the smaller
    vec_id. A query never finds its own vec_id; with fewer candidates all of them are listed. Rows without an id and
    vectors that are null, zero, empty or hold a null or non-finite component take no part; vectors of different lengths never meet. Repeated
    rows count once; of one vec_id with several vectors the smallest vector asks, and its best one is found. Other columns are
    not looked at, an empty table gives no rows.
    """
    rows = settled(usable(vectors), "vectors")
    index = build_index(rows, shard_rows, leaf_rows)
    asking = rows.where(F.col("vec_id") % every == 0).groupBy("vec_id").agg(F.min("vector").alias("vector"))
    return search(index, asking.withColumn("size", F.size("vector")), nearest, relaxed, slab_rows)
