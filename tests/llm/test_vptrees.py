"""Nearest vectors against all pairs."""

import random
import sys
from pathlib import Path

import numpy as np
import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))

from rareflow.llm import vptrees

SCHEMA = "vec_id bigint, embedding array<float>, label int, rank string"


def plain_search(rows, every, nearest):
    usable = {}
    for i, v in rows:
        if i is not None and v and None not in v and np.isfinite(v).all() and any(v):
            usable.setdefault(i, set()).add(tuple(np.float32(x).item() for x in v))
    out = []
    for i in usable:
        if i % every == 0:
            q = min(usable[i])
            scored = {}
            for j, vs in usable.items():
                for v in vs:
                    if j != i and len(v) == len(q):
                        dot, qq, vv = (sum((x * y for x, y in zip(a, b)), 0.0) for a, b in ((q, v), (q, q), (v, v)))
                        scored[j] = max(scored.get(j, -2), dot / np.sqrt(qq * vv))
            best = sorted((-s, j) for j, s in scored.items())[:nearest]
            out += [(i, k + 1, j, -s) for k, (s, j) in enumerate(best)]
    return sorted(out)


@pytest.mark.parametrize("shard_rows, leaf_rows, slab_rows", [(8_192, 256, 20_000), (40, 5, 7)])
def test_exact_at_factor_one(spark, shard_rows, leaf_rows, slab_rows):
    rng = random.Random(4)
    vector = lambda n: [rng.choice([-1.0, 0.5, 0.25, 2.0]) for _ in range(n)]
    rows = [(i, vector(4)) for i in range(300)] + [(i, vector(3)) for i in range(1_000, 1_004)]
    rows += [(2_000 + i, [1.0, 0.5, 0.25, 2.0]) for i in range(60)] + [(7, vector(4)), (50, vector(4)), rows[20], rows[20]]
    rows += [(3_000, None), (3_050, []), (3_100, [0.0] * 4), (3_150, [1.0, None, 1.0, 1.0]), (3_200, [1.0, float("nan"), 1.0, 1.0])]
    rows += [(3_250, [float("inf"), 1.0, 1.0, 1.0]), (None, vector(4)), (-50, [-0.0, 1.0, 0.0, 2.0]), (4_000, vector(7)), (4_050, [1e30] * 4), (4_051, [1e-30, 0.0, 1e-30, 0.0])]
    vectors = spark.createDataFrame([(i, v, 1, "x") for i, v in rows], SCHEMA).repartition(4)
    found = vptrees.nearest_vectors(vectors, 50, 5, 1.0, shard_rows, leaf_rows, slab_rows).collect()
    found = sorted(tuple(r) for r in found)
    assert [r[:3] for r in found] == [r[:3] for r in plain_search(rows, 50, 5)]
    assert [r[3] for r in found] == [r[3] for r in plain_search(rows, 50, 5)]
    assert len([r for r in found if r[0] == 1_000]) == 3 and not [r for r in found if r[0] == 4_000]


def test_empty_tables(spark):
    nothing = spark.createDataFrame([], SCHEMA)
    assert vptrees.nearest_vectors(nothing).count() == 0
    one = spark.createDataFrame([(50, [1.0, 2.0], 1, "x")], SCHEMA)
    assert vptrees.nearest_vectors(one).count() == 0
    with pytest.raises(ValueError):
        vptrees.nearest_vectors(one, relaxed=0.5).count()


def test_pruning_and_recall():
    """Clustered vectors: the exact search skips most of them, a greater factor more, at a recall that is still high."""
    rng = np.random.default_rng(6)
    centres = rng.normal(size=(40, 64))
    vectors = centres[rng.integers(0, 40, 8_000)] + 0.1 * rng.normal(size=(8_000, 64))
    ids, asked = np.arange(8_000), np.arange(0, 8_000, 50)
    tree = vptrees.Tree.build(vptrees._unit(vectors), 64)
    assert sorted(tree.order.tolist()) == ids.tolist()
    unit = vptrees._unit(vectors)
    near = unit[asked] @ unit.T
    near[np.arange(len(asked)), asked] = -2
    true = np.argsort(-near, axis=1)[:, :5]
    tested, recalls = [], []
    for factor in (1.0, 1.5, 2.5):
        search = vptrees.Search(vptrees.Tree.from_row(tree.to_row()), ids, vectors, asked, vectors[asked], 5, factor)
        row, vec_id, _ = search.run()
        hits = sum(len(set(vec_id[row == k].tolist()) & set(true[k].tolist())) for k in range(len(asked)))
        tested.append(search.tested / (len(asked) * len(ids)))
        recalls.append(hits / (5 * len(asked)))
    assert recalls[0] == 1.0 and tested[0] < 0.35
    assert tested[0] >= tested[1] >= tested[2] and min(recalls) >= 0.9
