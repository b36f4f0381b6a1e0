"""Periodic runs against a search of all periods and places."""

import hashlib
import random
import sys
import zlib
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))

from rareflow.llm import runs
from rareflow.llm.queries import queries


def plain_runs(words, min_exponent, min_words):
    """(start, length, period) of all runs, by looking along the text at every distance."""
    found = {}
    for q in range(1, len(words) // 2 + 1):
        s = 0
        while s < len(words) - q:
            if words[s] != words[s + q]:
                s += 1
                continue
            e = s
            while e < len(words) - q and words[e] == words[e + q]:
                e += 1
            if e - s + q >= max(min_words, min_exponent * q):
                found.setdefault((s, e - s + q), q)  # distances ascend, so the smallest period comes first
            s = e + 1
    return sorted((s, length, q) for (s, length), q in found.items())


@pytest.mark.parametrize("min_exponent, min_words", [(4, 6), (2, 2), (3, 7)])
def test_runs_of_random_texts(min_exponent, min_words):
    rng = random.Random(min_words)
    for _ in range(150):
        texts = []
        for _ in range(rng.randint(1, 6)):
            letters, n = rng.choice([1, 2, 3, 5, 50]), rng.choice([0, 1, 2, 5, 7, 13, 40, 130])
            text = [rng.randrange(letters) for _ in range(n)]
            if rng.random() < 0.5 and n:
                a = rng.randrange(n)
                p = rng.randint(1, max(1, (n - a) // 3))
                text = [text[i] if i < a else text[a + (i - a) % p] for i in range(n)]
            texts.append(text)
        words = np.array([w for t in texts for w in t], dtype=np.int64)
        found = runs.runs_of(words, np.array([len(t) for t in texts]), min_exponent, min_words)
        assert sorted(zip(*[x.tolist() for x in found])) == sorted((k, *r) for k, t in enumerate(texts) for r in plain_runs(t, min_exponent, min_words))


def test_neighbours_of_the_suffix_array():
    rng = random.Random(2)
    words = np.array([rng.randrange(3) for _ in range(300)])
    lengths = np.array([1, 120, 79, 100])
    text = np.repeat(np.arange(4), lengths)
    array = runs.SuffixArray(words, text, np.cumsum(lengths)[text])
    ends = np.cumsum(lengths)[text]
    suffixes = [(int(text[i]), *words[i : ends[i]].tolist()) for i in array.order.tolist()]
    assert suffixes == sorted(suffixes)
    for k in range(1, 300):
        a, b = suffixes[k - 1], suffixes[k]
        shared = next((m for m in range(min(len(a), len(b))) if a[m] != b[m]), min(len(a), len(b)))
        assert array.lcp[k] == max(0, shared - 1)


def test_long_and_many_texts(monkeypatch):
    assert [x.tolist() for x in runs.runs_of(np.zeros(100_000, dtype=np.int64), np.array([100_000]))] == [[0], [0], [100_000], [1]]
    monkeypatch.setattr(runs, "TESTED", 7)
    monkeypatch.setattr(runs, "BLOCK_WORDS", 20)
    texts = [["a"] * 8 + ["b"], [], ["a", "b"] * 30, ["c"]]
    found = list(runs._found([[w.encode() for w in t] for t in texts], 4, 6))
    assert [f["runs"] for f in found] == [[(0, 8, 1)], [], [(0, 60, 2)], []]
    assert [f["collapsed"] for f in found] == [b"a b", b"", b"a b", b"c"]


def test_rows_stay_as_they_are(spark):
    rows = [(1, "x " + "la la  la\nla la la la" + " y", "k"), (None, None, "k"), (3, "", None), (3, "", None), (4, " \t\x0b", "k"), (5, "a b " * 9, "k")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, runs string").repartition(3)
    found = {(r["doc_id"], r["runs"]): r["found"] for r in runs.with_runs(docs).collect()}
    assert found[(1, "k")]["strongest"] == (1, 7, 1) and found[(1, "k")]["collapsed"] == "x la y"
    assert found[(5, "k")]["runs"] == [(0, 9, 1)]
    for key in [(None, "k"), (3, None), (4, "k")]:
        assert found[key]["n_words"] == 0 and found[key]["runs"] == [] and found[key]["strongest"] is None and found[key]["collapsed"] == ""
    assert runs.with_runs(docs.limit(0)).count() == 0 and runs.with_runs(docs).count() == 6
    with pytest.raises(ValueError):
        runs.with_runs(docs, "runs")


def test_query_on_a_small_table(spark, tmp_path):
    rng = random.Random(5)
    texts = [" ".join(rng.choice("abcde") for _ in range(rng.choice([0, 1, 3, 30, 200]))) for _ in range(120)]
    rows = [(i * 7, t) for i, t in enumerate(texts)] + [(7, None), (14, texts[3]), (14, texts[3]), (None, "no id " * 9)]
    spark.createDataFrame(rows, "doc_id bigint, text string").write.parquet(f"{tmp_path}/documents.parquet")
    wanted, edited = [], 0
    for i, t in rows:
        words = (t or "").split()
        n, h = len(words), 1 if i is None else zlib.crc32(str(i).encode())
        g = h // 10
        if h % 10 == 0 and n:
            a, p = g % n, 1 + (n - g % n) // (3 + g % 8)
            words = [words[k] if k < a else words[a + (k - a) % p] for k in range(n)]
            edited += 1
        found = plain_runs(words, 4, 6)
        best = min(found, key=lambda r: (-r[1] / r[2], r[0], r[2])) if found else (None,) * 3
        gone = {k for s, length, q in found for k in range(s + q, s + length)}
        lines = "".join(f"{s},{length},{q}\n" for s, length, q in found)
        left = " ".join(w for k, w in enumerate(words) if k not in gone)
        milli = 1000 * best[1] // best[2] if found else None
        wanted.append((i, len(found), *best, milli, *(hashlib.sha256(x.encode()).hexdigest() for x in (lines, left))))
    found = [tuple(r) for r in queries()["op13_periodic_runs"](spark, str(tmp_path)).collect()]
    assert sorted(map(str, found)) == sorted(map(str, wanted)) and edited > 5
