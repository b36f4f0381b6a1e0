"""The whole pipeline against plain Python that makes each stage's decisions over again, and FTRL-proximal against a plain loop."""

import hashlib
import logging
import math
import random
import re
import sys
import zlib
from collections import defaultdict
from pathlib import Path

import numpy as np
import pytest
import xxhash

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))

import corpus_pipeline
from rareflow.llm import mixing, packing, queries, tokens, toxicity

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, extra string"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def lowered(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text)


def code_of(text):
    words = WORD.findall(lowered(text))
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << bit for bit in range(64) if 2 * sum(h >> bit & 1 for h in hashes) > len(hashes))


def one_of_each(rows):
    """One row of each component of codes that are at most three bits apart: the smallest doc_id, one without comes last."""
    codes = [code_of(r["text"] or "") for r in rows]
    group = list(range(len(rows)))

    def top(x):
        while group[x] != x:
            x = group[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            if (codes[a] ^ codes[b]).bit_count() <= 3:
                group[max(top(a), top(b))] = min(top(a), top(b))
    members = defaultdict(list)
    for i, r in enumerate(rows):
        members[top(i)].append(r)
    return [min(m, key=lambda r: (r["doc_id"] is None, r["doc_id"] or 0)) for m in members.values()]


def without_repeats(rows):
    first = {}
    for r in sorted((r for r in rows if r["doc_id"] is not None), key=lambda r: r["doc_id"]):
        raw = (r["text"] or "").encode()
        for p in range(len(raw) - 49):
            first.setdefault(raw[p : p + 50], r["doc_id"])
    out = []
    for r in rows:
        raw = (r["text"] or "").encode()
        gone = bytearray(len(raw))
        for p in range(len(raw) - 49 if r["doc_id"] is not None else 0):
            if first[raw[p : p + 50]] < r["doc_id"]:
                gone[p : p + 50] = b"\1" * 50
        out.append({**r, "text": bytes(b for b, g in zip(raw, gone) if not g).decode("utf-8", "ignore")})
    return out


def cell_of(row):
    text = row["text"].lower()
    topic = next((name for name, marks in mixing.TOPICS if any(m in text for m in marks)), mixing.OTHER_TOPIC)
    return (row["source"] or mixing.NONE, row["lang"] or mixing.NONE, topic)


def resampled(rows):
    """Raking within the tokens that there are, cell by cell, and a hash of the doc_id against the cell's probability."""
    count = {id(r): len(WORD.findall(r["text"])) for r in rows}
    held = defaultdict(int)
    for r in rows:
        held[cell_of(r)] += count[id(r)]
    held = {c: n for c, n in held.items() if n}
    whole = sum(held.values())
    weight = {c: n / whole for c, n in held.items()}
    most = {c: n / whole / mixing.KEEP for c, n in held.items()}
    target = []
    for d in range(3):
        share = defaultdict(float)
        for c, n in held.items():
            share[c[d]] += n
        share = {v: n**mixing.TEMPERATURE for v, n in share.items()}
        target.append({v: s / sum(share.values()) for v, s in share.items()})
    for _ in range(mixing.ROUNDS):
        for d in range(3):
            for value, goal in target[d].items():
                mine = [c for c in held if c[d] == value]
                now = sum(weight[c] for c in mine)
                full = {c for c in mine if weight[c] >= most[c]}
                stuck = sum(weight[c] for c in full)
                for c in mine:
                    if goal > now:
                        if c not in full:
                            weight[c] = min(weight[c] * ((goal - stuck) / (now - stuck) if now > stuck else 1), most[c])
                    else:
                        weight[c] = min(weight[c] * (goal / now if now else 0), most[c])
    kept = []
    for r in rows:
        chance = round(min(weight[cell_of(r)] / most[cell_of(r)], 1.0), 9) if count[id(r)] else 1.0
        key = r["text"] if r["doc_id"] is None else str(r["doc_id"])
        if int(hashlib.md5(f"{key}:42".encode()).hexdigest()[:8], 16) / 2**32 < chance:
            kept.append(r)
    return kept


@pytest.fixture(scope="module")
def planted(spark, tmp_path_factory):
    """200 documents of the test tables, with copies, near copies, repeated rows, shared passages, missing texts and ids, and toxic texts."""
    source = Path("/root/testdata/sf0.001")
    if not source.exists():
        pytest.skip("no test data")
    rng = random.Random(5)
    given = [r.asDict() for r in spark.read.parquet(f"{source}/documents.parquet").collect()]
    rows = [{**r, "extra": "x"} for r in given]
    passage = " ".join("".join(rng.choice("abcdefgh") for _ in range(6)) for _ in range(60))
    add = lambda i, text, lang="en": rows.append({"doc_id": i, "text": text, "lang": lang, "source": "s0", "n_chars": len(text or ""), "extra": None})
    for k in range(6):
        add(100_000 + k, rows[k]["text"])  # exact copies
        add(100_100 + k, rows[20 + k]["text"] + " and so on")  # near copies
        add(100_200 + k, f"Number {k} begins on its own, {rng.random()}. {passage} It ends so: {rng.random()}.")
    rows += [dict(rows[3]), dict(rows[3])]
    for i, text in ((100_300, None), (100_301, ""), (None, "without a number " * 20), (None, rows[7]["text"]), (100_302, "é" * 90)):
        add(i, text, None)
    labels = [(r["doc_id"], 0) for r in given]
    for k in range(60):
        words = " ".join("".join(rng.choice("ijklmn") for _ in range(5)) for _ in range(30))
        add(200_000 + k, f"{words} vileword {words} nastyword", "de")
        labels.append((200_000 + k, 1))
    folder = str(tmp_path_factory.mktemp("planted"))
    names = [c.split()[0] for c in SCHEMA.split(", ")]
    spark.createDataFrame([tuple(r[c] for c in names) for r in rows], SCHEMA).repartition(5).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(labels, "doc_id bigint, toxic int").write.parquet(f"{folder}/labels.parquet")
    return folder, rows


def test_run_against_plain_python(spark, planted):
    folder, rows = planted
    docs, labels = (spark.read.parquet(f"{folder}/{n}.parquet") for n in ("documents", "labels"))
    model = toxicity.learn(docs, toxicity.not_held_out(labels))
    mild = [r for r, s in zip(rows, model.scores([r["text"] or "" for r in rows])) if s < toxicity.THRESHOLD]
    assert sum((r["doc_id"] or 0) >= 200_000 for r in mild) <= 3 and len(mild) >= len(rows) - 62
    single = one_of_each(mild)
    assert len(single) <= len(mild) - 9
    cut = without_repeats(single)
    assert sum(len(r["text"] or "") for r in cut) < sum(len(r["text"] or "") for r in single)
    kept = resampled(cut)
    assert 0.3 * len(cut) < len(kept) < len(cut)

    tokenizer = tokens.Encoder(tokens.vocabulary(packing.TOKENIZER)).tokenizer
    ids = {r["doc_id"]: np.array([*tokenizer.encode(r["text"], add_special_tokens=False).ids, 1], dtype="<u4") for r in kept}
    found, windows = defaultdict(list), defaultdict(list)
    for p in corpus_pipeline.run(spark, folder).collect():
        found[p["doc_id"]].append(p)
        windows[p["sequence_id"]].append(p)
    assert set(found) == set(ids)
    for i, pieces in found.items():
        pieces.sort(key=lambda p: p["start"])
        assert [p["start"] for p in pieces] == np.cumsum([0, *(p["length"] for p in pieces[:-1])]).tolist()
        assert sum(p["length"] for p in pieces) == len(ids[i]) and {p["doc_tokens"] for p in pieces} == {len(ids[i])}
        assert b"".join(p["ids"] for p in pieces) == ids[i].tobytes() and all(len(p["ids"]) == 4 * p["length"] for p in pieces)
    for pieces in windows.values():
        pieces.sort(key=lambda p: p["offset"])
        assert [p["offset"] for p in pieces] == np.cumsum([0, *(p["length"] for p in pieces[:-1])]).tolist()
        assert sum(p["length"] for p in pieces) <= packing.WINDOW


def test_packing_query_against_plain_python(spark, planted):
    folder, rows = planted
    tokenizer = tokens.Encoder(tokens.vocabulary(packing.TOKENIZER)).tokenizer
    found = defaultdict(list)
    for p in queries.op3_packing(spark, folder).collect():
        found[p["doc_id"]].append(p)
    texts = defaultdict(list)
    for r in rows:
        texts[r["doc_id"]].append(r["text"] or "")
    assert set(found) == set(texts)
    for i in (k for k in texts if len(texts[k]) == 1):
        ids = np.array([*tokenizer.encode(texts[i][0], add_special_tokens=False).ids, 1], dtype="<u4")
        pieces = sorted(found[i], key=lambda p: p["start"])
        assert [p["start"] for p in pieces] == np.cumsum([0, *(p["length"] for p in pieces[:-1])]).tolist()
        assert sum(p["length"] for p in pieces) == len(ids) and {p["doc_tokens"] for p in pieces} == {len(ids)}
        assert all(p["ids_crc32"] == zlib.crc32(ids[p["start"] : p["start"] + p["length"]].tobytes()) for p in pieces)


def test_stages_hand_on_the_columns(spark, planted, caplog):
    docs = spark.read.parquet(f"{planted[0]}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, docs, planted[0])
        assert after.dtypes == docs.dtypes and 0 < after.count() <= docs.count()
    with caplog.at_level(logging.ERROR):
        for name, stage in corpus_pipeline.STAGES:
            assert stage(spark, docs.limit(0), planted[0]).count() == 0


def test_ftrl_like_a_plain_loop():
    rng = np.random.default_rng(6)
    rows = []
    for _ in range(300):
        buckets = np.unique(rng.integers(0, 60, rng.integers(0, 20)))
        rows.append((buckets, int(rng.random() < (0.8 if 7 in buckets else 0.1))))
    model = toxicity.fit_ftrl(rows, passes=4)
    z, n = defaultdict(float), defaultdict(float)

    def weight(key):
        l1 = 0.0 if key == "bias" else toxicity.L1
        if abs(z[key]) <= l1:
            return 0.0
        return -(z[key] - math.copysign(l1, z[key])) / ((toxicity.BETA + math.sqrt(n[key])) / toxicity.ALPHA + toxicity.L2)

    for _ in range(4):
        for buckets, label in rows:
            keys = [*buckets.tolist(), "bias"]
            w = {k: weight(k) for k in keys}
            g = 1 / (1 + math.exp(-sum(w.values()))) - label
            for k in keys:
                z[k] += g - (math.sqrt(n[k] + g * g) - math.sqrt(n[k])) / toxicity.ALPHA * w[k]
                n[k] += g * g
    wanted = {k: weight(k) for k in list(z) if k != "bias" and weight(k)}
    assert 7 in wanted and dict(zip(model.buckets.tolist(), model.weights)) == pytest.approx(wanted)
    assert model.intercept == pytest.approx(weight("bias")) and model.labels == 2


def test_features_are_words_stems_and_pairs():
    texts = ["Ab cd-AB, naïve cd ab ab", "", "...", "one"]
    wanted = []
    for t in texts:
        words = [w for w in re.findall(rb"[0-9a-z\x80-\xff]+", lowered(t).encode())]
        every = {("word", w) for w in words} | {("stem", k, w[:k]) for w in words for k in toxicity.STEMS}
        every |= {("pair", g, a, b) for g in toxicity.GAPS for a, b in zip(words, words[g:])}
        wanted.append(len(every))
    found = [set() for _ in texts]
    for number, bucket in toxicity.features(texts):
        for i, b in zip(number.tolist(), bucket.tolist()):
            found[i].add(b)
    assert [len(f) for f in found] == wanted
