"""Each operator against brute force on small documents: nulls, empty and long texts, ties, repeated rows, empty tables, odd columns."""

import hashlib
import random
import sys
import zlib
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pytest
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))

from rareflow.llm import forest, idfiles, mixing, packing, sharding, simhash, sketches, suffixes, tokens, toxicity, urls
from rareflow.llm.components import components
from rareflow.llm.queries import URL_RULES

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, mark int, place string"


def _texts():
    rng = random.Random(3)
    words = ["".join(rng.choice("abcdeé") for _ in range(rng.randint(1, 7))) for _ in range(300)]
    prose = lambda n: " ".join(rng.choice(words) for _ in range(n)) + "."
    shared = prose(40)
    texts = [prose(rng.randint(1, 120)) for _ in range(40)]
    texts += [texts[0], texts[0], texts[3] + " more", shared, prose(10) + shared + prose(5), "x" + shared, "", "  \n ", "a", "aa " * 400]
    texts += ["aa " * 300, prose(4000), "naïve “quotes” <|endoftext|> 東京 \x85 it's", None, texts[5][:49], texts[5][:50], texts[5][:51]]
    return texts


@pytest.fixture(scope="module")
def docs(spark, tmp_path_factory):
    rows = [(i * 3 - 7, t, ["en", "de", None][i % 3], f"s{i % 4}" if i % 2 else "s0", None, 1, "p") for i, t in enumerate(_texts())]
    rows += [(None, "no id " * 30, "en", "s0", 5, 2, None), rows[4], rows[4]]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


def _rows(df):
    return [(r["doc_id"], r["text"] or "") for r in df.select("doc_id", "text").collect()]


def test_sketches_of_very_unequal_texts(spark):
    """A short text inside a long one, before and after it in the order, is found whole; a stranger has nothing in common."""
    rng = random.Random(7)
    words = ["".join(rng.choice("abcdefghij") for _ in range(6)) for _ in range(4_000)]
    prose = lambda n: " ".join(rng.choice(words) for _ in range(n))
    rows, wanted = [], {}
    for k in range(40):
        long, short = prose(3_000), None
        cut = long.split()
        short = " ".join(cut[100 + k : 120 + k]) if k % 4 else prose(20)
        first, second = (short, long) if k % 2 else (long, short)
        rows += [(1_000 - 2 * k, first), (999 - 2 * k, second)]
        wanted[1_000 - 2 * k] = 1.0 if k % 4 else 0.0
    half = " ".join(cut[:10]) + " " + prose(30)
    rows += [(10, half), (9, cut and " ".join(cut)), (8, ""), (7, "")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4)
    found = {r["doc_id"]: r["near_next"] for r in sketches.edited_fingerprints(docs).collect()}
    assert {i: found[i] for i in wanted} == wanted
    assert found[10] == 6 / 36 and found[9] == 0.0 and found[8] == 1.0


def test_sketches_merge_and_keep_to_the_fraction(spark):
    rng = random.Random(2)
    texts = [" ".join(str(rng.randrange(10**6)) for _ in range(n)) for n in (5, 60, 400, 3_000, 6_000)]
    df = sketches.with_sketch(spark.createDataFrame([(t,) for t in texts], "text string"), "text", "s")
    bound = -(2**63) + 2**60 - 1
    hashed = sketches.shingle_hashes("h")
    every = {r["text"]: sorted(r["e"]) for r in df.select("text", sketches.word_hashes(F.col("text")).alias("h")).select("text", hashed.alias("e")).collect()}
    found = {r["text"]: r["s"] for r in df.collect()}
    for t in texts:
        below = [h for h in every[t] if h <= bound]
        assert list(found[t]["hashes"]) == (below if len(below) >= 64 else every[t][:64])
        assert found[t]["covered"] == (bound if len(below) >= 64 else 2**63 - 1 if len(every[t]) <= 64 else every[t][63])
    a, b = found[texts[3]], found[texts[4]]
    upto = min(a["covered"], b["covered"])
    assert sorted({h for s in (a, b) for h in s["hashes"] if h <= upto}) == sorted({h for t in texts[3:] for h in every[t] if h <= upto})


def test_components(spark):
    links = [(1, 2), (2, 3), (3, 4), (4, 5), (9, 8), (7, 7), (None, 3), (1, 2), *[(100, k) for k in range(101, 180)], *[(k, k + 1) for k in range(200, 240)]]
    found = {r["node"]: r["component"] for r in components(spark.createDataFrame(links, "a bigint, b bigint")).collect()}
    assert {found[k] for k in range(1, 6)} == {1} and found[9] == found[8] == 8 and 7 not in found
    assert {found[k] for k in range(100, 180)} == {100} and {found[k] for k in range(200, 241)} == {200}
    assert components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


@pytest.mark.parametrize("positions, hot_names", [(10**6, 1), (40, 10**6), (40, 0)])
def test_suffixes(docs, positions, hot_names):
    rows = _rows(docs)
    first = {}
    for i, t in sorted((x for x in rows if x[0] is not None)):
        raw = t.encode()
        for p in range(len(raw) - 49):
            first.setdefault(raw[p : p + 50], i)
    wanted = []
    for i, t in rows:
        raw, gone = t.encode(), bytearray(len(t.encode()))
        for p in range(len(raw) - 49 if i is not None else 0):
            if first[raw[p : p + 50]] < i:
                gone[p : p + 50] = b"\1" * 50
        kept = bytes(b for b, g in zip(raw, gone) if not g)
        spans = sum(g and not (k and gone[k - 1]) for k, g in enumerate(gone))
        wanted.append((str(i), len(raw), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    found = suffixes.remove_repeats(docs, group_positions=positions, hot_names=hot_names).collect()
    assert sorted((str(r["doc_id"]), *r[2:6]) for r in found) == sorted(wanted)
    assert sum(w[2] for w in wanted) > 0


def test_suffixes_of_a_repeated_row_in_one_batch(spark):
    text = "".join(random.Random(8).choice("abcdefgh ") for _ in range(120))
    rows = spark.createDataFrame([(1, text), (1, text), (2, text), (3, "other " * 20)], "doc_id bigint, text string").coalesce(1)
    found = sorted((r["doc_id"], r["n_removed"]) for r in suffixes.remove_repeats(rows).collect())
    assert found == [(1, 0), (1, 0), (2, 120), (3, 0)]


def test_suffixes_in_batches_of_any_size(spark):
    rng = random.Random(3)
    text = ["".join(rng.choice("abcdefgh ") for _ in range(70)) for _ in range(2)]
    rows = spark.range(70_000, numPartitions=1).selectExpr("id as doc_id", "repeat('x', 3) as text")
    for i, t in ((10, text[0]), (69_990, text[0]), (20, text[1]), (65_556, text[1])):
        rows = rows.withColumn("text", F.when(F.col("doc_id") == i, t).otherwise(F.col("text")))
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    try:
        for size in ("0", "7000"):
            spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", size)
            found = suffixes.remove_repeats(rows).where("n_removed > 0").collect()
            assert sorted((r["doc_id"], r["n_removed"]) for r in found) == [(65_556, 70), (69_990, 70)]
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)


def test_suffixes_deal_out_hot_ranks():
    rng = random.Random(4)
    prose = lambda n: "".join(rng.choice("abcdefghijklmnop") for _ in range(n))
    texts = [prose(40) + "  0123456789  0123456789  0123456789  " + prose(40) for _ in range(600)] + ["-" * 5000] * 2
    ids = np.arange(len(texts))
    batch = pa.RecordBatch.from_pydict({"id": ids, "mark": ids, "text": [t.encode() for t in texts]})
    sent = pa.concat_tables(pa.Table.from_batches([b]) for b in suffixes._first_ranks(50, 16, 64)(iter([batch])))
    alive = pa.concat_tables(suffixes._shared_ranks(100)(sent.filter(pc.equal(sent["bucket"], b))) for b in range(64)).to_pylist()
    hot = np.sort(suffixes._from_six(b"".join(r["hot"] for r in alive if r["hot"])))
    names = [[r["names"] for r in alive if r["id"] == i] or [b""] for i in ids.tolist()]
    batch = pa.RecordBatch.from_pydict({**{c: batch.column(c) for c in ("id", "mark", "text")}, "names": names})
    sizes, runs = {}, 0
    for b in suffixes._second_ranks(50, 16, 64, hot)(iter([batch])):
        for r in b.to_pylist():
            if not r["known"]:
                sizes[r["bucket"]] = sizes.get(r["bucket"], 0) + len(r["places"]) // 4
                runs += int((suffixes._unpacked(r)[0] >= 600).sum())
    assert len(hot) >= 2 and 0 < runs <= 4
    assert max(sizes.values()) < 0.1 * sum(sizes.values()) and len(sizes) == 64
    codes, offsets = suffixes._buffer(batch.column("text"))
    place, number, name, lo, hi = suffixes._samples(codes, offsets, 50, 16)
    one = np.flatnonzero(np.isin(name, hot))
    context = suffixes._contexts(codes, place[one], lo[one], hi[one], 50, 16)
    rest = ((lo - place + 34)[one], (hi - place + 34)[one], number[one], 50, 35)
    wanted = suffixes._repeated_windows(context, *rest)
    assert wanted.any() and (suffixes._repeated_by_column(context, *rest) == wanted).all()


def test_suffixes_of_runs(spark):
    rows = [(5, "x" + "-" * 3000 + "y"), (5, "-" * 70), (6, "-" * 60 + "z" * 60 + "-" * 2000), (7, "z" * 55 + "-" * 50), (8, "z" * 59)]
    rows = spark.createDataFrame(rows, "doc_id bigint, text string").coalesce(1)
    for split, hot_names in ((rows, 10**6), (rows.repartition(5), 10**6), (rows, 0), (rows.repartition(5), 0)):
        found = suffixes.remove_repeats(split, group_positions=40, hot_names=hot_names).collect()
        assert sorted((r["doc_id"], r["n_bytes"], r["n_removed"]) for r in found) == [(5, 70, 0), (5, 3002, 0), (6, 2120, 2060), (7, 105, 105), (8, 59, 59)]


def test_suffixes_keep_columns(docs, nothing):
    out = suffixes.without_repeats(docs)
    assert out.columns == docs.columns and out.count() == docs.count()
    assert out.where("n_chars <> length(text)").count() == 0
    assert suffixes.without_repeats(nothing).count() == 0


@pytest.mark.parametrize("group_rows", [2_000, 3])
def test_simhash(docs, group_rows):
    rows = _rows(docs)
    found = simhash.simhash_components(docs, group_rows=group_rows).collect()
    codes = {t: simhash.simhash(t) for _, t in rows}
    names = {i for i, _ in rows if i is not None}
    parent = {i: i for i in names}

    def top(x):
        while parent[x] != x:
            x = parent[x]
        return x

    listed = [(i, codes[t]) for i, t in rows if i is not None]
    for a, x in listed:
        for b, y in listed:
            if (x ^ y).bit_count() <= 3 and top(a) != top(b):
                parent[max(top(a), top(b))] = min(top(a), top(b))
    assert len(found) == len(rows)
    for r in found:
        if r["doc_id"] is not None:
            assert r["component_id"] == top(r["doc_id"])
    assert simhash.simhash("") == simhash.simhash(" \n") == 0


def test_simhash_bits():
    import xxhash

    text = "The quick BROWN fox\tjumps over\x0bit"
    words = text.lower().split()
    hashes = [xxhash.xxh64_intdigest(" ".join(words[k : k + 3]), 42) for k in range(len(words) - 2)]
    wanted = sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes))
    assert simhash.simhash(text) == wanted


def test_gray_index_finds_all_pairs():
    rng = np.random.default_rng(1)
    base = rng.integers(0, 2**64, 6, dtype=np.uint64)
    codes = np.unique(np.concatenate([base, *[base ^ (np.uint64(1) << rng.integers(0, 64, 6).astype(np.uint64)) for _ in range(100)]]))
    codes = codes[np.argsort(simhash.gray_rank(codes))]
    left, right = simhash.near_pairs(codes, np.zeros(len(codes), dtype=int))
    wanted = {(i, j) for i in range(len(codes)) for j in range(i + 1, len(codes)) if int(codes[i] ^ codes[j]).bit_count() <= 3}
    assert set(zip(left.tolist(), right.tolist())) == wanted


def test_one_of_each(docs, nothing):
    kept = simhash.one_of_each(docs)
    assert kept.columns == docs.columns and 0 < kept.count() < docs.count()
    assert simhash.one_of_each(nothing).count() == 0


def test_one_of_each_of_repeated_rows_and_missing_ids(spark):
    text = "one two three four five six seven"
    rows = [(None, text, 1), (9, text, 2), (3, text, 3), (3, text, 3), (3, text, 4), (None, text, 1), (12, text, 5)]
    rows += [(None, "quite other words stand here and now", 1)] * 3 + [(5, "", 1), (4, None, 1), (6, " ", 1)]
    kept = simhash.one_of_each(spark.createDataFrame(rows, "doc_id bigint, text string, one_id int").repartition(4))
    found = sorted(tuple(str(x) for x in r) for r in kept.collect())
    assert kept.columns == ["doc_id", "text", "one_id"] and len(found) == 3
    assert [f[:2] for f in found] == [("3", text), ("4", "None"), ("None", "quite other words stand here and now")]


def test_one_of_each_against_all_pairs(docs):
    codes = [(r["doc_id"], simhash.simhash(r["text"] or ""), tuple(r)) for r in docs.collect()]
    group = list(range(len(codes)))
    for _ in codes:
        for i, a in enumerate(codes):
            for j, b in enumerate(codes):
                if (a[1] ^ b[1]).bit_count() <= 3:
                    group[i] = group[j] = min(group[i], group[j])
    best = {}
    for g, (i, _, row) in zip(group, codes):
        key = (i is None, i or 0)
        if g not in best or key < best[g][0]:
            best[g] = (key, row)
    assert sorted(str(tuple(r)[:2]) for r in simhash.one_of_each(docs).collect()) == sorted(str(row[:2]) for _, row in best.values())


@pytest.mark.parametrize("name", [packing.TOKENIZER, idfiles.TOKENIZER])
def test_encoder(name):
    path = tokens.vocabulary(name)
    rng = random.Random(5)
    marks = [*"ab  \n\t.,'sé%<|>1²ćİßΣς中\x85\xa0-—", "<|endoftext|>", "'s", "n't", "ABC"]
    texts = ["".join(rng.choice(marks) for _ in range(rng.randrange(40))) for _ in range(1500)] + [t or "" for t in _texts()]
    small = tokens.Encoder(path, cached=50)
    ids, counts = small.encode(texts)
    wanted = [e.ids for e in small.tokenizer.encode_batch(texts, add_special_tokens=False)]
    assert ids.tolist() == [i for x in wanted for i in x] and counts.tolist() == [len(x) for x in wanted]


def test_packing(docs, nothing):
    tokenizer = tokens.Encoder(tokens.vocabulary(packing.TOKENIZER)).tokenizer
    found = [r.asDict() for r in packing.pack(docs, partitions=3).collect()]
    held, windows = {}, {}
    for r in found:
        held.setdefault(r["doc_id"], []).append(r)
        windows.setdefault(r["sequence_id"], []).append(r)
    texts = {}
    for i, t in _rows(docs):
        texts.setdefault(i, []).append(t)
    for i, pieces in held.items():
        ids = np.array(tokenizer.encode(texts[i][0], add_special_tokens=False).ids + [1], dtype="<u4")
        assert sum(p["length"] for p in pieces) == len(ids) * len(texts[i])
        for p in pieces:
            assert p["ids"] == ids[p["start"] : p["start"] + p["length"]].tobytes() and p["doc_tokens"] == len(ids)
    for pieces in windows.values():
        at = 0
        for p in sorted(pieces, key=lambda p: p["offset"]):
            assert p["offset"] == at
            at += p["length"]
        assert at <= 2048
    assert set(held) == set(texts) and packing.pack(nothing).count() == 0


def test_cut_windows_is_best():
    rng = np.random.default_rng(4)
    for _ in range(80):
        window, n = int(rng.choice([4, 8, 16])), int(rng.integers(1, 70))
        price = rng.integers(0, 6, n)
        half, best = window // 2, [0] + [10**9] * n
        for j in range(1, n + 1):
            options = [best[j - k] + window - k for k in range(half + 1, window + 1) if k <= j] + ([best[j - half]] if j >= half else [])
            best[j] = min([10**9, *[o + int(price[j - 1]) for o in options]])
        cuts = packing.cut_windows(price, window)
        sizes = np.diff(np.concatenate([[0], cuts]))
        assert cuts[-1] == n and sizes.max() <= window and sizes.min() > 0
        reached = [0, *cuts.tolist()]
        total = min(best[i] + 8 * bin(n - i).count("1") for i in range(max(0, n - window + 1), n + 1) if best[i] < 10**9)
        assert total in [best[i] + 8 * bin(n - i).count("1") for i in reached if n - i < window]


def test_id_files(spark, docs, nothing, tmp_path):
    tokenizer = tokens.Encoder(tokens.vocabulary(idfiles.TOKENIZER)).tokenizer
    idfiles.write_ids(docs, str(tmp_path / "ids"), partitions=3, block=500)
    found = idfiles.read_ids(spark, str(tmp_path / "ids")).orderBy("start").collect()
    rows = sorted(_rows(docs), key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    at = 0
    for r, (i, t) in zip(found, rows, strict=True):
        assert (r["doc_id"], r["start"], r["n_tokens"]) == (i, at, len(r["ids"]))
        assert r["ids"] == tokenizer.encode(t, add_special_tokens=False).ids + [1]
        at += r["n_tokens"]
    for r in idfiles.read_digests(spark, str(tmp_path / "ids")).collect():
        assert r["ids_crc32"] in {zlib.crc32(np.array(x["ids"], dtype="<u4").tobytes()) for x in found if x["start"] == r["start"]}
    idfiles.write_ids(nothing, str(tmp_path / "none"))
    assert idfiles.read_ids(spark, str(tmp_path / "none")).count() == 0


def test_simple8b():
    rng = np.random.default_rng(2)
    for k in range(200):
        values = rng.integers(0, 2 ** int(rng.integers(1, 64)), int(rng.integers(0, 300)), dtype=np.uint64)
        if k % 5 == 0 and len(values):
            values[0] = 2**64 - 1
        words, escapes = idfiles.pack_words(values)
        assert (idfiles.unpack_words(words, escapes) == values).all()


def test_urls(spark):
    given = ["http://a.example.com/en/1", "https://WWW.Example.com/en/x?q#y", "http://b.net/es/", "http://b.net/es", "x://net/fr/é", "http://com", "nothing", None, "", "http://q.org/?a=http://x.net/es/", "a://b.com#c/d", "http://example.com:80/en/"]
    pages = spark.createDataFrame([(i, u, "h") for i, u in enumerate(given)] + [(None, given[0], "h")], "page_id bigint, url string, host string")
    rows = urls.judge(pages, URL_RULES).collect()
    assert len(rows) == len(given) + 1
    for r in rows:
        fits = [(len(h + p), h + p, v) for v, h, p in URL_RULES if (r["host"] == h or r["host"].endswith("." + h)) and r["path"].startswith(p)]
        assert (r["rule"], r["verdict"]) == (max(fits)[1:] if fits else (None, "allow"))
    assert urls.judge(pages.limit(0), URL_RULES).count() == 0
    trie = urls.Trie([("allow", "", ""), ("block", "a.b", "/x"), ("allow", "a.b", "/x"), ("block", "b", "/xy/z")])
    assert trie.find("c.a.b", "/xyz") == ("block", "a.b/x") and trie.find("q", "") == ("allow", "") and trie.find("b", "/xy/zz") == ("block", "b/xy/z")


def test_sketches(docs, nothing):
    rows = {r["doc_id"]: r for r in sketches.edited_fingerprints(docs).collect()}
    texts = dict(_rows(docs))
    order = sorted((i for i in texts if i is not None), reverse=True)
    by_text = {}
    for k, i in enumerate(order):
        own, follow, r = texts[i], texts[order[(k + 1) % len(order)]], rows[i]
        cut = len(own) // 3
        edited = own[: len(own) - cut] + follow[:cut]
        assert r["n_chars"] == len(own) and r["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        assert by_text.setdefault(own, r["fingerprint"]) == r["fingerprint"]

        def shingles(t):
            words = t.split()
            return {tuple(words[a : a + 5]) for a in range(max(len(words) - 4, 1 if words else 0))}

        a, b = shingles(own), shingles(edited)
        if "\x85" not in own + edited:
            true = 1.0 if a == b else len(a & b) / min(len(a), len(b)) if a and b else 0.0
            assert abs(r["near_edited"] - true) < 0.2
    assert len(sketches.edited_fingerprints(docs).collect()) == docs.count()
    assert sketches.edited_fingerprints(nothing).count() == 0


@pytest.mark.parametrize("limit", [300, 4000, 10**9])
def test_shards(docs, nothing, limit):
    rows = sharding.shards(docs, limit).collect()
    assert len(rows) == docs.count()
    held = {}
    for r in rows:
        held.setdefault((r["shard"], r["page"]), []).append(r["bytes"])
    assert all(sum(b) <= limit or len(b) == 1 for b in held.values())
    names = sorted({s for s, _ in held})
    assert not [1 for a, b in zip(names, names[1:]) if b.startswith(a) and a != b]
    for name in names:  # its sibling and it together are too large for their parent
        if name:
            assert sum(r["bytes"] for r in rows if r["shard"].startswith(name[:-1])) > limit
    assert sharding.shards(nothing).count() == 0


def test_write_shards(spark, docs, tmp_path):
    sharding.write_shards(docs, str(tmp_path / "shards"), 4000)
    back = spark.read.parquet(str(tmp_path / "shards")).drop("shard")
    assert back.columns == docs.columns and back.count() == docs.count()


def test_mixing(spark, docs, nothing):
    cells = [("a", "x", "p", 800), ("a", "y", "p", 100), ("b", "x", "q", 60), ("b", "y", "p", 40), ("b", "x", "p", 10), ("c", "y", "q", 0)]
    cells = spark.createDataFrame(cells, "source string, lang string, topic string, tokens bigint")
    targets = {"source": {"a": 0.5, "b": 0.5}, "lang": {"x": 0.7, "y": 0.3}}
    raked = mixing.rake(cells, ["source", "lang", "topic"], targets, rounds=5).collect()
    for dim, wanted in targets.items():
        for value, share in wanted.items():
            assert abs(sum(r["weight"] for r in raked if r[dim] == value) - share) < 0.02
    rows = mixing.mixed(docs)
    found = rows.collect()
    assert len(found) == docs.count() and all(0 <= r["mix_probability"] <= 1 for r in found)
    assert all(r["mix_kept"] for r in found if r["mix_tokens"] == 0)
    assert mixing.resampled(docs).columns == docs.columns
    assert mixing.resampled(nothing).count() == 0


def test_a_rare_cell_does_not_thin_the_others(spark):
    rows = [(i, "word " * 100, ["en", "de"][i % 2], ["s0", "s1", "s2"][i % 3], None, 1, "p") for i in range(2000)]
    rows.append((5000, "word " * 100, "xx", "s9", None, 1, "p"))
    kept = mixing.resampled(spark.createDataFrame(rows, SCHEMA).coalesce(1)).count() / len(rows)
    assert abs(kept - mixing.KEEP) < 0.05


def test_mixing_within_the_tokens(spark):
    cells = [("a", "x", 900), ("a", "y", 300), ("b", "x", 150), ("b", "y", 100), ("c", "y", 2)]
    cells = spark.createDataFrame(cells, "source string, lang string, tokens bigint")
    targets = {"source": {"a": 0.7, "b": 0.2, "c": 0.1}, "lang": {"x": 0.6, "y": 0.4}}
    rows, reached = mixing.rake_within(cells, ["source", "lang"], 0.5, targets, rounds=8)
    kept = {(r["source"], r["lang"]): r["weight"] / r["most"] for r in rows.collect()}
    assert kept["c", "y"] == 1 and all(0 < k <= 1 for k in kept.values())
    found = {(r["dimension"], r["value"]): (r["target"], r["reached"]) for r in reached.collect()}
    assert all(abs(found["lang", k][1] - share) < 0.01 for k, share in targets["lang"].items())
    assert found["source", "c"][0] == pytest.approx(0.1) and found["source", "c"][1] == pytest.approx(2 / 726)


def test_toxicity(spark, nothing):
    rng = random.Random(9)
    words = ["".join(rng.choice("abcdefgh") for _ in range(4)) for _ in range(200)]
    rows = []
    for i in range(1500):
        bad = i % 4 == 0
        text = " ".join(rng.choice(words) for _ in range(rng.randint(20, 60)))
        rows.append((i, text + (" Vile, " if bad else " fine ") + rng.choice(words), int(bad)))
    rows.append((2000, None, 0))
    df = spark.createDataFrame(rows, "doc_id bigint, text string, label int")
    docs, labels = df.select("doc_id", "text", F.lit(1).alias("score")), df.select("doc_id", F.col("label").alias("toxic"))
    model = toxicity.learn(docs, toxicity.not_held_out(labels))
    held = toxicity.with_scores(docs, model, "p").join(df.select("doc_id", "label"), "doc_id").where(toxicity.held_out(F.col("doc_id")))
    wrong = held.where("(p >= 0.3) <> (label = 1)").count()
    assert held.count() > 300 and wrong <= 0.02 * held.count() and len(model.buckets) < 200
    kept = toxicity.without_toxic(docs, labels)
    assert kept.columns == docs.columns and 1000 < kept.count() < 1250
    for few in (labels.limit(0), labels.where("toxic = 1"), labels.withColumn("doc_id", F.col("doc_id") + 10_000)):
        assert toxicity.without_toxic(docs, few).count() == docs.count()
    blank = toxicity.learn(docs, labels.limit(0))
    assert blank.scores(["x", ""]).tolist() == [0.5, 0.5]
    assert toxicity.without_toxic(nothing, labels.limit(0)).count() == 0
    with pytest.raises(ValueError, match="already"):
        toxicity.with_scores(docs, blank, "score")


@pytest.mark.parametrize("leaf_rows", [2_000, 40])
def test_forest(spark, leaf_rows):
    rng = np.random.default_rng(6)
    base = rng.normal(size=(150, 16))
    near = base[:60] + rng.normal(size=(60, 16)) * 0.06
    dense = base[0] + rng.normal(size=(150, 16)) * 0.02
    every = [*base, *near, *dense, *base[:20], base[5] * 3]
    rows = [(i, [float(x) for x in v], i % 2) for i, v in enumerate(every)]
    rows += [(900, None, 1), (901, [0.0] * 16, 1), (902, [float("nan")] * 16, 1), (903, rows[0][1], None), (904, [1.0], 0), (905, [None] * 16, 0)]
    vectors = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>, label int")
    found = {r["vec_id"]: r for r in forest.near_vectors(vectors, leaf_rows=leaf_rows).collect()}
    unit = np.stack(every) / np.linalg.norm(np.stack(every), axis=1)[:, None]
    label = np.arange(len(every)) % 2
    linked = (unit @ unit.T >= 0.98) & (label[:, None] == label) & ~np.eye(len(every), dtype=bool)
    wanted, got = linked.sum(axis=1), np.array([found[i]["n_links"] for i in range(len(every))])
    assert (got <= wanted).all() and got.sum() >= 0.9 * wanted.sum()
    if leaf_rows == 2_000:
        assert (got == wanted).all()
    for i in range(900, 906):
        assert found[i]["n_links"] == 0 and found[i]["component_id"] == i and found[i]["kept"]
    assert forest.near_vectors(vectors.limit(0)).count() == 0


def _brute_links(rows):
    """(links, smallest reachable) by id, over all pairs of one label and length."""
    near = {i: [] for i, _, _ in rows}
    by_kind = {}
    for i, v, label in rows:
        by_kind.setdefault((label, len(v)), []).append((i, v))
    for mine in by_kind.values():
        ids, unit = [i for i, _ in mine], np.array([v for _, v in mine])
        unit = unit / np.linalg.norm(unit, axis=1)[:, None]
        for a, b in zip(*np.nonzero(unit @ unit.T >= 0.98)):
            if a != b:
                near[ids[a]].append(ids[b])
    root = {i: i for i in near}
    changed = True
    while changed:
        changed = False
        for i, others in near.items():
            low = min([root[i], *[root[j] for j in others]])
            changed |= low < root[i]
            root[i] = low
    return {i: (len(others), root[i]) for i, others in near.items()}


@pytest.mark.parametrize("kind, leaf_rows", [("string", 2_000), ("string", 15), ("bigint", 15), ("double", 15)])
def test_forest_of_any_label_and_length(spark, kind, leaf_rows):
    rng = np.random.default_rng(2)
    names = {"string": ["a", "b:4", ""], "bigint": [2**40, -1, 7], "double": [0.5, -2.0, 1e300]}[kind]
    rows = []
    for size in (4, 6):
        base = rng.normal(size=(60, size))
        for v in [*base, *(base[:30] + 0.05 * rng.normal(size=(30, size))), *(base[0] + 0.03 * rng.normal(size=(40, size)))]:
            rows.append((len(rows), [float(x) for x in v], names[int(rng.integers(0, 3))]))
    rows += [(1_000, [1.0, 2.0], names[0]), (1_001, [1.0, 2.01], names[0])]
    vectors = spark.createDataFrame(rows, f"vec_id bigint, embedding array<double>, label {kind}").repartition(3)
    found = {r["vec_id"]: (r["n_links"], r["component_id"]) for r in forest.near_vectors(vectors, leaf_rows=leaf_rows, trees=6).collect()}
    wanted = _brute_links(rows)
    assert found[1_000] == (1, 1_000) and found[1_001] == (1, 1_000)
    assert sum(n for n, _ in found.values()) >= 0.97 * sum(n for n, _ in wanted.values())
    assert all(found[i][0] <= wanted[i][0] for i in found)
    if leaf_rows == 2_000:
        assert found == wanted


def test_forest_recall_at_production_parameters(spark):
    """20,000 vectors of one label, far above a leaf: planted pairs at cosine 0.98 to 0.99, a dense group, and all others apart."""
    rng = np.random.default_rng(12)
    base = rng.normal(size=(14_000, 64))
    base /= np.linalg.norm(base, axis=1)[:, None]
    aside = rng.normal(size=(4_000, 64))
    aside -= (aside * base[:4_000]).sum(axis=1)[:, None] * base[:4_000]
    aside /= np.linalg.norm(aside, axis=1)[:, None]
    cosine = rng.uniform(0.98001, 0.99, 4_000)[:, None]
    pairs = cosine * base[:4_000] + np.sqrt(1 - cosine**2) * aside
    dense = base[5_000] + 0.005 * rng.normal(size=(2_000, 64))
    every = np.concatenate([base, pairs, dense])
    vectors = spark.createDataFrame([(i, v.tolist(), 3) for i, v in enumerate(every)], "vec_id bigint, embedding array<double>, label int")
    got = {r["vec_id"]: r["n_links"] for r in forest.near_vectors(vectors.repartition(8)).collect()}
    unit = every / np.linalg.norm(every, axis=1)[:, None]
    wanted = np.concatenate([(unit[a : a + 2_000] @ unit.T >= 0.98).sum(axis=1) - 1 for a in range(0, len(unit), 2_000)])
    got = np.array([got[i] for i in range(len(every))])
    assert (got <= wanted).all() and got.sum() >= 0.99 * wanted.sum() and (got > 0).sum() >= 0.99 * (wanted > 0).sum()


def test_pipeline(spark):
    import corpus_pipeline

    sf = "/root/testdata/sf0.001"
    if not Path(sf).exists():
        pytest.skip("no test data")
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, docs, sf)
        assert after.columns == docs.columns and 0 < after.count() <= docs.count()
        docs = spark.createDataFrame(after.collect(), docs.schema)
