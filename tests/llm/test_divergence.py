"""The vocabulary against sorted lists, the audit against plain counting."""

import random
import re
import sys
from collections import Counter
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))

from rareflow.llm import divergence
from rareflow.llm.vocabulary import GAP, Transducer, shards_of, terms_of

SCHEMA = "doc_id bigint, text string, lang string, source string, value int, rank string"
TERM = re.compile("[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def test_terms():
    text = "Été-42 O'Neill's ÀÇ_z [x] y {w}~東京\x7fK"
    assert [t.decode() for t in terms_of(text.encode())] == [t.translate(LOWER) for t in TERM.findall(text)]


def test_transducer():
    rng = random.Random(1)
    words = sorted({"".join(rng.choice("abcé") for _ in range(rng.randint(1, 7))).encode() for _ in range(900)})
    automaton = Transducer.from_bytes(Transducer.build(words).to_bytes())
    assert automaton.numbers(GAP.join(words)).tolist() == list(range(len(words)))
    assert [automaton.word(k) for k in range(len(words))] == words
    others = [b"", b"zz", words[5] + b"z", words[5] + b"a" * 50, words[7]]
    known = {w: k for k, w in enumerate(words)}
    assert automaton.numbers(GAP.join(others)).tolist() == [known.get(w, -1) for w in others]
    behind = [w[1:] for w in words if w[:1] == b"b" and len(w) > 1]
    assert automaton.numbers(GAP.join(behind), b"b").tolist() == [known[b"b" + w] for w in behind]
    assert set(automaton.numbers(b"a\nb", b"q").tolist()) == {-1} and set(Transducer.build([]).numbers(b"a").tolist()) == {-1}
    with pytest.raises(ValueError):
        Transducer.build([b"b", b"a"])
    assert [(a, n) for a, n, _ in shards_of(iter(words[:5]), 2)] == [(words[0], 2), (words[2], 2), (words[4], 1)]


def test_transducer_is_minimal():
    words = sorted(a + b for a in (b"re", b"un", b"over") for b in (b"do", b"doing", b"does", b"done"))
    automaton = Transducer.build(words)
    # equal endings are shared: r-e, u-n and o-v-e-r lead to one state, from which "do", "doing", "does", "done" go on
    accepted = {(bool(f), *sorted(endings(automaton, s))) for s, f in enumerate(automaton.final)}
    assert len(accepted) == len(automaton.final) == 14


def endings(automaton, state):
    out = [b""] if automaton.final[state] else []
    for key, to in zip(automaton.keys.tolist(), automaton.target.tolist()):
        if key >> 8 == state:
            out += [bytes([key & 255]) + rest for rest in endings(automaton, to)]
    return out


def plain_audit(rows, min_docs, top):
    groups, in_docs = {}, Counter()
    for text, lang, source in rows:
        lang, source = lang or "", source or ""
        words = [t.translate(LOWER) for t in TERM.findall(text or "")]
        groups.setdefault((lang, source), Counter()).update(words)
        in_docs.update((lang, w) for w in set(words))
    out = []
    for lang in {g[0] for g in groups}:
        kept = sorted((w for (at, w), n in in_docs.items() if at == lang and n >= min_docs), key=str.encode)
        mine = {s: c for (at, s), c in groups.items() if at == lang}
        whole = Counter()
        for c in mine.values():
            whole.update(c)

        def share(counts, kept=kept):
            total = sum(counts[w] for w in kept)
            return [1 + 10**9 * (counts[w] + 2) // (total + 2 * len(kept)) for w in kept]

        apart = lambda p, q: (p - q) ** 2 // (p + q)
        shares, q = {s: share(c) for s, c in mine.items()}, share(whole)
        for s, c in mine.items():
            pairs = [(sum(map(apart, shares[s], shares[o])), o) for o in mine if o != s]
            pairs.sort(key=lambda x: (-x[0], x[1].encode()))
            out += [(lang, s, "pair", o, v, k + 1) for k, (v, o) in enumerate(pairs)]
            terms = [(apart(p, r), w) for w, p, r in zip(kept, shares[s], q) if c[w] and p > r]
            terms.sort(key=lambda x: (-x[0], x[1].encode()))
            out += [(lang, s, "term", w, v, k + 1) for k, (v, w) in enumerate(terms[:top])]
    return sorted(out)


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(9)
    words = ["".join(rng.choice("abcdéß") for _ in range(rng.randint(1, 4))) for _ in range(150)]
    made = []
    for _ in range(240):
        lang, source = rng.choice(["en", "en", "de", None]), rng.choice(["s1", "S2", "é", None, "s10"])
        pool = words[:90] if source == "s1" else words
        text = " ".join(rng.choice(pool).upper() if rng.random() < 0.1 else rng.choice(pool) for _ in range(rng.randint(0, 60)))
        made.append((text, lang, source))
    made += [(None, "en", "only null"), ("", "fr", "a"), ("x y", "fr", "b"), ("z " * 3000, "fr", "b"), ("!" * 50, "", "s1"), made[0], made[0]]
    made += [("abc\x00def one", "e\x00n", "s\x001"), ("q" * 5000, "en", "s1")]
    return made


@pytest.mark.parametrize("shard_terms, group_entries, min_docs", [(50_000, 2_000_000, 10), (7, 40, 3)])
def test_audit(spark, monkeypatch, rows, shard_terms, group_entries, min_docs):
    if shard_terms == 7:
        monkeypatch.setattr(divergence, "TERM_BLOCK", 16)
        monkeypatch.setattr(divergence, "SOURCE_BLOCK", 2)
        monkeypatch.setattr(divergence, "COUNTED", 50)
    docs = spark.createDataFrame([(k, *r, 1, "x") for k, r in enumerate(rows)], SCHEMA).repartition(5)
    found = divergence.source_audit(docs, min_docs, 10, shard_terms, group_entries)
    assert sorted(tuple(r) for r in found.collect()) == plain_audit(rows, min_docs, 10)


def test_of_nothing(spark):
    nothing = spark.createDataFrame([], SCHEMA)
    assert divergence.source_audit(nothing).count() == 0
    one = spark.createDataFrame([(1, "a b", "en", "s", 1, "x"), (2, "c", "en", "t", 1, "x")], SCHEMA)
    assert sorted(tuple(r) for r in divergence.source_audit(one).collect()) == [("en", "s", "pair", "t", 0, 1), ("en", "t", "pair", "s", 0, 1)]


def test_shares_beyond_64_bits(spark):
    row = spark.range(1).selectExpr("5000000000000000000 as n", "9000000000000000000 as total", "7 as kept")
    assert row.select(divergence._share("n", "total", "kept")).first()[0] == 1 + 10**9 * (5 * 10**18 + 2) // (9 * 10**18 + 14)
