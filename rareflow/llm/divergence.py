"""How far the sources of a language differ in their words: recounting texts through a vocabulary of transducers."""

from __future__ import annotations

from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rareflow.llm.common import settled, text_of
from rareflow.llm.tokens import forget
from rareflow.llm.vocabulary import GAP, Transducer, shards_of, terms_of

MIN_DOCS = 10
TOP_TERMS = 10
#: Terms of one transducer, and the number of transducers from which on they get larger instead of more.
SHARD_TERMS, MOST_SHARDS = 50_000, 2_000
#: Distinct entries that a task counts before it sends them on.
COUNTED = 300_000
#: Entries that go through a transducer in one task.
GROUP_ENTRIES = 2_000_000
#: Terms and sources whose differences are summed up together.
TERM_BLOCK, SOURCE_BLOCK = 4_096, 256
#: A term's number is that of its transducer, shifted by this, plus its place in it.
SHARD_BITS = 32
#: Between language and term in a key; no term holds it.
MARK = b"\0"


def _plain(name: str) -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(_plain("lang").alias("lang"), _plain("source").alias("source"), text_of().alias("text"))


def _batches_of(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, str, bytes]]:
    for batch in batches:
        yield from zip(batch.column("lang").to_pylist(), batch.column("source").to_pylist(), batch.column("text").cast(pa.binary()).to_pylist())


def kept_terms(docs: DataFrame, min_docs: int = MIN_DOCS) -> DataFrame:
    """``(lang, term)`` of the terms that at least ``min_docs`` rows of the language hold; counted per task before they are shuffled."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        counts: dict[str, Counter] = {}
        fresh = 0

        def rows():
            for lang, found in counts.items():
                columns = [pa.array([lang] * len(found), pa.string()), pa.array(list(found), pa.binary()).cast(pa.string()), pa.array(list(found.values()), pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, names=["lang", "term", "n"])

        for lang, _, text in _batches_of(batches):
            mine = counts.setdefault(lang, Counter())
            before = len(mine)
            mine.update(set(terms_of(text)))
            fresh += len(mine) - before
            if fresh >= COUNTED:
                yield from rows()
                counts, fresh = {}, 0
        yield from rows()

    counted = _texts(docs).mapInArrow(count, "lang string, term string, n long").groupBy("lang", "term").agg(F.sum("n").alias("n"))
    return counted.where(F.col("n") >= min_docs).select("lang", "term")


def transducers(terms: DataFrame, shard_terms: int = SHARD_TERMS) -> DataFrame:
    """``(shard, low, terms, automaton)``: the sorted keys of language and term, cut into transducers of ascending ``shard`` number."""
    total = terms.count()
    parts = max(1, min(MOST_SHARDS, -(-total // shard_terms)))
    most = max(shard_terms, -(-total // MOST_SHARDS))
    key = F.concat(F.col("lang").cast("binary"), F.lit(MARK), F.col("term").cast("binary")).alias("key")

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = TaskContext.get().partitionId() << 12  # partitions ascend with the keys
        words = (w for batch in batches for w in batch.column("key").to_pylist())
        for number, (low, count, automaton) in enumerate(shards_of(words, most)):
            columns = [pa.array([first + number], pa.int64()), pa.array([low], pa.binary()), pa.array([count], pa.int64()), pa.array([automaton], pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=["shard", "low", "terms", "automaton"])

    by_range = terms.select(key).repartitionByRange(parts, "key").sortWithinPartitions("key")
    return by_range.mapInArrow(build, "shard long, low binary, terms long, automaton binary")


def _routed(docs: DataFrame, bounds: list[tuple[int, bytes]]) -> DataFrame:
    """``(shard, part, lang, source, entries, words, counts)``: each task's counted words, dealt to the transducers that may hold them."""
    shards, lows = [s for s, _ in bounds], [low for _, low in bounds]

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        part = TaskContext.get().partitionId() << 32
        counts: dict[tuple[str, str], Counter] = {}
        fresh = 0

        def rows():
            nonlocal part
            out = []
            for (lang, source), found in counts.items():
                words, prefix = sorted(found), lang.encode() + MARK
                # a transducer holds the keys from its first up to that of the next one
                of_lang = slice(max(0, bisect_left(lows, prefix) - 1), bisect_left(lows, lang.encode() + b"\1"))
                cuts = [bisect_left(words, low[len(prefix) :]) if low > prefix else 0 for low in lows[of_lang]]
                for shard, a, z in zip(shards[of_lang], cuts, [*cuts[1:], len(words)]):
                    for at in range(a, z, 50_000):
                        mine = words[at : min(z, at + 50_000)]
                        out.append((shard, part, lang, source, len(mine), GAP.join(mine), np.array([found[w] for w in mine], dtype="<i8").tobytes()))
                        part += 1
                        if len(out) == 200:
                            yield pa.RecordBatch.from_pylist([dict(zip(ROUTED.names, r)) for r in out], ROUTED)
                            out = []
            if out:
                yield pa.RecordBatch.from_pylist([dict(zip(ROUTED.names, r)) for r in out], ROUTED)

        for lang, source, text in _batches_of(batches):
            mine = counts.setdefault((lang, source), Counter())
            before = len(mine)
            mine.update(terms_of(text))
            fresh += len(mine) - before
            if fresh >= COUNTED:
                yield from rows()
                counts, fresh = {}, 0
        yield from rows()

    return _texts(docs).mapInArrow(route, "shard long, part long, lang string, source string, entries long, words binary, counts binary")


ROUTED = pa.schema(
    [("shard", pa.int64()), ("part", pa.int64()), ("lang", pa.string()), ("source", pa.string()), ("entries", pa.int64()), ("words", pa.binary()), ("counts", pa.binary())]
)


def recounted(docs: DataFrame, automata: DataFrame, group_entries: int = GROUP_ENTRIES) -> DataFrame:
    """``(lang, source, ordinal, n)``: how often each kept term occurs in each group, by running the texts' words through the transducers.

    A task has one transducer and a bounded share of the words that may be in it; the numbers that it writes are then summed up. The bounds
    that a word is dealt by are one for each transducer, some thousands at most.
    """
    bounds = [(r["shard"], bytes(r["low"])) for r in automata.select("shard", "low").orderBy("shard").collect()]
    routed = settled(_routed(docs, bounds), "words")
    dealt = routed.groupBy("shard").agg(F.sum("entries").alias("held"))
    salts = F.ceil(F.col("held") / F.lit(group_entries)).cast("long").alias("salts")
    dealt = dealt.select("shard", salts)
    words = routed.join(F.broadcast(dealt), "shard").withColumn("salt", F.pmod(F.xxhash64("part"), F.col("salts")))
    sent = automata.join(F.broadcast(dealt), "shard").withColumn("salt", F.explode(F.sequence(F.lit(0).cast("long"), F.col("salts") - 1)))

    def count(key, left: pa.Table, right: pa.Table) -> pa.Table:
        sums: dict[tuple[str, str], list[tuple[np.ndarray, np.ndarray]]] = {}
        if left.num_rows and right.num_rows:
            automaton = Transducer.from_bytes(right["automaton"][0].as_py())
            for row in left.select(["lang", "source", "words", "counts"]).to_pylist():
                number = automaton.numbers(row["words"], row["lang"].encode() + MARK)
                known = number >= 0
                sums.setdefault((row["lang"], row["source"]), []).append((number[known], np.frombuffer(row["counts"], dtype="<i8")[known]))
        out = []
        for (lang, source), found in sums.items():
            number, n = (np.concatenate(x) for x in zip(*found))
            once, place = np.unique(number, return_inverse=True)
            total = np.zeros(len(once), dtype=np.int64)
            np.add.at(total, place, n)
            ordinal = (key[0].as_py() << SHARD_BITS) + once
            out.append(pa.table([pa.array([lang] * len(once), pa.string()), pa.array([source] * len(once), pa.string()), pa.array(ordinal, pa.int64()), pa.array(total)], schema=COUNTS))
        return pa.concat_tables(out) if out else COUNTS.empty_table()

    grouped = words.select("shard", "salt", "lang", "source", "words", "counts").groupBy("shard", "salt")
    found = grouped.cogroup(sent.select("shard", "salt", "automaton").groupBy("shard", "salt")).applyInArrow(count, "lang string, source string, ordinal long, n long")
    return found.groupBy("lang", "source", "ordinal").agg(F.sum("n").alias("n"))


COUNTS = pa.schema([("lang", pa.string()), ("source", pa.string()), ("ordinal", pa.int64()), ("n", pa.int64())])


def _share(n: Column | str, total: str, kept: str) -> Column:
    """1 + floor(10^9 (n + 2) / (total + 2 kept)), exact at any size."""
    n = F.col(n) if isinstance(n, str) else n
    above = F.lit(1_000_000_000).cast("decimal(10,0)") * (n.cast("decimal(20,0)") + F.lit(2).cast("decimal(1,0)"))
    under = F.col(total).cast("decimal(20,0)") + F.lit(2).cast("decimal(1,0)") * F.col(kept).cast("decimal(19,0)")
    return F.lit(1) + F.call_function("div", above, under)


def _apart(p, q):
    return (p - q) * (p - q) // (p + q)


def source_pairs(counts: DataFrame, groups: DataFrame) -> DataFrame:
    """``(lang, source, item, value)``: the summed difference of every two sources of a language over all kept terms.

    ``counts`` has ``lang, source, ordinal, p``, ``groups`` has ``lang, source, p0, kept`` with p0 the share of a term that the group
    lacks. Terms are dealt to blocks and sources as well, so a task holds two small matrices; terms that
    none of its sources has are alike and are counted only. One row for each block and pair of sources is then summed up.
    """
    block = F.expr(f"ordinal div {TERM_BLOCK}")
    held = counts.groupBy("lang", "source", block.alias("block")).agg(F.collect_list(F.struct("ordinal", "p")).alias("terms"))
    sizes = counts.select("lang", "ordinal").distinct().groupBy("lang", block.alias("block")).agg(F.count("*").alias("of_block"))
    numbered = groups.withColumn("mine", F.expr(f"(row_number() over (partition by lang order by source) - 1) div {SOURCE_BLOCK}"))
    most = numbered.groupBy("lang").agg(F.max("mine").alias("most"))
    rows = numbered.join(most, "lang").join(sizes, "lang", "left").join(held, ["lang", "source", "block"], "left")
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("most"))))
    rows = rows.withColumns({"low": F.least("mine", "other"), "high": F.greatest("mine", "other")})
    rows = rows.select(
        "lang", "block", "low", "high", "mine", "source", F.coalesce("p0", F.lit(0)).alias("p0"), F.coalesce("of_block", F.lit(0)).alias("of_block"),
        F.col("terms.ordinal").alias("ordinals"), F.col("terms.p").alias("shares"),
    )

    def compare(key, table: pd.DataFrame) -> pd.DataFrame:
        table = table.sort_values("source", kind="stable").reset_index(drop=True)
        lists = [np.asarray([] if x is None else x, dtype=np.int64) for x in table["ordinals"]]
        terms = np.unique(np.concatenate(lists))
        p0 = table["p0"].to_numpy()
        shares = np.repeat(p0[:, None], len(terms), axis=1)
        for k, (ordinals, p) in enumerate(zip(lists, table["shares"])):
            shares[k, np.searchsorted(terms, ordinals)] = np.asarray([] if p is None else p, dtype=np.int64)
        lacking = int(table["of_block"].iloc[0]) - len(terms)
        mine, source = table["mine"].to_numpy(), table["source"].to_numpy()
        left, right = np.flatnonzero(mine == key[2]), np.flatnonzero(mine == key[3])
        out = []
        for a in left.tolist():
            value = np.zeros(len(right), dtype=np.int64)
            if lacking or len(terms):
                for at in range(0, len(terms), 1_024):
                    part = slice(at, at + 1_024)
                    value += _apart(shares[a, part], shares[right, part]).sum(axis=1)
                if lacking:
                    value += lacking * _apart(p0[a], p0[right])
            other = right != a
            out.append(pd.DataFrame({"source": source[a], "item": source[right][other], "value": value[other]}))
            if key[2] != key[3]:
                out.append(pd.DataFrame({"source": source[right], "item": source[a], "value": value}))
        return pd.concat(out).assign(lang=key[0])[["lang", "source", "item", "value"]]

    found = rows.groupBy("lang", "block", "low", "high").applyInPandas(compare, "lang string, source string, item string, value long")
    return found.groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))


def _spelt(numbers: DataFrame, automata: DataFrame) -> DataFrame:
    """``(ordinal, term)`` of distinct numbers, read back from the transducers."""

    def spell(key, left: pa.Table, right: pa.Table) -> pa.Table:
        words: list[bytes] = []
        if left.num_rows:
            automaton = Transducer.from_bytes(right["automaton"][0].as_py())
            words = [automaton.word(n & ((1 << SHARD_BITS) - 1)).rpartition(MARK)[2] for n in left["ordinal"].to_pylist()]
        return pa.table({"ordinal": left["ordinal"], "term": pa.array(words, pa.binary()).cast(pa.string())})

    wanted = numbers.select("ordinal", F.shiftright("ordinal", SHARD_BITS).alias("shard")).groupBy("shard")
    return wanted.cogroup(automata.select("shard", "automaton").groupBy("shard")).applyInArrow(spell, "ordinal long, term string")


def source_audit(docs: DataFrame, min_docs: int = MIN_DOCS, top_terms: int = TOP_TERMS, shard_terms: int = SHARD_TERMS, group_entries: int = GROUP_ENTRIES) -> DataFrame:
    """``(lang, source, part, item, value, rank)`` for each source of each language of ``docs(text, lang, source)``.

    A language keeps the V terms that at least ``min_docs`` of its rows hold. With count n of a kept term and N the sum of the counts,
    its share is p = 1 + floor(10^9 (n + 2) / (N + 2 V)), in the group and in the whole language; two shares differ by
    floor((p - q)^2 / (p + q)). Part ``pair`` has the sum of the differences from every other source of the language (0 without kept terms), part
    ``term`` the ``top_terms`` terms that the group holds and uses more than its language does, with their differences. Ranks go by
    falling value, then by the item's bytes, for terms by their number in the sorted vocabulary.

    Nulls in the three columns are the empty string; every row counts, repeated ones too; no other column is looked at; an empty table gives no rows.
    """
    terms = settled(kept_terms(docs, min_docs), "terms")
    automata = settled(transducers(terms, shard_terms), "transducers")
    kept = terms.groupBy("lang").agg(F.count("*").alias("kept"))
    counts = settled(recounted(docs, automata, group_entries), "counts")
    totals = counts.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    groups = docs.select(_plain("lang").alias("lang"), _plain("source").alias("source")).distinct()
    groups = groups.join(kept, "lang", "left").join(totals, ["lang", "source"], "left").fillna(0, ["kept", "total"])
    groups = settled(groups.withColumn("p0", F.when(F.col("kept") > 0, _share(F.lit(0), "total", "kept"))), "groups")
    overall = groups.groupBy("lang").agg(F.sum("total").alias("lang_total"))
    known = groups.join(overall, "lang").select("lang", "source", "total", "kept", "lang_total")
    in_lang = F.sum("n").over(Window.partitionBy("lang", "ordinal"))
    shares = counts.withColumn("lang_n", in_lang).join(known, ["lang", "source"])
    shares = shares.select("lang", "source", "ordinal", _share("n", "total", "kept").alias("p"), _share("lang_n", "lang_total", "kept").alias("q"))
    shares = settled(shares, "shares")

    pairs = source_pairs(shares.select("lang", "source", "ordinal", "p"), groups.select("lang", "source", "p0", "kept"))
    ranked = F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item"))
    pairs = pairs.select("lang", "source", F.lit("pair").alias("part"), "item", "value", ranked.alias("rank"))

    gap = F.col("p") - F.col("q")
    value = F.call_function("div", gap * gap, F.col("p") + F.col("q")).alias("value")
    more = shares.where("p > q").select("lang", "source", "ordinal", value)
    place = F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.desc("value"), "ordinal"))
    tops = settled(more.withColumn("rank", place).where(F.col("rank") <= top_terms), "tops")
    spelt = _spelt(tops.select("ordinal").distinct(), automata)
    tops = tops.join(spelt, "ordinal").select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), "value", "rank")
    return pairs.unionByName(tops)
