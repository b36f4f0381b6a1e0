"""Mixing sources to target weights: raking of token weights, then sampling by calibrated probabilities."""

from __future__ import annotations

import logging
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rareflow.functions.hashing import hash_fraction, md5_hash
from rareflow.llm.common import free_name, settled, text_of
from rareflow.session import cut_lineage, small_table

#: Shares of a margin that no target is given for: the corpus' shares to this power, made to sum to 1.
TEMPERATURE = 0.9
#: Rounds of fitting; a round adjusts every margin once.
ROUNDS = 6
#: Share of all tokens that ``resampled`` keeps.
KEEP = 0.6
#: A value whose share is off its target by more than this part of the target is reported.
OFF = 0.05
#: Most cells whose table is broadcast; with more of them the documents are joined by shuffling.
BROADCAST_CELLS = 200_000
NONE = "(none)"

#: Topics by marks that a text holds in lower case, the first that fits; the last is for all others.
TOPICS: Sequence[tuple[str, tuple[str, ...]]] = (
    ("licence", ("copyright", "license", "licence")),
    ("contact", ("@",)),
    ("web", ("http://", "https://", "www.")),
    ("table", (" | ",)),
)
OTHER_TOPIC = "prose"


def topic_of(text: Column) -> Column:
    """The topic of a text by ``TOPICS``; plain searches, as a pattern would cost more than all the rest."""
    chosen = F.when(F.lit(False), "")
    for name, marks in TOPICS:
        held = F.lit(False)
        for mark in marks:
            held = held | F.contains(F.lower(text), F.lit(mark))
        chosen = chosen.when(held, name)
    return chosen.otherwise(OTHER_TOPIC)


def tokens_of(text: Column) -> Column:
    """Words between white space."""
    return F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")).cast("long")


def _margin(cells, dim, targets, temperature):
    total = cells.groupBy(dim).agg(F.sum("tokens").alias("has"))
    if targets is None:
        share = total.select(dim, F.pow("has", F.lit(temperature)).alias("target"))
    else:
        given = small_table(cells.sparkSession, [(k, float(v)) for k, v in targets.items()], f"`{dim}` string, target double")
        share = total.join(given, dim, "left").select(dim, F.coalesce("target", F.lit(0.0)).alias("target"))
    whole = share.agg(F.sum("target").alias("whole"))
    return cut_lineage(share.join(F.broadcast(whole)).select(dim, (F.col("target") / F.col("whole")).alias("target")))


def rake(
    cells: DataFrame,
    dims: Sequence[str],
    targets: Mapping[str, Mapping[str, float]] | None = None,
    temperature: float = TEMPERATURE,
    rounds: int = ROUNDS,
) -> DataFrame:
    """``cells(*dims, tokens)`` with ``weight``: token shares whose sums by each dimension are its target shares.

    Iterative proportional fitting: each round scales the cells by target over current share, one dimension after the
    other, from the corpus' own shares on. ``targets`` has shares by value for the dimensions it names; values that it leaves out
    get none, and of cells that cannot meet all margins the last dimension's are met. Every step is an aggregate of the
    cell table and a join back; the table is checkpointed after each and never leaves the executors.
    """
    targets = targets or {}
    filled = cells.where("tokens > 0")
    shares = {d: _margin(filled, d, targets.get(d), temperature) for d in dims}
    whole = filled.agg(F.sum("tokens").alias("whole"))
    weighted = filled.join(F.broadcast(whole)).select(*dims, "tokens", (F.col("tokens") / F.col("whole")).alias("weight"))
    weighted = cut_lineage(weighted)
    for _ in range(rounds):
        for dim in dims:
            now = weighted.groupBy(dim).agg(F.sum("weight").alias("now")).join(shares[dim], dim)
            scale = now.select(dim, F.when(F.col("now") > 0, F.col("target") / F.col("now")).otherwise(0.0).alias("scale"))
            # the table stands twice in a step, so it is cut off after each
            scaled = weighted.join(scale, dim).select(*dims, "tokens", (F.col("weight") * F.col("scale")).alias("weight"))
            weighted = cut_lineage(scaled)
    return weighted


def probabilities(raked: DataFrame, dims: Sequence[str]) -> DataFrame:
    """``(*dims, probability)``: what share of a cell's documents to keep so that the kept tokens have the raked weights.

    The scale is the largest at which no probability exceeds 1, so no document is needed twice.
    """
    rows = raked.select(*dims, (F.col("weight") / F.col("tokens")).alias("ratio"))
    top = rows.agg(F.max("ratio").alias("top"))
    return rows.join(F.broadcast(top)).select(*dims, F.round(F.col("ratio") / F.col("top"), 9).alias("probability"))


def rake_within(
    cells: DataFrame,
    dims: Sequence[str],
    keep: float,
    targets: Mapping[str, Mapping[str, float]] | None = None,
    temperature: float = TEMPERATURE,
    rounds: int = ROUNDS,
) -> tuple[DataFrame, DataFrame]:
    """As ``rake``, with weights (and ``most``) that a share ``keep`` of all tokens can have, and the margins reached.

    Weights are shares of the tokens kept; a cell whose weight asks for more tokens than it has gets all of them, and the others of its
    values make up for it. So a rare cell takes nothing from the rest. The second table is ``dimension, value, target, reached``.
    """
    if not 0 < keep <= 1:
        raise ValueError("keep must be above 0 and at most 1")
    targets = targets or {}
    filled = cells.where("tokens > 0")
    shares = {d: _margin(filled, d, targets.get(d), temperature) for d in dims}
    share = F.col("tokens") / F.col("whole")
    whole = filled.agg(F.sum("tokens").alias("whole"))
    rows = filled.join(F.broadcast(whole)).select(*dims, "tokens", (share / F.lit(keep)).alias("most"), share.alias("weight"))
    rows = cut_lineage(rows)
    full = F.col("weight") >= F.col("most")
    for _ in range(rounds):
        for dim in dims:
            held = F.sum(F.when(full, F.col("weight")).otherwise(0.0)).alias("held")
            now = rows.groupBy(dim).agg(F.sum("weight").alias("now"), held).join(shares[dim], dim)
            less = F.when(F.col("now") > 0, F.col("target") / F.col("now")).otherwise(0.0)
            more = F.when(F.col("now") > F.col("held"), (F.col("target") - F.col("held")) / (F.col("now") - F.col("held"))).otherwise(1.0)
            rises = F.col("target") > F.col("now")
            scale = now.select(dim, rises.alias("rises"), F.when(rises, more).otherwise(less).alias("scale"))
            weight = F.when(full & F.col("rises"), F.col("weight")).otherwise(F.least(F.col("weight") * F.col("scale"), F.col("most")))
            rows = cut_lineage(rows.join(scale, dim).select(*dims, "tokens", "most", weight.alias("weight")))
    reached = None
    for dim in dims:
        found = rows.groupBy(dim).agg(F.sum("weight").alias("reached")).join(shares[dim], dim)
        found = found.select(F.lit(dim).alias("dimension"), F.col(dim).alias("value"), "target", "reached")
        reached = found if reached is None else reached.unionByName(found)
    return rows, reached


def _chances_within(cells, dims, keep, targets, temperature, rounds):
    rows, reached = rake_within(cells, dims, keep, targets, temperature, rounds)
    off = F.abs(F.col("reached") - F.col("target"))
    missed = reached.where(off > OFF * F.col("target")).agg(F.count("*").alias("n"), F.max(off).alias("off")).first()
    if missed["n"]:
        logging.getLogger(__name__).warning("%d values miss their target share, by %.6f at most", missed["n"], missed["off"])
    return rows.select(*dims, F.round(F.least(F.col("weight") / F.col("most"), F.lit(1.0)), 9).alias("probability"))


def mixed(
    docs: DataFrame,
    targets: Mapping[str, Mapping[str, float]] | None = None,
    temperature: float = TEMPERATURE,
    rounds: int = ROUNDS,
    keep: float | None = None,
) -> DataFrame:
    """All rows of ``docs`` with ``mix_topic, mix_tokens, mix_probability, mix_kept`` added.

    Dimensions are ``source``, ``lang`` and ``topic`` (from the text); a null counts as the value ``(none)``. A row is kept if
    the hash of its doc_id, or of its text without one, falls below its cell's probability; so repeated rows share their lot and no
    run differs. Documents without a token weigh nothing and are kept. An empty table stays empty.

    ``keep``: the share of all tokens to keep, see ``rake_within``; values that miss their targets are logged. Without it the
    scale is that of ``probabilities``, where the rarest cell decides.
    """
    dims = ["source", "lang", "topic"]
    names = {n: free_name(docs, f"mix_{n}") for n in ("topic", "tokens", "probability", "kept")}
    text = text_of()
    key = F.coalesce(F.col("doc_id").cast("string"), text)
    plain = [F.coalesce(F.col(d).cast("string"), F.lit(NONE)).alias(d) for d in ("source", "lang")]
    counted = docs.select(*plain, topic_of(text).alias("topic"), tokens_of(text).alias("tokens"))
    cells = settled(counted.groupBy(*dims).agg(F.sum("tokens").alias("tokens")), "cells")
    if keep is None:
        raked = cut_lineage(probabilities(rake(cells, dims, targets, temperature, rounds), dims))
    else:
        raked = cut_lineage(_chances_within(cells, dims, keep, targets, temperature, rounds))
    of = {d: free_name(docs, f"mix_of_{d}") for d in dims}
    chance_of = free_name(docs, "mix_chance")
    known = raked.select(*[F.col(d).alias(of[d]) for d in dims], F.col("probability").alias(chance_of))
    if known.count() <= BROADCAST_CELLS:
        known = F.broadcast(known)
    rows = docs.withColumns({names["topic"]: topic_of(text), names["tokens"]: tokens_of(text)})
    values = {"source": plain[0], "lang": plain[1], "topic": F.col(names["topic"])}
    same = [values[d] == known[of[d]] for d in dims]
    joined = rows.join(known, same, "left").drop(*of.values())
    chance = F.when(F.col(names["tokens"]) == 0, 1.0).otherwise(F.coalesce(chance_of, F.lit(0.0)))
    joined = joined.withColumn(names["probability"], chance).drop(chance_of)
    return joined.withColumn(names["kept"], hash_fraction(md5_hash(key)) < F.col(names["probability"]))


def resampled(docs: DataFrame, targets: Mapping[str, Mapping[str, float]] | None = None, keep: float = KEEP) -> DataFrame:
    """The kept rows of ``docs`` with their own columns; they hold about the share ``keep`` of all tokens."""
    rows = mixed(docs, targets, keep=keep)
    return rows.where(F.col(rows.columns[-1])).select(*[F.col(f"`{c}`") for c in docs.columns])
