"""Train/test splits and samples."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rareflow.functions.columns import col
from rareflow.functions.hashing import hash_fraction
from rareflow.operators.quantiles import cells_of, leading_counts, leading_digit, locate, owned, select_inside, with_key
from rareflow.schema import LABEL
from rareflow.session import small_table, staged


def split_random(df: DataFrame, ratio: float = 0.8, seed: int = 42) -> tuple[DataFrame, DataFrame]:
    """``randomSplit``; the rows drawn depend on how the input is partitioned."""
    train, test = df.randomSplit([ratio, 1 - ratio], seed=seed)
    return train, test


def sample_fraction(df: DataFrame, fraction: float, seed: int = 42) -> DataFrame:
    """Bernoulli sample without replacement; a fraction above 1 raises."""
    return df.sample(withReplacement=False, fraction=fraction, seed=seed)


def sample_rand(df: DataFrame, fraction: float, seed: int = 42) -> DataFrame:
    return df.where(F.rand(seed) < fraction)


def sample_hash(df: DataFrame, fraction: float, h: Column) -> DataFrame:
    """Bernoulli sample decided by the row's own hash."""
    return df.where(hash_fraction(h) < fraction)


def mark_hash_split(df: DataFrame, ratio: float, h: Column, part: str = "part") -> DataFrame:
    """``train`` or ``test`` from the hash alone: one narrow pass, the ratio holds up to sampling error."""
    return df.withColumn(part, F.when(hash_fraction(h) < ratio, "train").otherwise("test"))


def mark_stratified_split(
    df: DataFrame,
    h: Column,
    tie: Column,
    ratio: float = 0.8,
    label: str = LABEL,
    part: str = "part",
    stage_keys: bool = False,
) -> DataFrame:
    """``train`` for exactly floor(ratio * n) rows of each class, the smallest by (hash, tie); ``test`` for the others.

    The rows are not ranked: only the last (hash, tie) of each class's training part is looked up,
    then one narrow pass compares every row with it. Rows equal in both hash and tie stay together,
    which keeps copies out of the other part; the ratio is exact when no such rows meet at the cut.

    ``h`` must spread over [0, 2**32): the distinct ties at the one hash of the cut are ranked in one task, some
    hundreds for 10**12 rows, and copies of a row count as one.

    The look-up makes two passes over label, hash and tie: one counts the leading digits of the hashes, one keeps the few rows whose
    digit holds a cut. ``stage_keys`` writes the three to the shared folder once, which pays where the hash covers many columns.
    """
    keyed = df.select(col(label).alias("g"), F.lit(0).alias("position"), h.cast("double").alias("value"), tie.alias("t"))
    if stage_keys:
        keyed = staged(keyed, "split-keys")
    cuts = _last_of_train(keyed, ratio)
    if not cuts:
        return df.withColumn(part, F.lit("test"))

    def of_class(pick: dict) -> Column:
        value = None
        for group, x in pick.items():
            hit = col(label).eqNullSafe(F.lit(group))
            value = F.when(hit, F.lit(x)) if value is None else value.when(hit, F.lit(x))
        return value

    at_or_before = h < of_class({g: cut for g, (cut, _) in cuts.items()})
    ties = {g: tie_cut for g, (_, tie_cut) in cuts.items() if tie_cut is not None}
    if ties:
        at_cut = h == of_class({g: cut for g, (cut, _) in cuts.items()})
        at_or_before = at_or_before | (at_cut & F.coalesce(tie <= of_class(ties), F.lit(False)))
    return df.withColumn(part, F.when(at_or_before, "train").otherwise("test"))


def _last_of_train(keyed: DataFrame, ratio: float) -> dict[object, tuple[int, object]]:
    """For each class the hash at rank floor(ratio * n) and the last tie at that hash that still fits, None if none does."""
    counts = leading_counts(keyed)
    cells = cells_of(counts)
    if not cells:
        return {}
    ranks = [min(max(math.floor(c["n"] * ratio), 1), c["n"]) for c in cells]
    hits = locate(owned(counts, [(c["g"], 0) for c in cells]), list(enumerate(ranks)))
    buckets = [(c["g"], 0, hits[i, ranks[i]]["bucket"]) for i, c in enumerate(cells)]
    near = with_key(owned(keyed.withColumn("bucket", leading_digit("value")), buckets, "_bucket bigint"))
    near = staged(near.groupBy("owner", "key", "value", "t").agg(F.count("*").alias("n")), "cut")
    asked = {(i, ranks[i] - hits[i, ranks[i]]["below"]): hits[i, ranks[i]]["n"] for i in range(len(cells))}
    found = {owner: at for (owner, _), at in select_inside(near.select("owner", "key", "value", "n"), asked).items()}
    room = [math.floor(c["n"] * ratio) - hits[i, ranks[i]]["below"] - found[i][1] for i, c in enumerate(cells)]
    rows = [(i, found[i][0], room[i]) for i in range(len(cells))]
    table = small_table(keyed.sparkSession, rows, "_owner int, _value double, room bigint")
    at_cut = near.join(table, (F.col("owner") == F.col("_owner")) & (F.col("value") == F.col("_value")))
    before = F.sum("n").over(Window.partitionBy("owner").orderBy("t").rowsBetween(Window.unboundedPreceding, 0)) - F.col("n")
    fitting = at_cut.withColumn("before", before).where(F.col("before") + F.col("n") / 2 <= F.col("room"))
    ties = {r["owner"]: r["t"] for r in fitting.groupBy("owner").agg(F.max("t").alias("t")).collect()}
    return {c["g"]: (int(found[i][0]), ties.get(i)) for i, c in enumerate(cells)}


def parts(marked: DataFrame, part: str = "part") -> tuple[DataFrame, DataFrame]:
    """The train and the test rows of a marked table."""
    return tuple(marked.where(F.col(part) == name).drop(part) for name in ("train", "test"))


def split_stratified(
    df: DataFrame, h: Column, tie: Column, ratio: float = 0.8, label: str = LABEL, stage_keys: bool = False
) -> tuple[DataFrame, DataFrame]:
    return parts(mark_stratified_split(df, h, tie, ratio, label, "_part", stage_keys), "_part")
