"""Labelled transaction tables derived from the test data."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rareflow.functions.hashing import md5_hash
from rareflow.session import staged
from rareflow.sources.tables import scan_parquet, spread

KEY = ("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber")
FEATURES = ["Time", "V1", "V2", "V3", "Amount"]
WIDE = [f"V{i}" for i in range(1, 65)]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return scan_parquet(spark, f"{sf_dir}/{name}.parquet")


def txn(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as transactions: txn_id, h, Time, V1..V3, Amount, a rule score and a rare Class."""
    items = table(spark, sf_dir, "lineitem")
    first_day = items.agg(F.min("l_shipdate").alias("t0")).scalar()
    key = F.concat_ws("|", *[F.col(c).cast("string") for c in KEY])
    used = spread(items.select(*KEY, "l_shipdate", "l_quantity", "l_discount", "l_tax", "l_extendedprice"))
    rows = used.select(
        key.alias("txn_id"),
        md5_hash(key).alias("h"),
        F.timestamp_diff("SECOND", first_day, "l_shipdate").cast("double").alias("Time"),
        F.col("l_quantity").alias("V1"),
        F.col("l_discount").alias("V2"),
        F.col("l_tax").alias("V3"),
        F.col("l_extendedprice").alias("Amount"),
    )
    rule = (F.col("V1") >= 49) & (F.col("V2") >= 0.09) & (F.col("V3") <= 0.05) & (F.col("h") % 10 != 0)
    return rows.select(
        "*",
        ((F.col("V1") * 2 + F.col("V2") * 500) / 150).alias("score"),
        F.when(rule, 1).otherwise(0).alias("Class"),
    )


def stored_txn(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    """The transactions as a Parquet table, for operators that pass over them several times."""
    return staged(txn(spark, sf_dir).select(*columns), "txn")


def features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The transactions in the layout of a raw table: features and label only."""
    return txn(spark, sf_dir).select(*FEATURES, "Class")


def ev(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as skewed amounts; purchases are the positives."""
    events = table(spark, sf_dir, "events")
    first = events.agg(F.min("ts").alias("t0")).scalar()
    return spread(events.select("event_id", "ts", "value", "event_type")).select(
        "event_id",
        (F.timestamp_diff("MICROSECOND", first, "ts") / 1e6).alias("Time"),
        F.col("value").alias("Amount"),
        F.when(F.col("event_type") == "purchase", 1).otherwise(0).alias("Class"),
    )


def emb(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All embedding dimensions in the shape of the card table."""
    return table(spark, sf_dir, "embeddings").select(
        *[F.col("embedding")[i].cast("double").alias(c) for i, c in enumerate(WIDE)],
        F.when(F.col("label") == 0, 1).otherwise(0).alias("Class"),
    )


def two_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two rule scores of every transaction as rows of a model column."""
    rule, amount = F.col("score"), F.col("Amount") / 1e5
    each = [F.struct(F.lit(m).alias("model"), s.alias("score")) for m, s in (("rule", rule), ("amount", amount))]
    return txn(spark, sf_dir).select("Class", F.inline(F.array(*each)))
