"""Shards of bounded size by extendible hashing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from rareflow.llm.common import free_name, settled, text_of

SHARD_BYTES = 1 << 20
HASH_BITS = 60
#: Bits that the directory grows by at a time: it then has this power of two entries for each bucket that is still too large.
STEP_BITS = 12


def place_of(doc_id: Column, text: Column) -> Column:
    """60 hash bits of a row, from its doc_id and its text."""
    key = F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(":"), F.md5(text))
    return F.conv(F.substring(F.md5(key), 1, HASH_BITS // 4), 16, 10).cast("bigint")


def shard_of(rows: DataFrame, limit: int, step: int = STEP_BITS) -> DataFrame:
    """``rows(place, bytes, ...)`` with ``depth``: how many leading bits of its place name a row's bucket.

    A bucket splits on the next bit while it holds more than ``limit`` bytes; all others stay as they are. The directory maps
    the first bits of a place to its bucket's depth: for each prefix the smallest depth at which the sum below it fits. It is made for ``step``
    bits from sums by prefix, and grows by ``step`` bits for the buckets alone that are too large even then. Where the
    bits are used up the depth is all of them.
    """
    done = None
    for start in range(0, HASH_BITS, step):
        known = min(start + step, HASH_BITS)
        rows = rows.withColumn("prefix", F.shiftright("place", HASH_BITS - known))
        sums = rows.groupBy("prefix").agg(F.sum("bytes").alias("below"))
        each = sums.select("prefix", "below", F.explode(F.sequence(F.lit(start), F.lit(known))).alias("at"))
        each = settled(each.withColumn("head", F.expr(f"shiftright(prefix, {known} - at)")), "sums")
        levels = each.groupBy("at", "head").agg(F.sum("below").alias("held")).where(F.col("held") <= limit)
        entries = each.join(levels, ["at", "head"], "left_semi").groupBy("prefix").agg(F.min("at").alias("depth"))
        if start == 0:
            entries = F.broadcast(entries)  # at most 2 ** step rows of 12 bytes
        found = settled(rows.join(entries, "prefix", "left"), "placed")
        fits = found.where("depth is not null")
        done = fits if done is None else done.unionByName(fits)
        rows = found.where("depth is null").drop("depth")
        if rows.isEmpty():
            return done.drop("prefix")
    full = rows.withColumn("depth", F.lit(HASH_BITS))
    return done.unionByName(full).drop("prefix")


def with_pages(rows: DataFrame, limit: int) -> DataFrame:
    """``rows(place, bytes, depth)`` with ``page``: 0, and for rows that share all bits the overflow page that takes them.

    Such rows are numbered by the partition they stand in and inside it, never in one task, and dealt
    to pages of as many rows as fit.
    """
    single = rows.where(F.col("depth") < HASH_BITS).withColumn("page", F.lit(0).cast("long"))
    shared = settled(rows.where(F.col("depth") >= HASH_BITS).withColumn("part", F.spark_partition_id()), "overflow")
    counts = shared.groupBy("place", "part").agg(F.count("*").alias("n"), F.max("bytes").alias("most"))
    earlier = W.partitionBy("place").orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    counts = counts.select(
        "place", "part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"), F.max("most").over(W.partitionBy("place")).alias("most")
    )
    number = F.row_number().over(W.partitionBy("place", "part").orderBy("bytes")) - 1
    fit = F.greatest(F.lit(1), F.floor(F.lit(limit) / F.greatest("most", F.lit(1))))
    numbered = shared.withColumn("number", number).join(counts, ["place", "part"])
    paged = numbered.withColumn("page", F.floor((F.col("before") + F.col("number")) / fit).cast("long"))
    return single.unionByName(paged.drop("part", "number", "before", "most"))


def shards(docs: DataFrame, limit: int = SHARD_BYTES) -> DataFrame:
    """``(doc_id, shard, depth, page, bytes)`` for each row of ``docs``.

    ``shard`` is the bucket's bits as text, ``bytes`` are the text's as UTF-8, 0 for a null one. Every (shard, page) holds at most
    ``limit`` bytes, but where a single text has more. Repeated rows share all bits and go to overflow pages. A null
    doc_id is placed by its text. An empty table gives no rows.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text"))
    rows = rows.select("doc_id", place_of(F.col("doc_id"), F.col("text")).alias("place"), F.octet_length("text").cast("long").alias("bytes"))
    placed = with_pages(shard_of(settled(rows, "places"), limit), limit)
    bits = F.lpad(F.bin("place"), HASH_BITS, "0")
    return placed.select("doc_id", F.substring(bits, F.lit(1), F.col("depth")).alias("shard"), F.col("depth").cast("long").alias("depth"), "page", "bytes")


def write_shards(docs: DataFrame, path: str, limit: int = SHARD_BYTES) -> None:
    """``docs`` as Parquet below ``path``, one folder for each shard and page; equal rows are dealt out by their number."""
    taken = free_name(docs, "shard")
    place, size = place_of(F.col("doc_id"), text_of()), F.octet_length(text_of()).cast("long")
    rows = docs.select(place.alias("place"), size.alias("bytes"), F.struct("*").alias("row"))
    placed = with_pages(shard_of(rows, limit), limit)
    bits = F.concat(F.substring(F.lpad(F.bin("place"), HASH_BITS, "0"), F.lit(1), F.col("depth")), F.lit("_"), F.col("page"))
    named = placed.select(F.concat(F.lit("s"), bits).alias(taken), "row.*")
    named.repartition(taken).write.partitionBy(taken).mode("overwrite").parquet(path)
