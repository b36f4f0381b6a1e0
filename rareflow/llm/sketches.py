"""Threshold-scaled sketches of word shingles, and containment between them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from rareflow.llm.common import settled, text_of

SHINGLE_WORDS = 5
#: Share of all hash values that a sketch retains.
FRACTION = 1 / 16
#: Hashes that a sketch retains at least, where the text has as many: the smallest ones.
LEAST = 64
ALL_HASHES = 2**63 - 1
WORD = r"[^\x20\x09-\x0D]+"


def word_hashes(text: Column) -> Column:
    """Hashes of the words between white space."""
    parts = F.filter(F.split(text, r"[\x20\x09-\x0D]+"), lambda w: w != "")
    return F.transform(parts, lambda w: F.xxhash64(w))


def shingle_hashes(named: str, words: int = SHINGLE_WORDS) -> Column:
    """Distinct hashes of the shingles over a column of word hashes; fewer words are one shingle, no word has none."""
    starts = F.sequence(F.lit(0), F.greatest(F.size(named) - words, F.lit(0)))
    # missing words beyond the end of a short text are null, which the hash leaves out
    each = F.transform(starts, lambda i: F.xxhash64(*[F.get(named, i + k) for k in range(words)]))
    return F.when(F.size(named) > 0, F.array_distinct(each)).otherwise(F.array().cast("array<bigint>"))


def with_sketch(
    df: DataFrame,
    text: str,
    name: str,
    words: int = SHINGLE_WORDS,
    fraction: float = FRACTION,
    least: int = LEAST,
    probe: Column | None = None,
) -> DataFrame:
    """``df`` with ``name``, a ``struct<hashes, covered>``: ascending hashes, and the value up to which all of the text's are retained.

    Every hash below the fixed fraction of the range is retained; where those are fewer than ``least``, the ``least``
    smallest are, so that short texts have sketches too. Two sketches merge into that of the joined set: the
    union up to the smaller ``covered``. ``name`` is also the beginning of three names used on the way.

    ``probe``: hashes that are looked up in the text's whole set before it is thinned; ``<name>_size`` and ``<name>_held`` are then
    the sizes of the set and of what it has of them (null where the probe is null).
    """
    bound = -(2**63) + int(fraction * 2**64) - 1
    rest = [F.col(f"`{c}`") for c in df.columns]
    every, below, lowest = f"{name}_every", f"{name}_below", f"{name}_lowest"
    # a column for each step: within a lambda an expression would be computed for each element
    df = df.select(*rest, word_hashes(F.col(text)).alias(every))
    df = df.select(*rest, shingle_hashes(every, words).alias(every))
    if probe is not None:
        held = F.when(probe.isNotNull(), F.size(F.array_intersect(every, probe)))
        df = df.select(*rest, every, F.size(every).alias(f"{name}_size"), held.alias(f"{name}_held"))
        rest += [F.col(f"{name}_size"), F.col(f"{name}_held")]
    df = df.select(*rest, every, F.array_sort(F.filter(every, lambda h: h <= bound)).alias(below))
    df = df.select(*rest, F.size(every).alias(every), below, F.when(F.size(below) < least, F.slice(F.array_sort(every), 1, least)).alias(lowest))
    small = F.struct(
        F.col(lowest).alias("hashes"),
        F.when(F.col(every) > least, F.try_element_at(lowest, F.lit(-1))).otherwise(F.lit(ALL_HASHES)).alias("covered"),
    )
    large = F.struct(F.col(below).alias("hashes"), F.lit(bound).alias("covered"))
    return df.select(*rest, F.when(F.col(lowest).isNull(), large).otherwise(small).alias(name))


def containment(a: Column, b: Column) -> Column:
    """Estimated share of the smaller set of shingles that the larger one holds too, 0 to 1.

    Counted over the hashes that both sketches cover. Equal sketches have 1, one without shingles and another 0.
    """
    upto = F.least(a["covered"], b["covered"])
    within = [F.size(F.filter(x["hashes"], lambda h: h <= upto)) for x in (a, b)]
    common = F.size(F.filter(F.array_intersect(a["hashes"], b["hashes"]), lambda h: h <= upto))
    smaller = F.least(*within)
    return F.when(a == b, 1.0).when(smaller > 0, common / smaller).otherwise(0.0)


def as_text(sketched: Column) -> Column:
    """The sketch as text: ``covered`` and the hashes in hexadecimal; empty for a text without words."""
    digits = F.transform(F.concat(F.array(sketched["covered"]), sketched["hashes"]), lambda h: F.lpad(F.hex(h), 16, "0"))
    return F.when(F.size(sketched["hashes"]) > 0, F.array_join(digits, "")).otherwise("")


def next_ids(docs: DataFrame) -> DataFrame:
    """``(doc_id, next_id)`` for every distinct doc_id in descending order, after the last the first.

    The ids alone are ranged; inside a range the order is a window over it, and the last of a range is followed by
    the highest id of the next lower range, from a table of one row for each range.
    """
    wide = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ids = docs.where("doc_id is not null").select(F.col("doc_id").cast("long").alias("doc_id")).distinct()
    ranged = settled(ids.repartitionByRange(wide, "doc_id").select("doc_id", F.spark_partition_id().alias("part")), "ids")
    highest = ranged.groupBy("part").agg(F.max("doc_id").alias("high"))
    lower = F.lag("high").over(W.orderBy("part"))
    top = F.max("high").over(W.orderBy("part").rowsBetween(W.unboundedPreceding, W.unboundedFollowing))
    follow = highest.select(F.col("part").alias("of"), F.coalesce(lower, top).alias("after"))
    inside = F.lag("doc_id").over(W.partitionBy("part").orderBy("doc_id"))
    listed = ranged.select("doc_id", "part", inside.alias("below"))
    joined = listed.join(follow, listed["part"] == follow["of"])
    return joined.select("doc_id", F.coalesce("below", "after").alias("next_id"))


def edited_fingerprints(docs: DataFrame) -> DataFrame:
    """``doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next`` for each row.

    The edited text has the last third of the code points replaced by the beginning of the next document's text. Null texts are empty.
    A null doc_id has no next document, so its text is only shortened and near_next is 0. Of rows with one doc_id the
    text with the smallest hash is the next document of others; every row has a result of its own.

    Both likenesses are the containment in the smaller set of shingles. ``near_next`` is exact where one of the two texts has so few shingles
    that its sketch is its whole set, which is then looked up in the other's whole set; else it is estimated, as ``near_edited`` is, from
    the hashes that both sketches cover, some 64 or more of the smaller set's for texts of like length.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text"))
    rows = rows.select("doc_id", "text", F.xxhash64("text").alias("mark"), F.floor(F.length("text") / 3).cast("int").alias("cut"))
    follow = next_ids(docs)
    # who asks for how much of which text: narrow rows, before any text is moved; short texts send their whole set along
    given = rows.where("doc_id is not null").groupBy("doc_id").agg(F.min("mark").alias("mark"))
    given = given.select(F.col("doc_id").alias("next_id"), F.col("mark").alias("next_mark"))
    few = F.regexp_count("text", F.lit(WORD)) < LEAST + SHINGLE_WORDS
    asking = rows.select("doc_id", "mark", "cut", F.when(few, word_hashes(F.col("text"))).alias("few"))
    asking = asking.select("doc_id", "mark", "cut", F.when(F.col("few").isNotNull(), shingle_hashes("few")).alias("few"))
    asked = asking.dropDuplicates(["doc_id", "mark"]).join(follow, "doc_id").join(given, "next_id")
    asked = asked.select(
        F.col("doc_id").alias("by"), F.col("mark").alias("by_mark"), F.col("cut").alias("by_cut"), "few", F.col("next_id").alias("id"), "next_mark"
    )
    texts = rows.dropDuplicates(["doc_id", "mark"])
    sent = texts.join(asked, (texts["doc_id"] == asked["id"]) & (texts["mark"] == asked["next_mark"]))
    sent = with_sketch(sent.select("by", "by_mark", "by_cut", "few", "text"), "text", "next", probe=F.col("few"))
    head = F.substring("text", F.lit(1), F.col("by_cut")).alias("head")
    sent = settled(sent.select("by", "by_mark", head, F.size("few").alias("few"), "next", "next_size", "next_held"), "heads")
    both = rows.join(sent, (rows["doc_id"] == sent["by"]) & (rows["mark"] == sent["by_mark"]), "left")
    kept = F.substring("text", F.lit(1), F.length("text") - F.col("cut"))
    both = both.select("doc_id", "text", F.concat(kept, F.coalesce("head", F.lit(""))).alias("edited"), "few", "next", "next_size", "next_held")
    whole = F.when(F.col("next.covered") == ALL_HASHES, F.col("next.hashes"))
    both = with_sketch(with_sketch(both, "text", "own", probe=whole), "edited", "other")
    own, edited, other = F.col("own"), F.col("other"), F.col("next")
    smaller = F.least("own_size", "next_size")
    exact = F.when(smaller == 0, F.when(own == other, 1.0).otherwise(0.0))
    exact = exact.when(F.col("next_held").isNotNull(), F.col("next_held") / smaller).when(F.col("own_held").isNotNull(), F.col("own_held") / smaller)
    near_next = F.when(other.isNull(), 0.0).otherwise(exact.otherwise(containment(own, other)))
    return both.select(
        "doc_id",
        F.length("text").cast("long").alias("n_chars"),
        F.sha2("edited", 256).alias("edited_sha256"),
        as_text(own).alias("fingerprint"),
        as_text(edited).alias("edited_fingerprint"),
        containment(own, edited).alias("near_edited"),
        near_next.alias("near_next"),
    )
