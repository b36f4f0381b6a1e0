import math

import pytest
from pyspark.sql import functions as F

from rareflow.functions.columns import col
from rareflow.functions.hashing import HASH_RANGE, hash_fraction, md5_hash, row_hash
from rareflow.operators import balance, split



def h():
    return row_hash(["id"])


def key():
    return F.col("id")


def ids(df):
    return sorted(r["id"] for r in df.select("id").collect())


def test_hashes(spark, labelled):
    r = labelled.select(h().alias("h"), md5_hash(key().cast("string")).alias("m"), hash_fraction(h()).alias("f")).agg(
        *[f(c) for c in ("h", "m", "f") for f in (F.min, F.max)], F.countDistinct("h")
    ).first()
    assert 0 <= r[0] < r[1] < HASH_RANGE and 0 <= r[2] < r[3] < HASH_RANGE and 0 <= r[4] < r[5] < 1 and r[6] == 2000


@pytest.mark.parametrize("ratio", [0.8, 0.37])
def test_stratified_split_is_exact_and_repeatable(labelled, ratio):
    train, test = split.split_stratified(labelled, h(), key(), ratio)
    assert ids(train) != ids(test) and sorted(ids(train) + ids(test)) == list(range(2000))
    for c in (0, 1):
        n = labelled.where(col("Class") == c).count()
        assert train.where(col("Class") == c).count() == math.floor(n * ratio)
    again, _ = split.split_stratified(labelled.repartition(11, "a"), h(), key(), ratio)
    assert ids(again) == ids(train)


def test_stratified_split_breaks_hash_ties_by_key(labelled):
    train, _ = split.split_stratified(labelled, F.col("id") % 3, key(), 0.5)
    expected = []
    for c in (0, 1):
        members = sorted(ids(labelled.where(col("Class") == c)), key=lambda i: (i % 3, i))
        expected += members[: len(members) // 2]
    assert ids(train) == sorted(expected)


def test_stratified_split_reads_its_input_twice(spark, labelled, tmp_path):
    labelled.write.parquet(f"{tmp_path}/rows")
    read = spark.sparkContext.accumulator(0)

    @F.udf("bigint")
    def seen(x):
        read.add(1)
        return x

    rows = spark.read.parquet(f"{tmp_path}/rows").withColumn("id", seen.asNondeterministic()("id"))
    split.mark_stratified_split(rows, h(), key())
    assert read.value == 2 * 2000


def test_copies_stay_together(spark):
    rows = [(1, 0)] * 300 + [(i, 0) for i in range(2, 602)]
    df = spark.createDataFrame(rows, "id bigint, Class int")
    train, test = split.split_stratified(df, row_hash(["id"]), F.col("id"), 0.8)
    assert not set(ids(train)) & set(ids(test))
    assert abs(train.count() - 720) <= 150


def test_tiny_classes(spark):
    df = spark.createDataFrame([(1, 0), (2, 1), (3, 1)], "id bigint, Class int")
    train, test = split.split_stratified(df, h(), key(), 0.8)
    assert (train.count(), test.count()) == (1, 2)
    empty = df.where("id < 0")
    assert split.mark_stratified_split(empty, h(), key()).count() == 0


def test_random_and_hash_samples(labelled):
    train, test = split.split_random(labelled)
    assert train.count() + test.count() == 2000
    assert 150 < split.sample_fraction(labelled, 0.1).count() < 250
    assert 150 < split.sample_rand(labelled, 0.1).count() < 250
    small = split.sample_hash(labelled, 0.1, h())
    assert 150 < small.count() < 250 and ids(small) == ids(split.sample_hash(labelled.repartition(3), 0.1, h()))
    marked = split.mark_hash_split(labelled, 0.8, h())
    assert 1500 < marked.where("part = 'train'").count() < 1700
    with pytest.raises(Exception):
        split.sample_fraction(labelled, 1.5).count()


def test_undersample(labelled):
    positives = labelled.where("Class = 1").count()
    kept = balance.undersample(labelled, h())
    assert kept.where("Class = 1").count() == positives
    assert abs(kept.where("Class = 0").count() - positives) < 4 * math.sqrt(positives)
    assert ids(kept) == ids(balance.undersample(labelled.repartition(9, "b"), h()))
    for by_rand in (True, False):
        assert balance.undersample_random(labelled, by_rand=by_rand).where("Class = 1").count() == positives


def test_more_positives_than_negatives_keeps_all(spark):
    df = spark.createDataFrame([(i, int(i > 2)) for i in range(9)], "id bigint, Class int")
    assert balance.undersample(df, h()).count() == 9


@pytest.mark.parametrize("only", [0, 1])
def test_one_class_is_an_error(labelled, only):
    df = labelled.where(col("Class") == only)
    with pytest.raises(ValueError, match="both classes"):
        balance.undersample(df, h())
    with pytest.raises(ValueError, match="both classes"):
        balance.with_class_weights(df)


def test_class_weights_have_equal_totals(labelled):
    weighted, counts = balance.with_class_weights(labelled)
    totals = {r["Class"]: r["w"] for r in weighted.groupBy("Class").agg(F.sum("classWeightCol").alias("w")).collect()}
    assert totals[0] == pytest.approx(totals[1]) and sum(counts.values()) == 2000
    assert {r["classWeightCol"] for r in balance.with_unit_weight(labelled).collect()} == {1.0}


def test_union_matches_by_name(spark):
    both = balance.union_all(spark.sql("select 1 as a, 2 as b"), spark.sql("select 2 as b, 1 as a"))
    assert [tuple(r) for r in both.collect()] == [(1, 2), (1, 2)]


def test_missing_values_beside_fences(spark):
    df = spark.createDataFrame([(1, None), (1, 5.0), (0, None), (1, float("nan")), (1, 0.0)], "Class int, v double")
    kept = balance.drop_outside(df, [("v", -1.0, 1.0)])
    assert sorted((tuple(r) for r in kept.collect())) == [(0, None), (1, 0.0)]


@pytest.mark.parametrize("exact", [True, False])
def test_fences_follow_the_column_order(spark, labelled, exact):
    pdf = labelled.toPandas()
    expected, left = [], pdf
    for c in ("b", "a"):
        x = left[left.Class == 1][c].sort_values().to_numpy()
        q1, q3 = (x[math.ceil(p * len(x)) - 1] for p in (0.25, 0.75))
        lower, upper = q1 - 1.5 * (q3 - q1), q3 + 1.5 * (q3 - q1)
        gone = (left.Class == 1) & ((left[c] < lower) | (left[c] > upper))
        expected.append((c, lower, upper, int(gone.sum()), 0))
        left = left[~gone]
    kept, fences = balance.drop_positive_outliers(labelled, ["b", "a"], exact=exact)
    assert [tuple(r) for r in fences.collect()] == expected
    assert ids(kept) == sorted(left.id) and sum(e[3] for e in expected) > 0


def test_fences_need_a_value(spark):
    df = spark.createDataFrame([(1, None), (0, 1.0)], "Class int, v double")
    with pytest.raises(ValueError):
        balance.drop_positive_outliers(df, ["v"])
