import json
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from rareflow.functions.columns import cast_numbers, feature_columns, log_positive
from rareflow.operators.thresholds import prediction_metrics, with_prediction
from rareflow.schema import card_schema
from rareflow.session import checkpoint_dir, scratch_path, small_table, staged
from rareflow.sources import tables as io


def test_inferred_csv_types(spark, tmp_path):
    (tmp_path / "t.csv").write_text('"Time","V1","Amount","Class"\n0,-1.35,149.62,"0"\n1,1.19,2.69,"0"\n1e+05,1.1,0,"1"\n')
    df = io.scan_csv(spark, str(tmp_path / "t.csv"))
    assert dict(df.dtypes) == {"Time": "double", "V1": "double", "Amount": "double", "Class": "int"}
    assert df.where("Class = 1").first()["Time"] == 1e5


def test_typed_csv_checks_the_header(spark, tmp_path):
    (tmp_path / "t.csv").write_text("V1,Time\n1.5,2\n")
    assert io.scan_csv(spark, str(tmp_path / "t.csv"), "V1 double, Time double").first() == (1.5, 2.0)
    with pytest.raises(Exception):
        io.scan_csv(spark, str(tmp_path / "t.csv"), "Time double, V1 double").collect()


def test_card_schema():
    assert [f.name for f in card_schema()][:2] == ["Time", "V1"] and len(card_schema()) == 31


def test_parquet_overwrite_and_land_once(spark, tmp_path):
    path = str(tmp_path / "p")
    io.sink_parquet(spark.range(5), path)
    io.sink_parquet(spark.range(3), path, cluster_by="id")
    assert io.scan_parquet(spark, path).count() == 3
    io.land_once(spark.range(9), path)
    assert io.scan_parquet(spark, path).count() == 3


def test_metrics_are_json(spark, tmp_path):
    path = tmp_path / "m"
    io.sink_metrics(spark.range(1).select(F.lit(0.5).alias("auprc"), io.label_counts_struct({1: 3, 0: 9})), str(path))
    text = next(Path(path).glob("part-*.json")).read_text()
    assert json.loads(text) == {"auprc": 0.5, "train_counts": {"0": 9, "1": 3}}


def test_cast_numbers(spark):
    df = spark.sql(
        "select 1 as i, 2L as l, cast(3 as float) as f, 4D as d, cast(5 as smallint) as s, 6.5 as m, 'x' as t, 1 as Class, 7 as `a.b`"
    )
    kinds = dict(cast_numbers(df).dtypes)
    assert {k: kinds[k] for k in ("i", "l", "f", "d", "a.b")} == dict.fromkeys(("i", "l", "f", "d", "a.b"), "double")
    assert (kinds["s"], kinds["m"], kinds["t"], kinds["Class"]) == ("smallint", "decimal(2,1)", "string", "int")
    assert feature_columns(df) == ["i", "l", "f", "d", "s", "m", "t", "a.b"]


def test_log_of_zero_is_null(spark):
    df = spark.sql("select explode(array(0D, 1D, exp(1D), -2D)) as v").select(F.round(log_positive(F.col("v")), 12).alias("l"))
    assert [r["l"] for r in df.collect()] == [None, 0.0, 1.0, None]


def test_threshold_counts_equality(spark):
    df = spark.createDataFrame([(0.5, 1), (0.5, 0), (0.49, 1)], "score double, Class int").withColumn("prediction_thresh", F.lit(9))
    predicted = with_prediction(df, 0.5)
    assert sorted(r["prediction_thresh"] for r in predicted.collect()) == [0.0, 1.0, 1.0]
    cells = prediction_metrics(predicted).first()
    assert (cells["tp"], cells["fp"], cells["fn"], cells["tn"]) == (1, 1, 1, 0)
    assert cells["precision"] == pytest.approx(0.5) and cells["f1"] == pytest.approx(0.5)


def test_shared_folder(spark):
    folder = checkpoint_dir(spark)
    assert spark.sparkContext.getCheckpointDir() is not None
    assert scratch_path(spark, "x").startswith(folder.rstrip("/")) and scratch_path(spark, "x") != scratch_path(spark, "x")
    assert staged(spark.range(7)).count() == 7


def test_small_table_keeps_nulls_and_empty(spark):
    assert [tuple(r) for r in small_table(spark, [(1, None, "x"), (2, 2.5, None)], "a int, b double, c string").collect()] == [
        (1, None, "x"),
        (2, 2.5, None),
    ]
    assert small_table(spark, [], "a int").collect() == []


def test_spread_leaves_wide_inputs(spark):
    cores = spark.sparkContext.defaultParallelism
    wide = spark.range(1000, numPartitions=cores + 3)
    assert io.spread(wide) is wide
    assert io.spread(spark.range(1000, numPartitions=1)).rdd.getNumPartitions() == cores
