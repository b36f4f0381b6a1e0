"""What jobs leave on disk, and how often the study's profile reads its table."""

from pathlib import Path

import pytest
from pyspark.sql import functions as F

from rareflow.functions.columns import log_positive
from rareflow.operators import density, profile
from rareflow.plans.prepare import prepare
from rareflow.plans.study import profile as study_profile
from rareflow.plans.study import run_study
from rareflow.plans.train import train
from rareflow.session import checkpoint_dir, cut_lineage, job_stages, staged


@pytest.fixture
def left(spark):
    """Files and folders that stand in the shared folder now and did not before; folders of checkpoints hold none."""
    folder = Path(checkpoint_dir(spark).removeprefix("file:"))
    before = set(folder.rglob("*"))
    return lambda: {p for p in folder.rglob("*") if p not in before}


def databases(spark):
    return {d.name for d in spark.catalog.listDatabases()}


def test_stages_go_with_their_job(spark, left):
    known = databases(spark)
    with job_stages(spark):
        with job_stages(spark):
            rows = staged(spark.range(30).selectExpr("id", "id % 3 as `a-b`"), "some-label", by=["a-b"])
        counted = cut_lineage(rows.groupBy("a-b").count())
        assert rows.where("`a-b` = 1").count() == 10 and counted.count() == 3 and left()
    assert not left() and databases(spark) == known
    with pytest.raises(ZeroDivisionError), job_stages(spark):
        staged(spark.range(3))
        1 / 0
    assert not left() and databases(spark) == known
    assert staged(spark.range(3)).count() == 3 and left()  # without a job it stays


def test_finished_jobs_leave_their_outputs_only(spark, labelled, left, tmp_path):
    labelled.drop("id").write.parquet(f"{tmp_path}/raw")
    prepare(spark, f"{tmp_path}/raw", f"{tmp_path}/out", source_format="parquet")
    assert {p.name for p in (tmp_path / "out").iterdir()} == {"raw_parquet", "train", "test"} and not left()
    out = f"{tmp_path}/out"
    metrics = train(spark, f"{out}/train", f"{out}/test", f"{out}/model", f"{out}/metrics", "gbt", grid={"maxIter": [1, 2]})
    assert metrics.first()["auroc"] > 0.5 and not left()


def test_study_written_whole(spark, labelled, left, tmp_path):
    rows = labelled.drop("id")
    options = {"trim": ("b",), "boxplots": ("a", "b"), "amounts": ("b", "a"), "lr_grid": {"regParam": [0.01]}}
    settings = {"rf": {"numTrees": 3}, "gbt": {"maxIter": 2}}
    found = run_study(rows, f"{tmp_path}/models", f"{tmp_path}/tables", settings=settings, **options)
    assert not left()
    assert {p.name for p in (tmp_path / "tables").iterdir()} == set(found.tables)
    assert all(t.count() > 0 for t in found.tables.values())
    assert found.tables["histogram"].count() == 100 and found.tables["log_histogram"].count() == 50


def close(found, wanted, keys):
    assert found.columns == wanted.columns
    a, b = (sorted(([*r] for r in df.collect()), key=lambda r: [r[df.columns.index(k)] for k in keys]) for df in (found, wanted))
    assert len(a) == len(b)
    for x, y in zip(a, b):
        assert [v for v in x if isinstance(v, (str, int))] == [v for v in y if isinstance(v, (str, int))]
        assert [v for v in x if isinstance(v, float)] == pytest.approx([v for v in y if isinstance(v, float)], rel=1e-9, abs=1e-12)


def test_profile_like_the_single_operators(labelled):
    rows = labelled.withColumn("a", F.when(F.col("id") % 7 > 0, F.col("a")))  # some values are missing
    found = study_profile(rows, ("b", "a"))
    logs = rows.select(log_positive(F.col("b")).alias("log_amount"))
    close(found["class_counts"], profile.class_counts(rows), ["Class"])
    close(found["summary"], profile.describe_columns(rows), ["column"])
    close(found["corr_before"], profile.correlation_rows(rows), ["a", "b"])
    close(found["histogram"], density.histogram(rows, ["b", "a"]), ["column", "bin"])
    close(found["log_histogram"], density.histogram(logs, ["log_amount"]), ["bin"])
    close(found["density_a"], density.kernel_density(rows, "a"), ["i"])
    close(found["density_b"], density.kernel_density(rows, "b"), ["i"])
    close(found["log_density"], density.kernel_density(logs, "log_amount"), ["i"])


def test_profile_reads_the_table_three_times(spark, labelled, tmp_path):
    labelled.drop("id").write.parquet(f"{tmp_path}/rows")
    read = {c: spark.sparkContext.accumulator(0) for c in ("b", "Class")}

    def seen(name, kind):
        def count(x):
            read[name].add(1)
            return x

        return F.udf(count, kind).asNondeterministic()(name).alias(name)

    rows = spark.read.parquet(f"{tmp_path}/rows").select("a", "c", seen("b", "double"), seen("Class", "int"))
    for table in study_profile(rows, ("b", "a")).values():
        table.collect()
    # a nondeterministic column is computed in each scan
    assert read["b"].value <= 3 * 2_000 and read["Class"].value <= 3 * 2_000


def test_distributions_need_two_values(spark):
    with pytest.raises(ValueError):
        density.distributions(spark.sql("select 1D as v"), {"v": (1, float("nan"), 1.0, 1.0)})
