import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from rareflow.operators import density, profile


def test_distinct_rows_of_special_values(spark):
    df = spark.sql("select explode(array(double('NaN'), double('NaN'), 0D, -0D, null, null)) as v")
    assert profile.distinct_rows(df).count() == 3


def test_class_counts(spark, labelled):
    rows = {r["Class"]: r for r in profile.class_counts(labelled).collect()}
    assert rows[0]["n"] + rows[1]["n"] == rows[0]["total"] == 2000
    assert profile.row_count(labelled).first()["n"] == 2000


def test_describe(labelled):
    pdf = labelled.toPandas()
    for r in profile.describe_columns(labelled, ["a", "b", "Class"]).collect():
        x = pdf[r["column"]]
        assert (r["n"], r["min"], r["max"]) == (2000, x.min(), x.max())
        assert r["mean"] == pytest.approx(x.mean()) and r["stddev"] == pytest.approx(x.std())
    assert profile.describe_text(labelled).count() == 5


@pytest.mark.parametrize("holes", [False, True])
def test_correlation_like_pandas(labelled, holes):
    df = labelled.drop("id").withColumn("constant", F.lit(2.0))
    if holes:
        df = df.withColumn("a", F.when(F.col("c") != 3, F.col("a"))).withColumn(
            "b", F.when(F.col("c") == 1, float("nan")).otherwise(F.col("b"))
        )
    expected = df.toPandas().corr()
    found = {(r["a"], r["b"]): r["r"] for r in profile.correlation_rows(df).collect()}
    assert len(found) == 25
    for (a, b), r in found.items():
        if math.isnan(expected.loc[a, b]):
            assert r is None or a == b
        else:
            assert r == pytest.approx(expected.loc[a, b], abs=1e-9)


def test_label_correlations_leave_out_the_label_and_constants(spark, labelled):
    matrix = profile.correlation_rows(labelled.drop("id").withColumn("constant", F.lit(1.0)))
    top = profile.label_correlations(matrix, k=2).collect()
    assert [r["column"] for r in top if r["side"] == "positive"][0] in ("a", "b")
    assert {r["column"] for r in top} <= {"a", "b", "c"} and len(top) == 4
    scale = profile.colour_range(matrix, matrix).first()
    assert scale["vmax"] == pytest.approx(1.0) and scale["vmin"] < 0.1


def test_boxplot(spark, labelled):
    pdf = labelled.toPandas()
    flyers = profile.boxplot_outliers(labelled, ["a", "b"]).groupBy("Class", "column").count().collect()
    flyers = {(r["Class"], r["column"]): r["count"] for r in flyers}
    for r in profile.boxplot_rows(labelled, ["a", "b"]).collect():
        x = pdf[pdf.Class == r["Class"]][r["column"]]
        q1, median, q3 = np.percentile(x, [25, 50, 75])
        ok = x[(x >= q1 - 1.5 * (q3 - q1)) & (x <= q3 + 1.5 * (q3 - q1))]
        assert (r["q1"], r["median"], r["q3"]) == pytest.approx((q1, median, q3))
        assert (r["whisker_low"], r["whisker_high"], r["n"]) == pytest.approx((ok.min(), ok.max(), len(x)))
        assert r["outliers"] == len(x) - len(ok) == flyers.get((r["Class"], r["column"]), 0)


def test_histogram_like_numpy(labelled):
    pdf = labelled.toPandas()
    for r in {"a", "b"}:
        counts, edges = np.histogram(pdf[r], bins=50)
        densities, _ = np.histogram(pdf[r], bins=50, density=True)
        rows = density.histogram(labelled, [r]).orderBy("bin").collect()
        assert [x["n"] for x in rows] == counts.tolist()
        assert [x["lo"] for x in rows] == pytest.approx(edges[:-1].tolist())
        assert [x["density"] for x in rows] == pytest.approx(densities.tolist())


def test_histogram_groups_constants_and_missing(spark):
    df = spark.createDataFrame([(0, 1.0), (0, 2.0), (0, None), (0, float("nan")), (1, 5.0), (1, 5.0)], "g int, v double")
    rows = density.histogram(df, ["v"], bins=4, by=["g"]).collect()
    assert len(rows) == 8
    assert sum(r["n"] for r in rows if r["g"] == 0) == 2 and sum(r["n"] for r in rows if r["g"] == 1) == 2
    one = [r for r in rows if r["g"] == 1 and r["n"]]
    assert one[0]["lo"] == pytest.approx(5.0) and one[0]["density"] == pytest.approx(4.0)
    with pytest.raises(ValueError):
        density.histogram(spark.sql("select double('Infinity') as v union all select 1D"), ["v"])


@pytest.mark.parametrize("scale", [1.0, 400.0])
def test_kernel_density_by_brute_force(spark, labelled, scale):
    # at the larger scale the column has two far clusters, so most grid points are out of reach of each value
    df = labelled.select((F.col("a") / scale + F.when(F.col("c") > 2, 100.0).otherwise(0.0)).alias("v"))
    x = df.toPandas()["v"].to_numpy()
    bandwidth = x.std(ddof=1) * len(x) ** -0.2
    grid = np.linspace(x.min(), x.max(), 200)
    expected = np.exp(-0.5 * ((grid[:, None] - x) / bandwidth) ** 2).sum(1) / (len(x) * bandwidth * np.sqrt(2 * np.pi))
    rows = density.kernel_density(df, "v").orderBy("i").collect()
    assert [r["x"] for r in rows] == pytest.approx(grid.tolist())
    assert [r["density"] for r in rows] == pytest.approx(expected.tolist(), rel=1e-9)
    assert rows[5]["expected"] == pytest.approx(expected[5] * len(x) * (x.max() - x.min()) / 50)


def test_kernel_density_beyond_reach(spark):
    df = spark.createDataFrame([(0.0,)] * 3000 + [(1e-4,)] * 3000 + [(1.0,)], "v double")
    rows = density.kernel_density(df, "v", points=20).orderBy("i").collect()
    assert len(rows) == 20 and rows[10]["density"] == 0.0 and rows[0]["density"] > 0 and rows[19]["density"] > 0
    with pytest.raises(ValueError):
        density.kernel_density(df.where("v = 0"), "v")
