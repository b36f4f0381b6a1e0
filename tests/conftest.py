import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[*]")
        .appName("rareflow-tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def labelled(spark):
    """2,000 rows in three features; positives are rare and lie in one corner."""
    import numpy as np

    rng = np.random.default_rng(7)
    a, b, c = rng.normal(size=2000), rng.exponential(size=2000), rng.integers(0, 6, size=2000)
    label = ((a > 1.2) & (b > 0.7) & (rng.random(2000) < 0.9)).astype(int)
    rows = [(i, float(x), float(y), float(z), int(k)) for i, (x, y, z, k) in enumerate(zip(a, b, c, label))]
    return spark.createDataFrame(rows, "id bigint, a double, b double, c double, Class int").repartition(4).cache()
