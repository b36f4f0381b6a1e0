"""CSV and Parquet scans, Parquet and JSON sinks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, types as T
from pyspark.sql import functions as F


def scan_csv(spark: SparkSession, path: str, schema: T.StructType | str | None = None) -> DataFrame:
    """Headed CSV. Without a schema the types are inferred, which costs one more pass over the text.

    With a schema the header is checked against it, so a reordered file fails instead of being misread.
    """
    if schema is None:
        return spark.read.csv(path, header=True, inferSchema=True)
    return spark.read.csv(path, header=True, schema=schema, enforceSchema=False)


def scan_parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def spread(df: DataFrame) -> DataFrame:
    """Deal the rows of an input with fewer splits than cores out to all cores.

    A small file is one split, so one core would do all the work on it. Large tables have far more
    splits than the cluster has cores and pass unchanged, without a shuffle. Rows go by the hash of
    their columns, so a retried task deals them out the same way.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores, *df.columns) if df.rdd.getNumPartitions() < cores else df


def sink_csv(df: DataFrame, path: str) -> None:
    df.write.csv(path, mode="overwrite", header=True)


def sink_parquet(df: DataFrame, path: str, cluster_by: str | None = None) -> None:
    """Overwrite ``path``.

    ``cluster_by`` sorts each output file by that column (no shuffle). Clustered by the label, the
    few pages with positives sit together and a pushed-down ``label = 1`` skips all the others.
    """
    if cluster_by is not None:
        df = df.sortWithinPartitions(cluster_by)
    df.write.parquet(path, mode="overwrite")


def land_once(df: DataFrame, path: str) -> None:
    """Write ``path`` unless it already exists."""
    df.write.parquet(path, mode="ignore")


def sink_metrics(metrics: DataFrame, path: str) -> None:
    """Metric rows as JSON lines in one file; only for bounded frames."""
    metrics.coalesce(1).write.json(path, mode="overwrite")


def label_counts_struct(counts: dict, name: str = "train_counts") -> Column:
    """Class counts as one struct column whose fields are the class values."""
    return F.struct(*[F.lit(n).cast("bigint").alias(str(c)) for c, n in sorted(counts.items(), key=lambda x: (x[0] is None, x[0]))]).alias(name)
