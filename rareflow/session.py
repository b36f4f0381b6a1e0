"""Session, checkpoint folder and scratch paths."""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from contextvars import ContextVar

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema


def get_session(app_name: str) -> SparkSession:
    """The session for a command-line job; master and tuning come from the cluster's own settings."""
    return SparkSession.builder.appName(app_name).getOrCreate()


def watching_session(spark: SparkSession) -> SparkSession:
    """A session with the same settings, for jobs that observe figures while they write.

    A fitted logistic regression holds on to its session and is sent to the executors with it, which
    fails for a session that has observed anything. So observations stay out of the session of the models.
    """
    sibling = spark.newSession()
    for key, value in spark.conf.getAll.items():
        if spark.conf.isModifiable(key):
            sibling.conf.set(key, value)
    return sibling


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared folder of ``spark.checkpoint.dir``; one of the application only where it is unset in local mode."""
    sc = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if folder is None:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that every executor can reach")
        folder = f"/tmp/rareflow-{sc.applicationId}"  # on Spark's default file system
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(folder)
    return folder


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path in the shared folder for tables and models that outlive one job."""
    return f"{checkpoint_dir(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"


_job: ContextVar[str | None] = ContextVar("rareflow_job", default=None)


def stage_path(spark: SparkSession, label: str) -> str:
    """A fresh path for files of a stage, which go with the job's folder if there is a job."""
    job = _job.get()
    return scratch_path(spark, label if job is None else f"{job}/{label}")


@contextmanager
def job_stages(spark: SparkSession) -> Iterator[None]:
    """All that is staged inside belongs to one job and is removed at its end, however that ends.

    The stages are managed tables of a database of the job, which lies in the shared folder; dropping it has Spark remove the files, on
    any file system. A job inside another leaves its stages to the outer one. Nothing that still reads a stage may leave the job.
    """
    if _job.get() is not None:
        yield
        return
    name = f"rareflow_{uuid.uuid4().hex}"
    folder = f"{checkpoint_dir(spark).rstrip('/')}/{name}".replace("\\", "\\\\").replace("'", "\\'")
    spark.sql(f"create database {name} location '{folder}'")
    token = _job.set(name)
    try:
        yield
    finally:
        _job.reset(token)
        spark.sql(f"drop database if exists {name} cascade")


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write the rows to the shared folder once, so later passes neither recompute nor lose them; in a job as one of its stages."""
    if _job.get() is not None:
        return staged(df, "cut")
    checkpoint_dir(df.sparkSession)
    return df.checkpoint()


def staged(df: DataFrame, label: str = "stage", by: Sequence[str] = ()) -> DataFrame:
    """The rows as a Parquet table in the shared folder, in folders ``by`` columns: for tables that several passes read a few columns of.

    Inside ``job_stages`` the table goes with the job; otherwise its files stay.
    """
    spark, job = df.sparkSession, _job.get()
    writer = df.write.partitionBy(*by) if by else df.write
    if job is not None:
        name = re.sub(r"\W", "_", f"{label}_{uuid.uuid4().hex}")
        name = f"{job}.{name}"
        writer.saveAsTable(name, format="parquet")
        return spark.table(name)
    path = scratch_path(spark, label)
    writer.parquet(path)
    return spark.read.parquet(path)


def small_table(spark: SparkSession, rows: Sequence[tuple], ddl: str) -> DataFrame:
    """Driver rows, such as fences or bin ranges, as a local relation: no job runs and its size is known."""
    schema = to_arrow_schema(T.StructType.fromDDL(ddl))
    columns = list(zip(*rows)) or [()] * len(schema)
    return spark.createDataFrame(pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema))
