"""One query for each operator, over whole tables and with production parameters, and SQL where it can express them."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps
from pathlib import Path

import corpus_pipeline
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rareflow.llm import divergence, forest, idfiles, mixing, packing, runs, sharding, simhash, sketches, suffixes, toxicity, urls, vptrees
from rareflow.llm.common import table
from rareflow.session import scratch_path

# fixed values: the rules that pages are judged by
URL_RULES = (
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
)


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = toxicity.learn(docs, toxicity.not_held_out(table(spark, sf_dir, "labels")))
    scored = toxicity.with_scores(docs.select("doc_id", "text"), model)
    return scored.select(
        "doc_id",
        toxicity.held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= toxicity.THRESHOLD).cast("int").alias("predicted"),
    )


def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = mixing.mixed(table(spark, sf_dir, "documents"))
    return rows.select(
        "doc_id",
        "source",
        "lang",
        F.col("mix_topic").alias("topic"),
        F.col("mix_tokens").alias("tokens"),
        F.col("mix_probability").alias("probability"),
        F.col("mix_kept").alias("kept"),
    )


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.pack(table(spark, sf_dir, "documents"))
    digest = F.crc32("ids").alias("ids_crc32")
    return pieces.select("doc_id", "start", "length", digest, "doc_tokens", "sequence_id", "offset")


def op4_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = suffixes.remove_repeats(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


def op5_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judge(table(spark, sf_dir, "pages"), URL_RULES)


def op6_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sketches.edited_fingerprints(table(spark, sf_dir, "documents"))


def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.simhash_components(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("code"), 16, "0")).alias("fingerprint"), "component_id")


def op8_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shards(table(spark, sf_dir, "documents"))


def op9_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "ids")
    idfiles.write_ids(table(spark, sf_dir, "documents"), path)
    return idfiles.read_digests(spark, path)


def op10_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return forest.near_vectors(table(spark, sf_dir, "embeddings"))


def op11_nearest_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vptrees.nearest_vectors(table(spark, sf_dir, "embeddings"), every=50)


def op12_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.source_audit(table(spark, sf_dir, "documents"))


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = runs.with_runs(runs.periodic_texts(table(spark, sf_dir, "documents")), "found")
    best = F.col("found.strongest")
    line = lambda run: F.format_string("%d,%d,%d\n", run["start"], run["length"], run["period"])
    return found.select(
        "doc_id",
        F.size("found.runs").cast("long").alias("n_runs"),
        best["start"].alias("start"),
        best["length"].alias("length"),
        best["period"].alias("period"),
        F.call_function("div", best["length"] * 1000, best["period"]).alias("exponent_milli"),
        F.sha2(F.array_join(F.transform("found.runs", line), ""), 256).alias("runs_sha256"),
        F.sha2("found.collapsed", 256).alias("collapsed_sha256"),
    )


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus_pipeline.run(spark, sf_dir)


QUERIES = [
    op1_toxicity,
    op2_mixing,
    op3_packing,
    op4_suffix_dedup,
    op5_url_filters,
    op6_fingerprints,
    op7_simhash,
    op8_sharding,
    op9_token_files,
    op10_embedding_dedup,
    op11_nearest_vectors,
    op12_source_divergence,
    op13_periodic_runs,
    pipeline,
]


def _with_package(query: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    """The query with this repository on the Python workers' path, for sessions that were started elsewhere."""

    @wraps(query)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        environment = spark.sparkContext.environment
        root = str(Path(__file__).resolve().parents[2])
        if root not in environment.get("PYTHONPATH", "").split(":"):
            environment["PYTHONPATH"] = ":".join(p for p in (root, environment.get("PYTHONPATH", "")) if p)
        return query(spark, sf_dir)

    return run


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: _with_package(f) for f in QUERIES}
