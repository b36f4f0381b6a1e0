"""Command line: ``python -m rareflow {prepare,train,score,run}``."""

from __future__ import annotations

import argparse

from rareflow.plans.full_run import full_run
from rareflow.plans.prepare import SPLITS, prepare
from rareflow.plans.score import score
from rareflow.plans.train import train
from rareflow.schema import card_schema
from rareflow.session import get_session


def _schema(text: str):
    return {"infer": None, "card": card_schema()}.get(text, text)


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="rareflow")
    jobs = top.add_subparsers(dest="job", required=True)

    def add_prepare_options(p):
        p.add_argument("--input", default="dataset/raw/creditcard.csv")
        p.add_argument("--output", default="dataset/processed")
        p.add_argument("--train-ratio", type=float, default=0.8)
        p.add_argument("--seed", type=int, default=42)
        p.add_argument("--schema", default="infer", help="'infer', 'card' or a DDL string; inferring reads the text twice")
        p.add_argument("--split", choices=SPLITS, default="stratified")
        p.add_argument("--key", nargs="*", help="columns that tell rows apart; all columns where not given")
        p.add_argument("--input-format", choices=("csv", "parquet"), default="csv")

    add_prepare_options(jobs.add_parser("prepare"))

    p = jobs.add_parser("train")
    p.add_argument("--train", default="dataset/processed/train")
    p.add_argument("--test", default="dataset/processed/test")
    p.add_argument("--model-dir", default="models/lr_pipeline")
    p.add_argument("--metrics", default="models/metrics.json")
    p.add_argument("--model-type", choices=("lr", "rf", "gbt"), default="lr")

    p = jobs.add_parser("score")
    p.add_argument("--model-dir", default="models/lr_pipeline")
    p.add_argument("--input", default="dataset/processed/test")
    p.add_argument("--output", default="dataset/processed/scores")
    p.add_argument("--threshold", type=float, default=0.5)
    p.add_argument("--keep-vectors", action="store_true")

    p = jobs.add_parser("run")
    add_prepare_options(p)
    p.add_argument("--models", default="models")
    p.add_argument("--threshold", type=float, default=0.5)
    return top


def main(argv: list[str] | None = None, spark=None) -> None:
    a = parser().parse_args(argv)
    spark = spark or get_session(f"rareflow-{a.job}")
    if a.job == "train":
        train(spark, a.train, a.test, a.model_dir, a.metrics, a.model_type).show(truncate=False)
    elif a.job == "score":
        metrics = score(spark, a.model_dir, a.input, a.output, a.threshold, a.keep_vectors)
        if metrics is not None:
            metrics.show(truncate=False)
    else:
        options = {
            "train_ratio": a.train_ratio,
            "seed": a.seed,
            "schema": _schema(a.schema),
            "split": a.split,
            "key": a.key,
            "source_format": a.input_format,
        }
        if a.job == "prepare":
            prepare(spark, a.input, a.output, **options).show()
        else:
            for table in full_run(spark, a.input, a.output, a.models, a.threshold, **options).values():
                if table is not None:
                    table.show(truncate=False)


if __name__ == "__main__":
    main()
