"""Jobs for spark-submit: experiment, external, recategorize."""

from __future__ import annotations

import argparse
from collections.abc import Sequence
from dataclasses import fields, is_dataclass, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trustgauge.operators.external import external_predictions
from trustgauge.operators.sampling import limit_rows
from trustgauge.plans import experiment
from trustgauge.sources.labelled import load_labelled_csv, load_labelled_parquet
from trustgauge.sources.sinks import write_by_family, write_results
from trustgauge.sources.workspace import settle, sweep


def _add_settings(parser: argparse.ArgumentParser, defaults: object, prefix: str = "") -> None:
    """An option for every field of a settings object, with the field's value as default."""
    for entry in fields(defaults):
        value = getattr(defaults, entry.name)
        flag = "--" + (prefix + entry.name).replace("_", "-")
        if is_dataclass(value):
            _add_settings(parser, value, f"{entry.name}_")
        elif isinstance(value, bool):
            parser.add_argument(flag, action=argparse.BooleanOptionalAction, default=value)
        elif isinstance(value, tuple):
            parser.add_argument(flag, nargs=len(value), type=type(value[0]), default=value)
        else:
            parser.add_argument(flag, type=type(value), default=value)


def _settings(args: argparse.Namespace, defaults: object, prefix: str = ""):
    """The settings object with the values of the options."""
    found = {}
    for entry in fields(defaults):
        value = getattr(defaults, entry.name)
        if is_dataclass(value):
            found[entry.name] = _settings(args, value, f"{entry.name}_")
        else:
            given = getattr(args, prefix + entry.name)
            found[entry.name] = tuple(given) if isinstance(value, tuple) else given
    return replace(defaults, **found)


def _parser() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="trustgauge")
    jobs = parser.add_subparsers(dest="job", required=True)
    main = jobs.add_parser("experiment", help="train, calibrate and evaluate all models")
    _add_settings(main, experiment.Settings())
    external = jobs.add_parser("external", help="evaluate logits of a model run elsewhere")
    external.add_argument("--logits", required=True, help="parquet with id and logits")
    external.add_argument("--model-name", required=True)
    external.add_argument("--seed", type=int, default=experiment.Settings.seed)
    for part in ("calibration", "test"):
        external.add_argument(f"--limit-{part}", type=int, default=0, help="0: all rows")
    for job in (main, external):
        job.add_argument("--labelled", required=True, help="CSV or parquet with text and target")
        job.add_argument("--output-dir", required=True)
        job.add_argument("--format", default="csv", choices=["csv", "parquet"])
    again = jobs.add_parser("recategorize", help="categorise saved errors again")
    again.add_argument("csv_path")
    again.add_argument("--output-dir", required=True)
    return parser


def _split_documents(spark: SparkSession, args: argparse.Namespace) -> DataFrame:
    load = load_labelled_csv if args.labelled.endswith(".csv") else load_labelled_parquet
    shares = {k: v for k, v in vars(args).items() if k in ("train_share", "calibration_share")}
    return experiment.split_labelled(load(spark, args.labelled), args.seed, **shares)


def _limited(docs: DataFrame, args: argparse.Namespace) -> DataFrame:
    parts = [
        limit_rows(docs.where(F.col("split") == name), limit, seed=args.seed)
        for name, limit in (
            ("calibration", args.limit_calibration), ("test", args.limit_test), ("train", 0),
        )
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def run(spark: SparkSession, argv: Sequence[str] | None = None) -> list[str]:
    """Run one job and return the paths of the tables it wrote."""
    args = _parser().parse_args(argv)
    if args.job == "recategorize":
        return experiment.recategorize_saved(spark, args.csv_path, args.output_dir)
    docs = _split_documents(spark, args)
    if args.job == "experiment":
        settings = _settings(args, experiment.Settings())
        tables = experiment.run_experiment(docs, settings)
    else:
        docs = _limited(docs, args)
        truth = settle(docs.where("split <> 'train'").select("id", "target", "split"))
        logits = spark.read.parquet(args.logits)
        predictions = external_predictions(truth, logits, args.model_name)
        tables = experiment.evaluate_external(predictions, docs)
    paths = write_results(tables, args.output_dir, args.format)
    if args.job == "experiment":
        paths.append(write_by_family(tables["metrics_summary"], args.output_dir, "metrics_by_family"))
    return paths


if __name__ == "__main__":
    session = SparkSession.builder.appName("trustgauge").getOrCreate()
    for path in run(session):
        print(path)
    sweep(session)
    session.stop()
