"""Command line: python -m netvigil <job> --out FOLDER [options]"""

from __future__ import annotations

import argparse
import uuid

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession

from netvigil.ml import inference
from netvigil.plans import jobs
from netvigil.session import build_session
from netvigil.sinks.tables import append_predictions
from netvigil.sources.flows import read_flows, write_raw_flows
from netvigil.sources.synthetic import generate_range


def predict(spark: SparkSession, out: str, limit: int, store: bool, name: str | None = None) -> DataFrame:
    model = PipelineModel.load(f"{out}/threat_model")
    sample = inference.predict(read_flows(spark, f"{out}/{jobs.CLEAN}"), model, limit)
    if store:
        append_predictions(sample, f"{out}/serving/prediction_log", name or uuid.uuid4().hex)
    return sample


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="netvigil", description="Network-flow threat analytics on Spark.")
    commands = top.add_subparsers(dest="job", required=True)

    def command(name: str, text: str) -> argparse.ArgumentParser:
        added = commands.add_parser(name, help=text)
        added.add_argument("--out", required=True, help="output folder")
        return added

    for name, text in (("etl", "clean raw CSV logs and build feature vectors"), ("all", "run every job in order")):
        command(name, text).add_argument("--raw", required=True, help="raw CSV file or folder")
    command("analytics", "write all reports").add_argument("--serving", action="store_true", help="also refresh serving tables")
    command("train", "train and evaluate both classifiers")
    command("evaluate", "evaluate the saved model")
    command("publish", "refresh serving tables and JSON mirrors").add_argument("--force", action="store_true")
    command("lookup", "profile of one address").add_argument("--ip", required=True)
    scoring = command("predict", "score the first flows")
    scoring.add_argument("--limit", type=int, default=5)
    scoring.add_argument("--store", action="store_true", help="append to the prediction log")
    scoring.add_argument("--run", help="name of the run in the log; the same name replaces its records")
    generate = command("generate", "write synthetic raw logs as CSV")
    generate.add_argument("--rows", type=int, default=100_000)
    generate.add_argument("--seed", type=int, default=42)
    return top


def run(spark: SparkSession, args: argparse.Namespace) -> DataFrame | None:
    """Run one job; returns the table to show."""
    out = args.out
    if args.job == "generate":
        write_raw_flows(generate_range(spark, args.rows, args.seed), out)
        return None
    if args.job == "evaluate":
        matrix, report = jobs.run_evaluation(spark, out)
        matrix.groupBy("actual").pivot("predicted").sum("n").show(truncate=False)
        return report
    return {
        "etl": lambda: jobs.run_etl(spark, args.raw, out),
        "all": lambda: jobs.run_all(spark, args.raw, out),
        "analytics": lambda: jobs.run_analytics(spark, read_flows(spark, f"{out}/{jobs.CLEAN}"), out, args.serving),
        "train": lambda: jobs.run_training(spark, out).metrics,
        "publish": lambda: jobs.publish(spark, out, args.force),
        "lookup": lambda: jobs.lookup(spark, out, args.ip),
        "predict": lambda: predict(spark, out, args.limit, args.store, args.run),
    }[args.job]()


def main() -> None:
    args = parser().parse_args()
    spark = build_session(f"netvigil-{args.job}")
    spark.sparkContext.setLogLevel("ERROR")
    shown = run(spark, args)
    if shown is not None:
        if args.job == "lookup" and shown.isEmpty():
            print(f"{args.ip} was not observed")
        else:
            shown.show(50, truncate=False)
    spark.stop()


if __name__ == "__main__":
    main()
