"""The recommender as a job to submit.

spark-submit --py-files basketrank.zip basketrank/job.py DATA OUT [--no-training ...]
spark-submit --py-files basketrank.zip basketrank/job.py DATA OUT --sample CUSTOMERS SUBMISSION
"""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession

from basketrank.config import REFERENCE
from basketrank.operators.lookup import only_customers
from basketrank.plans import pipeline
from basketrank.session import tune
from basketrank.sources import Inputs, load_inputs, read_submission, write_csv

PARTS = ("candidates", "training", "prediction", "evaluation")


def export_sample(inputs: Inputs, submission: DataFrame, customers: DataFrame, out_dir: str) -> None:
    """Write the purchases and the submitted lists of chosen customers as CSV, for a demonstration."""
    write_csv(only_customers(inputs.transactions, customers), f"{out_dir}/sample_transactions")
    write_csv(only_customers(submission, customers), f"{out_dir}/sample_submission")


def parse(arguments: list[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(description=__doc__, formatter_class=argparse.RawDescriptionHelpFormatter)
    parser.add_argument("data", help="folder of transactions_train.csv, articles.csv and customers.csv")
    parser.add_argument("out", help="folder for the results")
    for part in PARTS:
        parser.add_argument(f"--no-{part}", dest=part, action="store_false", help=f"skip the {part}")
    parser.add_argument("--mode", choices=("reference", "fixed"), default="reference")
    parser.add_argument("--resume", action="store_true", help="keep tables made with the same settings from the same rows")
    parser.add_argument("--sample", nargs=2, metavar=("CUSTOMERS", "SUBMISSION"), help="only export these customers (CSV with customer_id)")
    return parser.parse_args(arguments)


def main(arguments: list[str] | None = None) -> None:
    chosen = parse(arguments)
    spark = tune(SparkSession.builder.getOrCreate())
    inputs = load_inputs(spark, chosen.data, REFERENCE)
    if chosen.sample:
        customers = spark.read.option("header", True).csv(chosen.sample[0]).select("customer_id")
        export_sample(inputs, read_submission(spark, chosen.sample[1]), customers, chosen.out)
        return
    parts = {part: getattr(chosen, part) for part in PARTS}
    pipeline.run(inputs, chosen.out, pipeline.Options(mode=chosen.mode, resume=chosen.resume, **parts))


if __name__ == "__main__":
    main()
