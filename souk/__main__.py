"""Jobs: load the raw CSV files, build the models, run the checks, show a model.

    spark-submit ... -m souk load  --store URI --csv URI
    spark-submit ... -m souk build --store URI [--select MODEL ...] [--commission 0.18]
    spark-submit ... -m souk test  --store URI
    spark-submit ... -m souk show  --store URI MODEL
    spark-submit ... -m souk sql   --store URI "select ... from MODEL ..."
"""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import SparkSession

from souk.functions import labels
from souk.plans import quality_suite
from souk.plans.warehouse import MODELS, Warehouse
from souk.session import configure, fit_to_input
from souk.sources.csv_ingest import CsvTables, LoadedTables
from souk.sources.store import TableStore


def arguments(argv: list[str]) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="souk")
    jobs = parser.add_subparsers(dest="job", required=True)

    def job(name: str) -> argparse.ArgumentParser:
        sub = jobs.add_parser(name)
        sub.add_argument("--store", required=True, help="folder of the written tables")
        return sub

    job("load").add_argument("--csv", required=True, help="folder of <table>.csv files")
    build = job("build")
    build.add_argument("--select", nargs="+", choices=list(MODELS), metavar="MODEL")
    build.add_argument("--commission", type=float, default=labels.COMMISSION)
    build.add_argument("--payment-fee", type=float, default=labels.PAYMENT_FEE)
    job("test")
    job("show").add_argument("model", choices=list(MODELS))
    job("sql").add_argument("statement", help="a query over the models of the last build")
    return parser.parse_args(argv)


def main(argv: list[str], spark: SparkSession) -> int:
    """Exit code of the job: 1 when a check failed."""
    args = arguments(argv)
    configure(spark)
    store = TableStore(spark, args.store)
    fit_to_input(spark, args.csv if args.job == "load" else args.store)
    if args.job == "load":
        CsvTables(spark, args.csv, store).stats().show(truncate=False)
        return 0
    raw = LoadedTables(store)
    if args.job == "build":
        Warehouse(spark, raw, store, args.commission, args.payment_fee).build(args.select)
        return 0
    built = Warehouse.opened(spark, raw, store)
    if args.job == "sql":
        built.publish(built.defined())
        spark.sql(args.statement).show(truncate=False)
        return 0
    if args.job == "show":
        built[args.model].show(truncate=False)
        return 0
    failing = quality_suite.suite_report(built).where("failures > 0").collect()
    for row in failing:
        print(f"{row['check']} {row['model']} {row['columns']}: {row['failures']}")
    return int(bool(failing))


if __name__ == "__main__":
    session = SparkSession.builder.appName("souk").getOrCreate()
    try:
        code = main(sys.argv[1:], session)
    finally:
        session.stop()
    sys.exit(code)
