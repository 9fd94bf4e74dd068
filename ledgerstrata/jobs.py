"""Command line for the batch steps.

    python -m ledgerstrata.jobs parse <documents> <lake>
    python -m ledgerstrata.jobs dimensions <lake> [--submissions <path>]
    python -m ledgerstrata.jobs facts <lake>
    python -m ledgerstrata.jobs checks <lake>
    python -m ledgerstrata.jobs gold <lake> [--years 2022 2023]

``<documents>`` is a zip archive, a folder of zip archives, or JSON files.
"""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession

from ledgerstrata.operators import quality
from ledgerstrata.operators.bronze import extract_submission_info
from ledgerstrata.plans import medallion
from ledgerstrata.sources import (
    parse_documents,
    parse_submissions,
    read_archive,
    read_documents,
    read_submissions,
    read_table,
)


def load_documents(spark: SparkSession, path: str, *, zipped: bool, multiline: bool) -> DataFrame:
    if zipped or path.endswith(".zip"):
        return parse_documents(read_archive(spark, path))
    return read_documents(spark, path, multiline=multiline)


def load_submissions(spark: SparkSession, path: str, *, zipped: bool, multiline: bool) -> DataFrame:
    if zipped or path.endswith(".zip"):
        return parse_submissions(read_archive(spark, path))
    return read_submissions(spark, path, multiline=multiline)


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="ledgerstrata")
    steps = top.add_subparsers(dest="step", required=True)
    for name in ("parse", "dimensions", "facts", "checks", "gold"):
        step = steps.add_parser(name)
        if name == "parse":
            step.add_argument("documents")
        step.add_argument("lake")
        if name in ("parse", "dimensions"):
            step.add_argument("--zipped", action="store_true", help="folder of zip archives")
            step.add_argument("--multiline", action="store_true", help="one document per file")
        if name == "dimensions":
            step.add_argument("--submissions")
        if name == "gold":
            step.add_argument("--years", nargs="*", type=int)
    return top


def run(spark: SparkSession, args: argparse.Namespace) -> None:
    if args.step == "parse":
        documents = load_documents(
            spark, args.documents, zipped=args.zipped, multiline=args.multiline
        )
        print(medallion.build_bronze(spark, documents, args.lake))
    elif args.step == "dimensions":
        info = None
        if args.submissions:
            info = extract_submission_info(
                load_submissions(
                    spark, args.submissions, zipped=args.zipped, multiline=args.multiline
                )
            )
        medallion.build_dimensions(spark, args.lake, submission_info=info)
    elif args.step == "facts":
        medallion.build_facts(spark, args.lake)
    elif args.step == "checks":
        suite = quality.warehouse_checks()
        tables = {name: read_table(spark, args.lake, name) for name in suite}
        for row in quality.require(quality.run_suite(tables, suite)):
            print(row)
    else:
        for report in medallion.build_gold(spark, args.lake, years=args.years):
            print(report.first())


def main(argv: list[str] | None = None) -> None:
    args = parser().parse_args(argv)
    spark = SparkSession.builder.appName(f"ledgerstrata-{args.step}").getOrCreate()
    try:
        run(spark, args)
    finally:
        spark.stop()


if __name__ == "__main__":
    main()
