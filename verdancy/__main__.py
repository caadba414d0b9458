"""Command line: list the registered queries, run one over a table folder, or answer decision requests from a file.

    python -m verdancy list
    spark-submit -m verdancy run QUERY SF_DIR OUT
    spark-submit -m verdancy predict REQUESTS OUT [--calibration FILE]

OUT becomes a folder of Parquet (run) or JSON lines (predict).
"""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from .operators import decide
from .plans import catalogue
from .sources import records


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="verdancy", description=__doc__, formatter_class=argparse.RawDescriptionHelpFormatter)
    commands = p.add_subparsers(dest="command", required=True)
    commands.add_parser("list", help="names of the registered queries")
    run = commands.add_parser("run", help="run a registered query")
    run.add_argument("query")
    run.add_argument("sf_dir")
    run.add_argument("out")
    predict = commands.add_parser("predict", help="answer requests: JSON lines of one field each, with its logits")
    predict.add_argument("requests")
    predict.add_argument("out")
    predict.add_argument("--calibration", default="", help="JSON of temperatures and thresholds; none: uncalibrated")
    return p


def main(argv: list[str] | None = None) -> int:
    args = parser().parse_args(argv)
    if args.command == "list":
        print("\n".join(sorted(catalogue.queries())))
        return 0
    spark = SparkSession.builder.getOrCreate()
    if args.command == "run":
        found = catalogue.queries()
        if args.query not in found:
            print(f"unknown query {args.query}")
            return 2
        found[args.query](spark, args.sf_dir).write.mode("overwrite").parquet(args.out)
        return 0
    temperatures, thresholds = records.calibration(spark, args.calibration)
    requests = records.read_lines(spark, args.requests, decide.REQUEST)
    decide.responses(decide.predicted(requests, temperatures, thresholds)).write.mode("overwrite").json(args.out)
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
