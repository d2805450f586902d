"""Runs a registered query: spark-submit folioscope/cli.py QUERY TABLES OUTPUT. Exit 1 if a *_violations query finds any."""

from __future__ import annotations

import argparse
import sys

from folioscope.plans import registry
from folioscope.session import session


def main(given: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="folioscope")
    parser.add_argument("query", choices=sorted(registry.queries()))
    parser.add_argument("tables", help="folder of the Parquet tables")
    parser.add_argument("output", help="folder for the result; must not exist")
    args = parser.parse_args(given)
    spark = session()
    registry.queries()[args.query](spark, args.tables).write.mode("errorifexists").parquet(args.output)
    return int(args.query.endswith("_violations") and spark.read.parquet(args.output).count() > 0)


if __name__ == "__main__":
    sys.exit(main())
