"""Command line: ``spark-submit <python -m> rowgate INPUT OUTPUT CONTRACT [START [END]]``.

Uses the session ``spark-submit`` (or the environment) configures - no master
is set here - runs :func:`rowgate.plans.job.run` and prints the counts as
JSON.  Exit status 1 when there is nothing to validate.
"""

from __future__ import annotations

import argparse
import json
import sys


def main(argv: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="rowgate", description="Validate delimited files against a contract.")
    parser.add_argument("input", help="file, directory or glob of delimited text")
    parser.add_argument("output", help="output directory (shared storage)")
    parser.add_argument("contract", help="contract file (.yaml / .yml / .json)")
    parser.add_argument("start", nargs="?", default=None, help="first file date, yyyy-MM-dd (optional)")
    parser.add_argument("end", nargs="?", default=None, help="last file date, yyyy-MM-dd (optional)")
    parser.add_argument("--as-of", default=None, help="date business rules see as as_of (default today)")
    parser.add_argument("--overwrite", choices=("static", "dynamic"), default=None)
    parser.add_argument("--single-report-file", action="store_true")
    args = parser.parse_args(argv)

    from pyspark.sql import SparkSession

    from .plans.job import EmptyInput, run

    spark = SparkSession.builder.appName("rowgate").getOrCreate()
    try:
        res = run(spark, args.input, args.output, args.contract, start=args.start or None, end=args.end or None,
                  as_of=args.as_of, overwrite=args.overwrite, single_report_file=args.single_report_file)
    except EmptyInput as exc:
        print(json.dumps({"error": str(exc)}), file=sys.stderr)
        return 1
    print(json.dumps({"output": res.output_dir, **res.counts,
                      "timings": {k: round(v, 3) for k, v in res.timings.items()}}))
    return 0


if __name__ == "__main__":
    sys.exit(main())
