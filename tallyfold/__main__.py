"""``python -m tallyfold PATH... -o OUT``: run over files and folders."""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import SparkSession

from tallyfold.plans.run import MODES, run


def main() -> int:
    parser = argparse.ArgumentParser(prog="tallyfold")
    parser.add_argument("paths", nargs="+")
    parser.add_argument("-o", "--output", default="report")
    parser.add_argument("-m", "--mode", default="parallel", choices=MODES)
    parser.add_argument("--history", help="folder of the run history")
    args = parser.parse_args()
    spark = SparkSession.builder.appName("tallyfold").getOrCreate()
    result = run(spark, args.paths, args.output, args.mode, args.history)
    if result.ok:
        print(f"OK: {result.out_dir}")
        return 0
    print(f"ERROR: {len(result.errors)} issue(s)")
    for error in result.errors:
        print(f"- {error['path']}: {error['reason']} - {error['details']}")
    return 1


if __name__ == "__main__":
    sys.exit(main())
