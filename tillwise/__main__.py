"""spark-submit entry: python -m tillwise --data FOLDER --out FOLDER [--layer NAME ...] [--month YYYY-MM ...]"""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from .plans.layers import LAYERS, run_all
from .sources.files import load_all
from .sources.model import CommerceTables
from .sources.star import Commerce


def main() -> None:
    parser = argparse.ArgumentParser(prog="tillwise")
    parser.add_argument("--data", required=True, help="folder of the input tables")
    parser.add_argument("--out", required=True, help="folder for the results")
    parser.add_argument("--format", choices=["csv", "star"], default="csv")
    parser.add_argument("--layer", action="append", choices=list(LAYERS))
    parser.add_argument("--month", action="append", help="yyyy-mm: the ingest layer redoes only these months")
    args = parser.parse_args()
    months = [(int(m[:4]), int(m[5:])) for m in args.month] if args.month else None
    spark = SparkSession.builder.appName("tillwise").getOrCreate()
    if args.format == "star":
        tables = Commerce(spark, args.data)
    else:
        tables = CommerceTables(spark, load_all(spark, args.data))
    run_all(tables, args.out, args.layer, months)


if __name__ == "__main__":
    main()
