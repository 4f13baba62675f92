"""Command line: build a warehouse from a file, report on a built one, or load lines into a
star that keeps its versions.

spark-submit tillstar/__main__.py build  <root> --source lines.csv [--date-format ...]
spark-submit tillstar/__main__.py report <root>
spark-submit tillstar/__main__.py load   <root> --source more.csv --name 2024-05
"""

import argparse
import os
import sys
from datetime import datetime

from pyspark.sql import SparkSession

if not __package__:  # started by its path: the package lies one folder up
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tillstar.plans import batch, quality
from tillstar.sources import layers as L
from tillstar.sources.csv import read_invoice_csv


def main(arguments: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="tillstar", description="Retail invoice warehouse")
    parser.add_argument("command", choices=("build", "report", "load"))
    parser.add_argument("root", help="folder of the warehouse, reachable by all executors")
    parser.add_argument("--source", help="invoice lines: a file or folder")
    parser.add_argument("--name", help="of a load; one that is there already adds nothing")
    parser.add_argument("--format", choices=("csv", "parquet"), help="by default from the source's name")
    parser.add_argument("--single-line", action="store_true",
                        help="CSV cells hold no line breaks, so that files are read once")
    parser.add_argument("--date-format", help="of invoice dates; recognised by default")
    parser.add_argument("--encoding", default="UTF-8")
    parser.add_argument("--accuracy", type=int, help="approximate quantiles, to one part in this")
    options = parser.parse_args(arguments)

    spark = SparkSession.builder.appName("tillstar").getOrCreate()
    layers = L.Layers(options.root)
    if options.command == "report":
        L.attach(spark, layers)
        quality.run(spark, layers, datetime.now(), options.date_format)
        return
    if not options.source:
        parser.error(f"{options.command} needs --source")
    if options.command == "load" and not options.name:
        parser.error("load needs --name")
    stored = options.source.rstrip("/").endswith(".parquet")
    if (options.format or ("parquet" if stored else "csv")) == "parquet":
        raw = spark.read.parquet(options.source)
    else:
        multi_line = not options.single_line
        raw = read_invoice_csv(spark, options.source, options.encoding, multi_line)
    kept = {"date_format": options.date_format, "accuracy": options.accuracy}
    if options.command == "build":
        batch.run(spark, raw, layers, source=options.source, **kept)
    else:
        batch.load_lines(spark, raw, options.root, options.name, **kept)


if __name__ == "__main__":
    main()
