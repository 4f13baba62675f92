"""Small report frames as JSON."""

from pyspark.sql import DataFrame, SparkSession

from tillstar.operators.scratch import shuffles_released


def write_report(report: DataFrame, folder: str, name: str) -> str:
    """Write a report of a few rows as one JSON file in `<folder>/<name>`; nulls are kept."""
    path = f"{folder.rstrip('/')}/{name}"
    with shuffles_released(report.sparkSession):
        report.coalesce(1).write.mode("overwrite").json(path, ignoreNullFields=False)
    return path


def read_report(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.json(path)
