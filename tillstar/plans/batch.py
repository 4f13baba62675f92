"""The full batch: raw lines in, three layers and a run summary out."""

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillstar.operators.clean import clean
from tillstar.operators.columns import has
from tillstar.operators.rolling import BLOCK_ROWS, sort_distinct_by_country
from tillstar.operators.scratch import COMPRESSION, materialize, scratch_folder, shuffles_released
from tillstar.operators.transform import transform
from tillstar.plans import load, profile, star
from tillstar.sources import layers as L
from tillstar.sources import versions
from tillstar.sources.reports import write_report


def run(
    spark: SparkSession,
    raw: DataFrame,
    layers: L.Layers,
    run_ts: datetime | None = None,
    date_format: str | None = None,
    accuracy: int | None = None,
    profiles: bool = True,
    source: str | None = None,
) -> L.Layers:
    """Load, store raw, check, clean, derive, summarise, store, build the star.

    Tables are replaced, so a second run gives the same warehouse. Every stage
    reads the stored table of the one before it. `accuracy` makes all quantiles
    approximate; `profiles` controls the input check and the summaries; `source`
    names the input in the run summary. Without `date_format` the format is
    recognised. Scratch tables are deleted at the end of their stage.
    """
    run_ts = run_ts or datetime.now()
    L.attach(spark, layers)
    raw = L.write(raw, layers, "raw", "raw_data")
    processed = store_processed(raw, layers, run_ts, date_format, accuracy)
    if profiles:
        with scratch_folder(spark):
            write_profiles(raw, processed, layers, accuracy)
    build_star(processed, layers, run_ts)
    write_summary(spark, layers, run_ts, source)
    return layers


def store_processed(
    raw: DataFrame,
    layers: L.Layers,
    run_ts: datetime,
    date_format: str | None = None,
    accuracy: int | None = None,
) -> DataFrame:
    """Replace the processed layer by what the raw lines give. The scratch tables, as large as the
    lines, are deleted before the next stage writes its own."""
    with scratch_folder(raw.sparkSession):
        return L.write(
            process(raw, run_ts, date_format, accuracy), layers, "processed", "processed_data"
        )


def load_lines(
    spark: SparkSession,
    raw: DataFrame,
    root: str,
    name: str,
    run_ts: datetime | None = None,
    date_format: str | None = None,
    accuracy: int | None = None,
) -> versions.Version:
    """Clean raw lines by themselves and add them to the star below `root` as the load `name`.
    A load of a known name adds nothing and reads nothing."""
    before = versions.current(spark, root.rstrip("/"))
    if name in before.loads:
        return before
    run_ts = run_ts or datetime.now()
    with scratch_folder(spark):
        processed = materialize(process(raw, run_ts, date_format, accuracy), "processed")
        return load.append(spark, processed, root, name, run_ts)


def process(
    raw: DataFrame,
    run_ts: datetime,
    date_format: str | None = None,
    accuracy: int | None = None,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """Clean and derive. Repeats are dropped by the shuffle that puts the lines in the order
    that the rolling mean needs, and the lines are stored in it, and not once more."""
    if has(raw, "quantity", "unit_price", "country", "invoice_date"):
        lines = clean(raw, run_ts, date_format, accuracy, store_distinct=sort_distinct_by_country)
    else:
        lines = clean(raw, run_ts, date_format, accuracy)
    return transform(lines, accuracy, block_rows)


def build_star(processed: DataFrame, layers: L.Layers, run_ts: datetime) -> None:
    """Replace the warehouse tables by those of the processed lines."""
    build_dimensions(processed, layers, run_ts)
    build_facts(processed, layers, run_ts)


def build_dimensions(processed: DataFrame, layers: L.Layers, run_ts: datetime) -> None:
    absent = [c for c in star.NEEDED if not has(processed, c)]
    if absent:
        raise ValueError(f"a star schema needs the columns {', '.join(absent)}")
    with scratch_folder(processed.sparkSession):
        for table, build in (
            ("dim_customer", star.dim_customer),
            ("dim_date", star.dim_date),
            ("dim_product", star.dim_product),
            ("dim_country", star.dim_country),
        ):
            L.write(build(processed, run_ts), layers, "warehouse", table)


def build_facts(processed: DataFrame, layers: L.Layers, run_ts: datetime) -> None:
    """The fact table, for the stored dimensions of the same lines."""
    countries = L.read(processed.sparkSession, layers, "warehouse", "dim_country")
    with scratch_folder(processed.sparkSession):
        L.write(star.fact_sales(processed, countries, run_ts), layers, "warehouse", "fact_sales")


def write_profiles(
    raw: DataFrame, processed: DataFrame, layers: L.Layers, accuracy: int | None = None
) -> None:
    """Input check of the raw lines and summaries of the processed ones."""
    folder = reports(layers)
    write_report(profile.validate_input(raw), folder, "input_check")
    write_report(profile.shape(processed), folder, "processed_shape")
    write_report(profile.column_check(processed), folder, "processed_columns")
    write_report(profile.numeric_summary(processed, accuracy), folder, "numeric_summary")
    write_report(profile.top_values(processed), folder, "top_values")
    # As large as the distinct values: written in parallel, in no order.
    counts = profile.categorical_summary(processed)
    with shuffles_released(counts.sparkSession):
        counts.write.mode("overwrite").option("compression", COMPRESSION).parquet(f"{folder}/categorical_summary")


def write_summary(
    spark: SparkSession, layers: L.Layers, run_ts: datetime, source: str | None = None
) -> None:
    write_report(run_summary(spark, layers, run_ts, source), reports(layers), "pipeline_summary")


def run_summary(
    spark: SparkSession, layers: L.Layers, run_ts: datetime, source: str | None = None
) -> DataFrame:
    return spark.range(1).select(
        F.lit("Completed").alias("pipeline_status"),
        F.lit(run_ts.isoformat()).alias("timestamp"),
        F.lit(source).cast("string").alias("data_source"),
        *[
            F.lit(L.read(spark, layers, layer, table).count()).cast("long").alias(name)
            for layer, table, name in (
                ("raw", "raw_data", "raw_rows"),
                ("processed", "processed_data", "processed_rows"),
                ("warehouse", "fact_sales", "fact_rows"),
            )
        ],
        F.struct(
            F.lit(layers.root).alias("root"),
            F.lit(layers.raw).alias("raw_schema"),
            F.lit(layers.processed).alias("processed_schema"),
            F.lit(layers.warehouse).alias("warehouse_schema"),
        ).alias("layers"),
    )


def reports(layers: L.Layers) -> str:
    return f"{layers.root.rstrip('/')}/reports"
