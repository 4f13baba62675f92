"""

The stages of the full batch over a folder's tables run, and store their layer
below the session's scratch folder, when a query first reads that layer or a
later one; later queries read the layer they are about. Operator queries run
their operator anew.
"""

from __future__ import annotations

import os
import sys
from collections.abc import Callable
from datetime import datetime, timedelta
from uuid import uuid4

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, DecimalType

import oracle
from tillstar.operators import clean, rolling, segments, transform
from tillstar.operators.quantiles import quantiles
from tillstar.operators.scratch import materialize, scratch_root
from tillstar.plans import analytics, batch, load, profile, quality, star
from tillstar.sources import csv, feed
from tillstar.sources import layers as L
from tillstar.sources.reports import read_report

# The operators for text corpora and their pipeline are an optional part of the repository:
# without them, or what they import, the queries on invoices still stand.
try:
    from tillstar.llm import queries as text_queries
except ImportError as error:
    print(f"no queries on text corpora: {error}", file=sys.stderr)
    text_queries = None

ENTRY_DIR = "/root/testdata/sf0.001"
RUN_TS = datetime(2024, 1, 1)
# Divides the lines into two loads.
LOAD_DATE = "1995-06-01 00:00:00"

_stored: dict[tuple[str, str], tuple[L.Layers, list[str]]] = {}
_reported: set[L.Layers] = set()
_loaded: dict[tuple[str, str, bool], str] = {}


def layers_of(spark: SparkSession, sf_dir: str, stage: str = "facts") -> L.Layers:
    """The warehouse of a folder, built up to a stage: each runs on first use in a Spark
    application. After the last one the warehouse is that of `batch.run`."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _stored:
        tag = uuid4().hex[:12]
        names = L.Layers(
            f"{scratch_root(spark)}/tillstar/warehouse-{tag}",
            f"raw_data_{tag}", f"processed_data_{tag}", f"data_warehouse_{tag}",
        )
        L.attach(spark, names)
        _stored[key] = names, []
    names, built = _stored[key]
    for name, build in _STAGES.items():
        if name not in built:
            build(spark, sf_dir, names)
            built.append(name)
        if name == stage:
            break
    return names


def _build_raw(spark, sf_dir, names):
    L.write(feed.invoice_lines(spark, sf_dir), names, "raw", "raw_data")


def _build_processed(spark, sf_dir, names):
    batch.store_processed(L.read(spark, names, "raw", "raw_data"), names, RUN_TS)


def _build_dimensions(spark, sf_dir, names):
    batch.build_dimensions(L.read(spark, names, "processed", "processed_data"), names, RUN_TS)


def _build_facts(spark, sf_dir, names):
    batch.build_facts(L.read(spark, names, "processed", "processed_data"), names, RUN_TS)
    batch.write_summary(spark, names, RUN_TS, "order tables")


# Of the batch, in order.
_STAGES = {
    "raw": _build_raw, "processed": _build_processed, "dimensions": _build_dimensions, "facts": _build_facts,
}


def reported(spark: SparkSession, sf_dir: str) -> str:
    """Folder of the reports on a folder's warehouse: written on first use."""
    names = layers_of(spark, sf_dir)
    if names not in _reported:
        raw, processed = _raw(spark, sf_dir), _processed(spark, sf_dir)
        batch.write_profiles(raw, processed, names)
        quality.run(spark, names, RUN_TS)
        _reported.add(names)
    return batch.reports(names)


# Inputs of the operators: stored raw, cleaned and processed lines, star tables.
def _raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return L.read(spark, layers_of(spark, sf_dir, "raw"), "raw", "raw_data")


def _processed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return L.read(spark, layers_of(spark, sf_dir, "processed"), "processed", "processed_data")


def _cleaned(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _processed(spark, sf_dir).select(
        "invoice_no", "stock_code", "description", "quantity", "invoice_date", "unit_price",
        "customer_id", "country", "is_valid", "created_at",
    )


def _amounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return transform.add_amount(_cleaned(spark, sf_dir))


def _star(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return quality.warehouse_tables(spark, layers_of(spark, sf_dir))


def _dimensions(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    names = layers_of(spark, sf_dir, "dimensions")
    tables = ("dim_customer", "dim_date", "dim_product", "dim_country")
    return {t: L.read(spark, names, "warehouse", t) for t in tables}


def _filled(raw: DataFrame) -> DataFrame:
    return clean.fill_text(clean.fill_numeric(clean.parse_dates(raw)))


# Integers that are null for undated lines.
_DATE_PARTS = tuple(f"invoice_{p}" for p in ("year", "month", "day", "day_of_week", "quarter"))


def _comparable(df: DataFrame) -> DataFrame:
    """Results in types that every client shows alike, as in the oracles: decimals
    and nullable integers as doubles, days as text, rolling means to six places."""
    columns = []
    for field in df.schema.fields:
        column = F.col(field.name)
        if isinstance(field.dataType, DecimalType) or field.name in _DATE_PARTS:
            column = column.cast("double")
        elif isinstance(field.dataType, DateType):
            column = column.cast("string")
        elif field.name == rolling.NAME:
            column = F.round(column, 6)
        columns.append(column.alias(field.name))
    return df.select(*columns)


# Sources and layers
def scan_raw(spark, sf_dir):
    """The feed through a CSV file."""
    path = f"{scratch_root(spark)}/tillstar/csv-{uuid4().hex}"
    feed.invoice_lines(spark, sf_dir).write.csv(path, header=True, quote='"', escape='"')
    return csv.read_invoice_csv(spark, path)


def scan_raw_quoted(spark, sf_dir):
    """With line breaks, doubled quotes and white space in cells."""
    path = f"{scratch_root(spark)}/tillstar/csv-{uuid4().hex}"
    odd = feed.invoice_lines(spark, sf_dir).withColumns(
        {
            "description": F.concat("description", F.lit('\n"quoted", '), "stock_code"),
            "customer_id": F.coalesce("customer_id", F.lit("  ")),
            "country": F.concat(F.lit(" "), "country", F.lit(" ")),
        }
    )
    kept = {"ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
    odd.write.options(**kept).csv(path, header=True, quote='"', escape='"')
    return csv.read_invoice_csv(spark, path)


def layer_tables(spark, sf_dir):
    """The tables that the catalog lists for each layer, with their rows."""
    names, rows = layers_of(spark, sf_dir), None
    for layer in L.TABLES:
        for table in L.list_tables(spark, names, layer):
            assert L.has_table(spark, names, layer, table)
            row = spark.table(names.name(layer, table)).agg(
                F.lit(layer).alias("layer"), F.lit(table).alias("table_name"), F.count(F.lit(1)).alias("n")
            )
            rows = row if rows is None else rows.union(row)
    return rows


def _stored_twice(spark, sf_dir, if_exists):
    raw = _raw(spark, sf_dir)
    tag = uuid4().hex[:12]
    names = L.Layers(
        f"{scratch_root(spark)}/tillstar/roundtrip-{tag}",
        f"roundtrip_raw_{tag}", f"roundtrip_processed_{tag}", f"roundtrip_star_{tag}",
    )
    L.create(spark, names)
    L.write(raw, names, "raw", "raw_data", "fail")
    return L.write(raw, names, "raw", "raw_data", if_exists)


def layer_roundtrip(spark, sf_dir):
    return _stored_twice(spark, sf_dir, "replace")


def layer_append(spark, sf_dir):
    return _stored_twice(spark, sf_dir, "append")


# Cleaning
def clean_parse_dates(spark, sf_dir):
    return clean.parse_dates(_raw(spark, sf_dir))


def clean_parse_dates_typed(spark, sf_dir):
    """Timestamps that the raw layer keeps as text, and days as they are, are one date."""
    typed = clean.parse_dates(_raw(spark, sf_dir))
    return clean.parse_dates(typed.withColumn("invoice_date", F.col("invoice_date").cast("timestamp")))


def clean_parse_dates_us(spark, sf_dir):
    """Dates like 12/1/2010 8:26, recognised."""
    raw = _raw(spark, sf_dir)
    date = F.try_to_timestamp("invoice_date", F.lit("yyyy-MM-dd HH:mm:ss"))
    texts = F.coalesce(F.date_format(date, "M/d/yyyy H:mm"), "invoice_date")
    return clean.parse_dates(raw.withColumn("invoice_date", texts))


def clean_impute_numeric(spark, sf_dir):
    return clean.fill_numeric(clean.parse_dates(_raw(spark, sf_dir)))


def clean_impute_string(spark, sf_dir):
    return clean.fill_text(clean.parse_dates(_raw(spark, sf_dir)))


def clean_dedupe(spark, sf_dir):
    return clean.drop_repeats(_filled(_raw(spark, sf_dir)))


def outlier_bounds(spark, sf_dir):
    unique = materialize(clean.drop_repeats(_filled(_raw(spark, sf_dir))), "clean")
    rows = [(name, *fence) for name, fence in clean.outlier_bounds(unique).items()]
    schema = "column_name string, q1 double, q3 double, lower_bound double, upper_bound double"
    bounds = spark.createDataFrame(rows, schema)
    return bounds.select("column_name", *[F.round(c, 6).alias(c) for c in bounds.columns[1:]])


def flag_outliers(spark, sf_dir):
    unique = materialize(clean.drop_repeats(_filled(_raw(spark, sf_dir))), "clean")
    return clean.flag_outliers(unique)


# Derived columns
def derive_amount(spark, sf_dir):
    return _amounts(spark, sf_dir).drop("is_valid", "created_at")


def derive_date_parts(spark, sf_dir):
    return transform.add_date_parts(_cleaned(spark, sf_dir)).select(
        "invoice_no", "stock_code", "invoice_date", "invoice_year", "invoice_month", "invoice_day",
        "invoice_day_of_week", "invoice_quarter",
    )


def derive_product_category(spark, sf_dir):
    return transform.add_product_category(_cleaned(spark, sf_dir)).select(
        "invoice_no", "stock_code", "description", "product_category"
    )


def customer_totals(spark, sf_dir):
    return segments.customer_totals(_amounts(spark, sf_dir))


def _cutoffs(spark, sf_dir, **options):
    totals = segments.customer_totals(_amounts(spark, sf_dir))
    cuts = F.col("total_sales")
    return quantiles(totals, ["total_sales"], segments.CUTS, **options).select(
        F.round(cuts[0], 6).alias("q33"), F.round(cuts[1], 6).alias("q67")
    )


def segment_cutoffs(spark, sf_dir):
    return _cutoffs(spark, sf_dir)


def segment_cutoffs_by_range(spark, sf_dir):
    """By narrow steps, so that many scans are taken."""
    return _cutoffs(spark, sf_dir, bits=6)


def derive_customer_segment(spark, sf_dir):
    return segments.add_segments(_amounts(spark, sf_dir)).select(
        "invoice_no", "stock_code", "customer_id", "customer_segment"
    )


def derive_customer_segment_spread(spark, sf_dir):
    """With the join that spreads hot customers, whatever the number of customers."""
    return segments.add_segments(_amounts(spark, sf_dir), max_broadcast_bytes=0).select(
        "invoice_no", "stock_code", "customer_id", "customer_segment"
    )


_ROLLING = (
    "invoice_no", "stock_code", "customer_id", "country", "invoice_date", "total_amount",
    rolling.NAME,
)


def rolling_sales(spark, sf_dir):
    return rolling.add_rolling_sales(_amounts(spark, sf_dir)).select(*_ROLLING)


def rolling_sales_by_range(spark, sf_dir):
    """In small blocks."""
    return rolling.add_rolling_sales(_amounts(spark, sf_dir), block_rows=1000).select(*_ROLLING)


def processed_data(spark, sf_dir):
    return batch.process(_raw(spark, sf_dir), RUN_TS)


def processed_data_by_range(spark, sf_dir):
    """In small blocks."""
    return batch.process(_raw(spark, sf_dir), RUN_TS, block_rows=1000)


def processed_without_price(spark, sf_dir):
    """No amount, hence no segment and no rolling mean."""
    return batch.process(_raw(spark, sf_dir).drop("unit_price"), RUN_TS)


# Star schema
def _dimension(build):
    return lambda spark, sf_dir: build(_processed(spark, sf_dir), RUN_TS)


def fact_sales(spark, sf_dir):
    countries = _dimensions(spark, sf_dir)["dim_country"]
    return star.fact_sales(_processed(spark, sf_dir), countries, RUN_TS)


def fact_sales_lookup(spark, sf_dir):
    dims = _dimensions(spark, sf_dir).values()
    return star.fact_sales_lookup(_processed(spark, sf_dir), *dims, RUN_TS)


def fact_sales_lookup_spread(spark, sf_dir):
    """With the joins that spread hot customers and products."""
    dims = _dimensions(spark, sf_dir).values()
    return star.fact_sales_lookup(_processed(spark, sf_dir), *dims, RUN_TS, max_broadcast_bytes=0)


def fact_ids(spark, sf_dir):
    return star.number_lines(_processed(spark, sf_dir)).select(
        "fact_id", "invoice_no", "stock_code", "customer_id", "country", "total_amount"
    )


def check_keys(spark, sf_dir):
    return star.key_checks(*quality.star_tables(_star(spark, sf_dir)))


# Loads, one after the other
def _loads(spark, sf_dir, changed=False):
    """The star of two loads. Either the older lines come first, or they come a day later and
    some customers have moved in them."""
    processed = _processed(spark, sf_dir)
    older = F.col("invoice_date") < F.lit(LOAD_DATE).cast("timestamp_ntz")
    first, second = processed.where(older), processed.where(~older | F.col("invoice_date").isNull())
    later = RUN_TS
    if changed:
        moved = F.when(F.col("customer_id").endswith("7"), F.concat(F.lit("Old "), "country"))
        first, second = second, first.withColumn("country", F.coalesce(moved, "country"))
        later = RUN_TS + timedelta(days=1)
    key = (spark.sparkContext.applicationId, sf_dir, changed)
    if key not in _loaded:
        root = f"{scratch_root(spark)}/tillstar/loads-{uuid4().hex}"
        load.append(spark, first, root, "first", RUN_TS)
        load.append(spark, second, root, "second", later)
        # Known by its name, so that it adds nothing.
        load.append(spark, second, root, "second", later)
        _loaded[key] = root
    return load.tables(spark, _loaded[key])


def load_fact_sales(spark, sf_dir):
    """Two loads have the facts, and the ids, of one."""
    return _loads(spark, sf_dir)["fact_sales"]


def load_dim_customer(spark, sf_dir):
    """Rows keep their creation time; only changed ones get a new update time."""
    return _loads(spark, sf_dir, changed=True)["dim_customer"]


def load_dim_product(spark, sf_dir):
    return _loads(spark, sf_dir, changed=True)["dim_product"]


def load_dim_country(spark, sf_dir):
    """Countries keep their numbers; new ones get the next."""
    return _loads(spark, sf_dir, changed=True)["dim_country"]


def load_dim_date(spark, sf_dir):
    return _loads(spark, sf_dir, changed=True)["dim_date"]


# Profiles and quality
def validate_input(spark, sf_dir):
    return profile.validate_input(_raw(spark, sf_dir))


def summary_shape(spark, sf_dir):
    return profile.shape(_processed(spark, sf_dir)).withColumn(
        "column_names", F.array_join("column_names", ",")
    )


def summary_numeric(spark, sf_dir):
    summary = profile.numeric_summary(_processed(spark, sf_dir))
    rounded = ("mean", "std", "min", "q25", "q50", "q75", "max")
    return summary.withColumns({c: F.round(c, 6) for c in rounded})


def summary_categorical(spark, sf_dir):
    return profile.categorical_summary(_processed(spark, sf_dir))


def summary_top_values(spark, sf_dir):
    """The ten most frequent values of each column."""
    return profile.top_values(_processed(spark, sf_dir))


def q_raw_stats(spark, sf_dir):
    return profile.raw_stats(_raw(spark, sf_dir))


def q_processed_stats(spark, sf_dir):
    return profile.processed_stats(_processed(spark, sf_dir))


def q_star_stats(spark, sf_dir):
    return profile.star_stats(*quality.star_tables(_star(spark, sf_dir)))


def q_completeness(spark, sf_dir):
    return profile.completeness(_processed(spark, sf_dir))


def q_completeness_raw(spark, sf_dir):
    """Before the gaps are filled."""
    return profile.completeness(transform.add_amount(clean.parse_dates(_raw(spark, sf_dir))))


def q_consistency(spark, sf_dir):
    return profile.consistency(_star(spark, sf_dir)["fact_sales"])


def q_recommendations(spark, sf_dir):
    return profile.recommendations(q_completeness(spark, sf_dir), q_consistency(spark, sf_dir))


# Reports, read back from the files that a run writes
def _report(spark, sf_dir, name):
    return read_report(spark, f"{reported(spark, sf_dir)}/{name}")


def report_summary(spark, sf_dir):
    return _report(spark, sf_dir, "pipeline_summary").select(
        "pipeline_status", "timestamp", "data_source", "raw_rows", "processed_rows", "fact_rows"
    )


def report_columns(spark, sf_dir):
    return _report(spark, sf_dir, "processed_columns").select(
        F.col("position").cast("int").alias("position"), "column_name", "data_type", "missing_values"
    )


def report_validation(spark, sf_dir):
    """The best countries as the validation report has them."""
    found = _report(spark, sf_dir, "validation_results")
    return found.select(F.inline("star_schema.insights.top_countries"))


def report_quality(spark, sf_dir):
    return _report(spark, sf_dir, "data_quality_report").select("data_completeness.*")


def q_sql_text(spark, sf_dir):
    """SQL text over the stored tables."""
    names = layers_of(spark, sf_dir)
    return L.run_sql(
        spark,
        f"""SELECT region, count(fact_id) AS records,
                   CAST(coalesce(sum(total_amount), 0) AS DOUBLE) AS total_sales
            FROM {names.warehouse}.fact_sales fs
            JOIN {names.warehouse}.dim_country dc ON fs.country_id = dc.country_id
            WHERE fs.is_valid = 1 GROUP BY region""",
    )


# Sales analysis: name -> (function, dimension it needs)
_ANALYSES = {
    "q_top_countries": (analytics.top_countries, "dim_country"),
    "q_total_sales_by_country": (analytics.total_sales_by_country, "dim_country"),
    "q_country_totals": (analytics.country_totals, "dim_country"),
    "q_customer_distribution": (analytics.customer_distribution, "dim_customer"),
    "q_customer_segment_analysis": (analytics.customer_segment_analysis, "dim_customer"),
    "q_segment_counts": (analytics.segment_counts, "dim_customer"),
    "q_monthly_trends": (analytics.monthly_trends, "dim_date"),
    "q_sales_trends_by_month": (analytics.sales_trends_by_month, "dim_date"),
    "q_month_totals": (analytics.month_totals, "dim_date"),
    "q_top_products": (analytics.top_products, "dim_product"),
}


def _analysis(name):
    function, dimension = _ANALYSES[name]

    def query(spark, sf_dir):
        tables = _star(spark, sf_dir)
        return function(tables["fact_sales"], tables[dimension])

    return query


_QUERIES = {
    **{
        f.__name__: f
        for f in (
            scan_raw, scan_raw_quoted, layer_roundtrip, layer_append, layer_tables,
            clean_parse_dates, clean_parse_dates_typed, clean_parse_dates_us, clean_impute_numeric, clean_impute_string, clean_dedupe,
            outlier_bounds, flag_outliers,
            derive_amount, derive_date_parts, derive_product_category, customer_totals,
            segment_cutoffs, segment_cutoffs_by_range,
            derive_customer_segment, derive_customer_segment_spread,
            rolling_sales, rolling_sales_by_range,
            processed_data, processed_data_by_range, processed_without_price,
            fact_sales, fact_sales_lookup, fact_sales_lookup_spread, fact_ids, check_keys,
            load_fact_sales, load_dim_customer, load_dim_product, load_dim_country, load_dim_date,
            validate_input, summary_shape, summary_numeric, summary_categorical, summary_top_values,
            q_raw_stats, q_processed_stats, q_star_stats, q_completeness, q_completeness_raw,
            q_consistency, q_recommendations, q_sql_text,
            report_summary, report_columns, report_validation, report_quality,
        )
    },
    "dim_customer": _dimension(star.dim_customer),
    "dim_date": _dimension(star.dim_date),
    "dim_product": _dimension(star.dim_product),
    "dim_country": _dimension(star.dim_country),
    **{name: _analysis(name) for name in _ANALYSES},
}


def entry(spark: SparkSession) -> DataFrame:
    """Flagship: raw order tables -> star schema -> top countries by sales."""
    return queries()["q_top_countries"](spark, ENTRY_DIR)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def comparable(query):
        return lambda spark, sf_dir: _comparable(query(spark, sf_dir))

    found = {name: comparable(query) for name, query in _QUERIES.items()}
    return found | (text_queries.QUERIES if text_queries else {})


def oracle_sql() -> dict[str, str]:
    return oracle.statements() | (text_queries.ORACLES if text_queries else {})
