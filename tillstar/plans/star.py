"""Star schema: four dimensions and one fact table from the processed lines."""

from datetime import datetime

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillstar import schemas
from tillstar.functions import expressions as X
from tillstar.operators.clean import timestamp
from tillstar.operators.columns import has
from tillstar.operators.ranges import with_dense_ids
from tillstar.operators.rolling import line_order
from tillstar.operators.scratch import materialize
from tillstar.operators.spread import (
    MAX_BROADCAST_BYTES,
    hot_keys_of,
    is_small,
    join_unique,
    key_counts,
)


# Columns without which there are no facts.
NEEDED = ("customer_id", "stock_code", "country", "invoice_date")


def dim_customer(processed: DataFrame, run_ts: datetime) -> DataFrame:
    """One row per customer, with the country of its earliest line."""
    return customers(customer_values(processed), run_ts)


def customer_values(processed: DataFrame) -> DataFrame:
    """The attribute values of every customer, with the date of their first line."""
    segment = (
        F.col("customer_segment") if has(processed, "customer_segment") else F.lit("Unknown")
    )
    return seen_values(
        processed.withColumn("customer_segment", segment), "customer_id", ["country", "customer_segment"]
    )


def customers(values: DataFrame, run_ts: datetime) -> DataFrame:
    return _earliest(values, "customer_id", ["country", "customer_segment"]).select(
        "customer_id",
        "customer_segment",
        "country",
        timestamp(run_ts).alias("created_at"),
        timestamp(run_ts).alias("updated_at"),
    )


def seen_values(lines: DataFrame, key: str, attributes: list[str]) -> DataFrame:
    """The distinct attribute values per key, and when each was first seen. Those of several
    sets of lines, taken together by the least `seen`, are those of all the lines."""
    known = lines.where(F.col(key).isNotNull())
    return known.groupBy(key, *attributes).agg(F.min("invoice_date").alias("seen"))


def _earliest(values: DataFrame, key: str, attributes: list[str]) -> DataFrame:
    """One survivor per key among the distinct attribute values: the one seen
    first; on equal days the smallest; undated values last.

    The lines have shrunk to their distinct values in a hash aggregation with partial
    results. Only those few rows meet the minimum over structs, which Spark sorts.
    """
    survivor = F.struct(F.col("seen").isNull().alias("undated"), "seen", *attributes)
    return values.groupBy(key).agg(F.min(survivor).alias("_s")).select(
        key, *[F.col(f"_s.{a}").alias(a) for a in attributes]
    )


def dim_date(processed: DataFrame, run_ts: datetime) -> DataFrame:
    """One row per calendar day with a line."""
    parts = X.date_parts("date")
    return (
        processed.where(F.col("invoice_date").isNotNull())
        .select(F.col("invoice_date").cast("date").alias("date"))
        .distinct()
        .select(
            X.date_key("date").alias("date_id"),
            "date",
            *[parts[p].alias(p) for p in ("year", "month", "day", "quarter", "day_of_week")],
            F.date_format("date", "EEEE").alias("day_name"),
            F.date_format("date", "MMMM").alias("month_name"),
            X.is_weekend("date").alias("is_weekend"),
            timestamp(run_ts).alias("created_at"),
        )
    )


def dim_product(processed: DataFrame, run_ts: datetime) -> DataFrame:
    """One row per stock code, described by its earliest line."""
    return products(product_values(processed), run_ts)


def product_values(processed: DataFrame) -> DataFrame:
    """The attribute values of every stock code, with the date of their first line."""
    category = (
        F.col("product_category") if has(processed, "product_category") else F.lit(X.NO_CATEGORY)
    )
    lines = processed.withColumn("product_category", category)
    if not has(lines, "description"):
        lines = lines.withColumn("description", F.lit(None).cast("string"))
    return seen_values(lines, "stock_code", ["description", "product_category"])


def products(values: DataFrame, run_ts: datetime) -> DataFrame:
    return _earliest(values, "stock_code", ["description", "product_category"]).select(
        F.col("stock_code").alias("product_id"),
        "stock_code",
        "description",
        "product_category",
        timestamp(run_ts).alias("created_at"),
    )


def dim_country(processed: DataFrame, run_ts: datetime) -> DataFrame:
    """One row per country name, numbered by name."""
    return countries(country_names(processed), run_ts)


def country_names(processed: DataFrame) -> DataFrame:
    names = processed.where(F.col("country").isNotNull())
    return names.select(F.col("country").alias("country_name")).distinct()


def countries(names: DataFrame, run_ts: datetime, after: int = 0) -> DataFrame:
    """Countries numbered by name from `after` + 1."""
    return with_dense_ids(names, [F.col("country_name")], "country_id", "countries").select(
        (F.col("country_id") + after).cast("int").alias("country_id"),
        "country_name",
        X.region("country_name").alias("region"),
        timestamp(run_ts).alias("created_at"),
        timestamp(run_ts).alias("updated_at"),
    )


def fact_sales(processed: DataFrame, countries: DataFrame, run_ts: datetime) -> DataFrame:
    """Facts for dimensions that were built from the same `processed` lines.

    Every key of a line is then present in its dimension, customer and product
    keys are their own surrogates, and the day key is computed. Only the country
    number must be looked up. `fact_sales_lookup` gives the same rows for
    dimensions of any other origin.
    """
    lines = _used(_keyed(processed))
    return _facts(_looked_up(lines, lines, _country_ids(countries), "country"), run_ts)


def _looked_up(
    lines: DataFrame, counted: DataFrame, lookup: DataFrame, key: str,
    max_broadcast_bytes: int = MAX_BROADCAST_BYTES,
) -> DataFrame:
    """Join to a lookup; a lookup too large to be broadcast has its hot keys spread."""
    small = is_small(lookup, max_broadcast_bytes)
    return join_unique(lines, lookup, key, None, small, hot=hot_keys_of(counted, key))


def fact_sales_lookup(
    processed: DataFrame,
    customers: DataFrame,
    dates: DataFrame,
    products: DataFrame,
    countries: DataFrame,
    run_ts: datetime,
    max_broadcast_bytes: int = MAX_BROADCAST_BYTES,
) -> DataFrame:
    """Facts with all four keys looked up; a line with a missing key is left out."""
    lines = keyed = _used(_keyed(processed))
    for lookup, key in (
        (_country_ids(countries), "country"),
        (dates.select("date_id"), "date_id"),
        (customers.select("customer_id"), "customer_id"),
        (products.select(F.col("product_id").alias("stock_code")), "stock_code"),
    ):
        lines = _looked_up(lines, keyed, lookup, key, max_broadcast_bytes)
    return _facts(lines, run_ts)


# Columns of the lines that facts and their order are taken from.
_USED = (
    "invoice_no", "stock_code", "description", "quantity", "invoice_date", "unit_price", "customer_id",
    "country", "total_amount", "rolling_7d_sales", "is_valid", "date_id",
)


def _used(keyed: DataFrame) -> DataFrame:
    """Joins hash, and shuffle, whole lines, and facts are sorted: only what they are made and ordered of."""
    return keyed.select(*[c for c in keyed.columns if c in _USED])


def _keyed(processed: DataFrame) -> DataFrame:
    """Lines that can have all keys: dated, and with non-empty customer and product."""
    return processed.where(
        F.col("invoice_date").isNotNull()
        & (F.col("customer_id") != "")
        & (F.col("stock_code") != "")
        & F.col("country").isNotNull()
    ).withColumn("date_id", X.date_key("invoice_date"))


def _country_ids(countries: DataFrame) -> DataFrame:
    return countries.select(F.col("country_name").alias("country"), "country_id")


def _facts(lines: DataFrame, run_ts: datetime) -> DataFrame:
    """The fact columns; facts are numbered in line order, so the same lines get the same
    ids whatever the partitions."""

    def optional(name: str, default: Column) -> Column:
        return F.col(name) if has(lines, name) else default

    kinds = {f.name: f.dataType for f in schemas.FACT_SALES.fields}
    measures = {
        c: optional(c, F.lit(None).cast(kinds[c])).alias(c)
        for c in ("quantity", "unit_price", "total_amount", "invoice_no", "rolling_7d_sales")
    }
    made_of = {"customer_id", "date_id", "stock_code", "country_id", "is_valid", *measures}
    keep = [c for c in lines.columns if c in made_of]
    return with_dense_ids(lines, _fact_order(lines), "fact_id", "facts", keep).select(
        F.col("fact_id").cast("long").alias("fact_id"),
        "customer_id",
        "date_id",
        F.col("stock_code").alias("product_id"),
        "country_id",
        *measures.values(),
        optional("is_valid", F.lit(1)).alias("is_valid"),
        timestamp(run_ts).alias("created_at"),
    )


def _fact_order(lines: DataFrame) -> list[Column]:
    """By date; with all raw columns, so that it tells distinct lines apart."""
    return [*line_order(lines), F.col("country").asc()]


def number_lines(processed: DataFrame) -> DataFrame:
    """Dated lines with a consecutive fact_id 1, 2, 3, ... in line order."""
    return with_dense_ids(_keyed(processed), _fact_order(processed), "fact_id", "numbered")


# Runs of ids that are compared with each other in one task; more are a table in no order.
MAX_RUNS = 100_000


def unique_by_runs(table: DataFrame, key: str) -> bool:
    """Whether the files of a stored table show that its ids are unique and not null.

    Where ids and row numbers of a file go up together they form a run, whose ids differ.
    A table written in the order of its ids has a few runs per file, and the ids are unique
    if no two runs overlap. Only runs leave the tasks that read the files. False means
    that it cannot be told this way."""
    try:
        rows = table.select(key, F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("row"))
    except AnalysisException:
        return False
    runs = rows.groupBy("file", (F.col(key) - F.col("row")).alias("run")).agg(
        F.min(key).alias("least"), F.max(key).alias("most")
    )
    runs = materialize(runs, "runs")
    if not 0 < runs.count() <= MAX_RUNS or not runs.where("run is null").isEmpty():
        return runs.isEmpty()
    before = F.lag("most").over(Window.orderBy("least"))
    return runs.where("run is not null").select("least", before.alias("before")).where("before >= least").isEmpty()


def key_checks(
    facts: DataFrame,
    customers: DataFrame,
    dates: DataFrame,
    products: DataFrame,
    countries: DataFrame,
) -> DataFrame:
    """Violations of the declared keys, as rows (check, table_name, column_name, violations).

    Facts are counted per key before they meet a dimension, so a frequent key is
    one row in the join. Fact ids are counted only if their files do not show that they
    are unique.
    """
    dims = (
        (customers, "dim_customer", "customer_id"),
        (dates, "dim_date", "date_id"),
        (products, "dim_product", "product_id"),
        (countries, "dim_country", "country_id"),
    )

    def result(df, violations, check, table, column):
        return df.agg(F.coalesce(violations, F.lit(0)).cast("long").alias("violations")).select(
            F.lit(check).alias("check"),
            F.lit(table).alias("table_name"),
            F.lit(column).alias("column_name"),
            "violations",
        )

    rows = []
    certified = unique_by_runs(facts, "fact_id")
    for table, name, key in (*dims, (facts, "fact_sales", "fact_id")):
        if name == "fact_sales" and certified:
            none = facts.sparkSession.range(1)
            rows.append(result(none, F.lit(0), "primary key", name, key))
            continue
        repeats = key_counts(table, key).where(F.col(key).isNull() | (F.col("n") > 1))
        rows.append(result(repeats, F.sum("n"), "primary key", name, key))
    for dim, _, key in dims:
        orphans = key_counts(facts, key).join(dim.select(key), key, "left_anti")
        rows.append(result(orphans, F.sum("n"), "foreign key", "fact_sales", key))
    for dim, name, column in ((dates, "dim_date", "date"), (countries, "dim_country", "country_name")):
        missing = F.count_if(F.col(column).isNull())
        rows.append(result(dim, missing, "not null", name, column))

    checks = rows[0]
    for row in rows[1:]:
        checks = checks.unionByName(row)
    return checks
