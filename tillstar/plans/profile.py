"""Profiles of one table: input check, statistics, summaries, quality shares.

Output names of raw_stats, processed_stats, star_stats, completeness and consistency are
fixed values: the contract of the reports.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ByteType, DateType, IntegerType, ShortType, TimestampNTZType, TimestampType

from tillstar.functions.expressions import mean_of, percent
from tillstar.operators import frequent
from tillstar.operators.clean import parse_dates
from tillstar.operators.columns import numeric_columns, text_columns
from tillstar.operators.quantiles import quantiles

# Advice texts, in the order in which they are given.
ADVICE_CUSTOMERS = "High percentage of missing customer data - consider data source validation"
ADVICE_AMOUNTS = "Negative amounts found - implement data validation rules"
ADVICE_PRICES = "Negative prices detected - review data processing logic"
MISSING_CUSTOMERS_LIMIT = 5


def validate_input(df: DataFrame) -> DataFrame:
    """One row per column: type, kind, nulls; plus row and repeat counts of the table.

    Equal rows are counted together first, which gives nulls, rows and repeats
    from a single shuffle, with copies combined before it.
    """
    numeric, text = set(numeric_columns(df)), set(text_columns(df))
    counted = df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("_n"))

    def column_row(position, field) -> Column:
        kind = "numeric" if field.name in numeric else "categorical" if field.name in text else "other"
        return F.struct(
            F.lit(position).alias("position"),
            F.lit(field.name).alias("column_name"),
            F.lit(field.dataType.simpleString()).alias("data_type"),
            F.lit(kind).alias("kind"),
            F.coalesce(F.col(f"_missing_{field.name}"), F.lit(0)).alias("missing_values"),
        )

    totals = counted.agg(
        F.coalesce(F.sum("_n"), F.lit(0)).alias("total_rows"),
        F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).alias("duplicates"),
        *[F.sum(F.when(F.col(c).isNull(), F.col("_n"))).alias(f"_missing_{c}") for c in df.columns],
    )
    rows = F.array(*[column_row(i, f) for i, f in enumerate(df.schema.fields)])
    return totals.select("total_rows", "duplicates", F.inline(rows))


# Parts of a double that are summed as decimals, so that sums don't depend on task order.
_PART = "decimal(28,8)"


def _exact(column: Column) -> Column:
    return column.cast(_PART)


# Bits of the parts in which whole numbers and their squares are summed: no sum of parts overflows
# below 2**42 rows.
_WHOLE_BITS, _SQUARE_BITS = 16, 21


def _sum_in_parts(value: Column, bits: int, parts: int) -> Column:
    """The exact sum of a long, from sums of its bits in parts: far cheaper than a sum of decimals."""
    total = None
    for i in range(parts):
        part = F.shiftright(value, bits * i)
        if i < parts - 1:
            part = part.bitwiseAND(F.lit(2**bits - 1))
        weighed = F.sum(part).cast("decimal(20,0)") * F.lit(2 ** (bits * i)).cast("decimal(13,0)")
        total = weighed if total is None else total + weighed
    return total


def _total(name: str, whole: bool) -> Column:
    if whole:
        return _sum_in_parts(F.col(name).cast("long"), _WHOLE_BITS, 2)
    return F.sum(_exact(F.col(name)))


def _squares(name: str, whole: bool) -> Column:
    if whole:
        value = F.col(name).cast("long")
        return _sum_in_parts(value * value, _SQUARE_BITS, 3)
    value = _exact(F.col(name))
    return F.sum((value * value).cast("decimal(38,8)"))


def _mean(name: str, whole: bool) -> Column:
    return mean_of(_total(name, whole), F.count(name))


def _deviation(name: str, whole: bool) -> Column:
    """Sample standard deviation from exact sums of values and squares."""
    n = F.count(name)
    total, squares = _total(name, whole), _squares(name, whole)
    spread = squares.cast("double") - total.cast("double") * total.cast("double") / n
    return F.when(n > 1, F.sqrt(F.greatest(spread, F.lit(0.0)) / (n - 1)))


def numeric_summary(df: DataFrame, accuracy: int | None = None) -> DataFrame:
    """Count, mean, std, min, quartiles and max per numeric and date column.

    Dates are given in seconds since 1970 and have no standard deviation.
    """
    numeric = numeric_columns(df)
    epoch = F.lit("1970-01-01").cast("timestamp_ntz")
    dated = [
        f.name
        for f in df.schema.fields
        if isinstance(f.dataType, (DateType, TimestampType, TimestampNTZType))
    ]

    def seconds(name: str) -> Column:
        since = F.timestamp_diff("MICROSECOND", epoch, F.col(name).cast("timestamp_ntz"))
        return (since / 1_000_000.0).alias(name)

    columns = [*numeric, *dated]
    whole = {f.name for f in df.schema.fields if isinstance(f.dataType, (ByteType, ShortType, IntegerType))}
    values = df.select(*[F.col(c).cast("double").alias(c) for c in numeric], *map(seconds, dated))
    # Whole numbers of up to 32 bits stay so.
    measured = df.select(
        *[F.col(c) if c in whole else F.col(c).cast("double").alias(c) for c in numeric], *map(seconds, dated)
    )
    stats = measured.agg(
        *[
            F.struct(
                F.lit(c).alias("column_name"),
                F.count(c).alias("count"),
                _mean(c, c in whole).alias("mean"),
                (_deviation(c, c in whole) if c in numeric else F.lit(None).cast("double")).alias("std"),
                F.min(c).cast("double").alias("min"),
                F.max(c).cast("double").alias("max"),
            ).alias(c)
            for c in columns
        ]
    ).select(F.inline(F.array(*columns)))
    quarters = quantiles(values, columns, [0.25, 0.5, 0.75], accuracy).select(
        F.inline(
            F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).alias("q")) for c in columns])
        )
    )
    return stats.join(quarters, "column_name").select(
        "column_name", "count", "mean", "std", "min",
        F.col("q")[0].alias("q25"), F.col("q")[1].alias("q50"), F.col("q")[2].alias("q75"), "max",
    )


def categorical_summary(df: DataFrame) -> DataFrame:
    """How often each value of each string column occurs; nulls left out."""
    columns = text_columns(df)
    return (
        df.select(*columns)
        .unpivot([], columns, "column_name", "value")
        .where(F.col("value").isNotNull())
        .groupBy("column_name", "value")
        .agg(F.count(F.lit(1)).alias("count"))
    )


def top_values(df: DataFrame, k: int = 10) -> DataFrame:
    """The k most frequent values of each string column; equally frequent ones in order."""
    return frequent.top_values(df, text_columns(df), k)


def shape(df: DataFrame) -> DataFrame:
    """One row: number of rows, number of columns, column names."""
    names = F.array(*map(F.lit, df.columns))
    return df.agg(F.count(F.lit(1)).alias("rows")).select(
        "rows", F.lit(len(df.columns)).alias("columns"), names.alias("column_names")
    )


def column_check(df: DataFrame) -> DataFrame:
    """One row per column in their order: name, type, nulls."""
    rows = [
        F.struct(
            F.lit(i).alias("position"),
            F.lit(f.name).alias("column_name"),
            F.lit(f.dataType.simpleString()).alias("data_type"),
            F.count_if(F.col(f.name).isNull()).alias("missing_values"),
        )
        for i, f in enumerate(df.schema.fields)
    ]
    return df.agg(F.array(*rows).alias("rows")).select(F.inline("rows"))


def _distinct(df: DataFrame, name: str) -> Column:
    """Number of values of a column, as a scalar subquery of its own: several distinct counts in
    one aggregate would expand every row into one a column, and shuffle all columns for each."""
    return df.select(name).distinct().agg(F.count(name)).scalar()


def raw_stats(raw: DataFrame, date_format: str | None = None) -> DataFrame:
    """Profile of the raw lines; dates are compared as timestamps, not as text."""
    lines = parse_dates(raw, date_format)
    totals = lines.agg(
        F.count(F.lit(1)).alias("total_rows"),
        F.min("invoice_date").alias("earliest_date"),
        F.max("invoice_date").alias("latest_date"),
    )
    return totals.select(
        "total_rows",
        _distinct(lines, "country").alias("unique_countries"),
        _distinct(lines, "invoice_date").alias("unique_dates"),
        "earliest_date",
        "latest_date",
        _distinct(lines, "customer_id").alias("unique_customers"),
        _distinct(lines, "stock_code").alias("unique_products"),
    )


def processed_stats(processed: DataFrame) -> DataFrame:
    """Profile of the processed lines, valid or not."""
    totals = processed.agg(
        F.count(F.lit(1)).alias("total_rows"),
        F.count_if(F.col("is_valid") == 1).alias("valid_rows"),
        F.count_if(F.col("is_valid") == 0).alias("invalid_rows"),
        F.coalesce(F.sum("total_amount"), F.lit(0)).cast("double").alias("total_sales"),
        F.round(
            F.coalesce(mean_of(F.sum("unit_price"), F.count("unit_price")), F.lit(0.0)), 6
        ).alias("avg_unit_price"),
    )
    return totals.select(
        "total_rows",
        "valid_rows",
        "invalid_rows",
        _distinct(processed, "country").alias("unique_countries"),
        _distinct(processed, "invoice_date").alias("unique_dates"),
        _distinct(processed, "customer_id").alias("unique_customers"),
        _distinct(processed, "stock_code").alias("unique_products"),
        "total_sales",
        "avg_unit_price",
        percent("valid_rows", "total_rows").alias("data_quality_percentage"),
    )


def star_stats(
    facts: DataFrame,
    customers: DataFrame,
    dates: DataFrame,
    products: DataFrame,
    countries: DataFrame,
) -> DataFrame:
    """Row counts of the warehouse as rows (stat, value)."""

    def rows(df: DataFrame, **counts: Column) -> DataFrame:
        return df.agg(*[c.alias(name) for name, c in counts.items()]).unpivot(
            [], list(counts), "stat", "value"
        )

    every = F.count(F.lit(1))
    stats = rows(
        facts,
        fact_sales_count=every,
        valid_facts_count=F.count_if(F.col("is_valid") == 1),
        invalid_facts_count=F.count_if(F.col("is_valid") == 0),
    )
    for dim, name in (
        (customers, "dim_customer_count"),
        (dates, "dim_date_count"),
        (products, "dim_product_count"),
        (countries, "dim_country_count"),
    ):
        stats = stats.unionByName(rows(dim, **{name: every}))
    return stats


def completeness(processed: DataFrame) -> DataFrame:
    """Nulls in the columns that matter, as counts and in percent."""
    checked = {
        "missing_country": "country",
        "missing_date": "invoice_date",
        "missing_customer_id": "customer_id",
        "missing_stock_code": "stock_code",
        "missing_total_amount": "total_amount",
    }
    counts = processed.agg(
        F.count(F.lit(1)).alias("total_rows"),
        *[F.count_if(F.col(c).isNull()).alias(name) for name, c in checked.items()],
    )
    return counts.withColumns({f"{name}_pct": percent(name, "total_rows") for name in checked})


def consistency(facts: DataFrame) -> DataFrame:
    """Negative measures, as counts and in percent of all facts."""
    checked = {
        "negative_amounts": "total_amount",
        "negative_prices": "unit_price",
        "negative_quantities": "quantity",
    }
    counts = facts.agg(
        F.count(F.lit(1)).alias("total_facts"),
        *[F.count_if(F.col(c) < 0).alias(name) for name, c in checked.items()],
    )
    return counts.withColumns({f"{name}_pct": percent(name, "total_facts") for name in checked})


def recommendations(completeness_row: DataFrame, consistency_row: DataFrame) -> DataFrame:
    """Advice for the findings, as rows (position, recommendation)."""

    def advice(position: int, finding: Column, text: str) -> Column:
        return F.struct(
            F.lit(position).alias("position"),
            F.lit(text).alias("recommendation"),
            finding.alias("found"),
        )

    customers = advice(1, F.col("missing_customer_id_pct") > MISSING_CUSTOMERS_LIMIT, ADVICE_CUSTOMERS)
    amounts = advice(2, F.col("negative_amounts_pct") > 0, ADVICE_AMOUNTS)
    prices = advice(3, F.col("negative_prices_pct") > 0, ADVICE_PRICES)
    given = completeness_row.select(F.inline(F.array(customers))).unionByName(
        consistency_row.select(F.inline(F.array(amounts, prices)))
    )
    return given.where("found").drop("found").orderBy("position")
