"""Declared columns of every table, by layer."""

from pyspark.sql.types import (
    DateType,
    DecimalType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampNTZType,
)

PRICE = DecimalType(18, 4)
# int * decimal(18,4): wide enough for any product, so amounts never overflow.
AMOUNT = DecimalType(29, 4)


def _table(*columns, required=()):
    return StructType([StructField(n, t, n not in required) for n, t in columns])


_LINE_HEAD = (
    ("invoice_no", StringType()),
    ("stock_code", StringType()),
    ("description", StringType()),
    ("quantity", IntegerType()),
)
_LINE_TAIL = (
    ("unit_price", PRICE),
    ("customer_id", StringType()),
    ("country", StringType()),
)

# Raw keeps the date as the text it arrived in; cleaning parses it.
RAW = _table(*_LINE_HEAD, ("invoice_date", StringType()), *_LINE_TAIL)

PROCESSED = _table(
    *_LINE_HEAD,
    ("invoice_date", TimestampNTZType()),
    *_LINE_TAIL,
    ("is_valid", IntegerType()),
    ("created_at", TimestampNTZType()),
    ("total_amount", AMOUNT),
    ("invoice_year", IntegerType()),
    ("invoice_month", IntegerType()),
    ("invoice_day", IntegerType()),
    ("invoice_day_of_week", IntegerType()),
    ("invoice_quarter", IntegerType()),
    ("customer_segment", StringType()),
    ("product_category", StringType()),
    ("rolling_7d_sales", DoubleType()),
)

DIM_CUSTOMER = _table(
    ("customer_id", StringType()),
    ("customer_segment", StringType()),
    ("country", StringType()),
    ("created_at", TimestampNTZType()),
    ("updated_at", TimestampNTZType()),
)

DIM_DATE = _table(
    ("date_id", IntegerType()),
    ("date", DateType()),
    ("year", IntegerType()),
    ("month", IntegerType()),
    ("day", IntegerType()),
    ("quarter", IntegerType()),
    ("day_of_week", IntegerType()),
    ("day_name", StringType()),
    ("month_name", StringType()),
    ("is_weekend", IntegerType()),
    ("created_at", TimestampNTZType()),
)

DIM_PRODUCT = _table(
    ("product_id", StringType()),
    ("stock_code", StringType()),
    ("description", StringType()),
    ("product_category", StringType()),
    ("created_at", TimestampNTZType()),
)

DIM_COUNTRY = _table(
    ("country_id", IntegerType()),
    ("country_name", StringType()),
    ("region", StringType()),
    ("created_at", TimestampNTZType()),
    ("updated_at", TimestampNTZType()),
)

FACT_SALES = _table(
    ("fact_id", LongType()),
    ("customer_id", StringType()),
    ("date_id", IntegerType()),
    ("product_id", StringType()),
    ("country_id", IntegerType()),
    ("quantity", IntegerType()),
    ("unit_price", PRICE),
    ("total_amount", AMOUNT),
    ("invoice_no", StringType()),
    ("rolling_7d_sales", DoubleType()),
    ("is_valid", IntegerType()),
    ("created_at", TimestampNTZType()),
)
