"""Invoice lines from CSV."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StringType

from tillstar.schemas import PRICE, RAW
from tillstar.sources.records import read_records

# Texts a CSV cell may hold to say "missing".
MISSING_TEXTS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)


def read_invoice_csv(
    spark: SparkSession, path: str, encoding: str = "UTF-8", multi_line: bool = True
) -> DataFrame:
    """Read invoice lines; columns are found by header name, in any order.

    Columns of the contract get their declared type, unreadable numbers become
    null, further columns stay text. All files of a folder must have the same
    header; another one is an error, and so is a row with more or fewer cells.
    `multi_line` allows line breaks inside quotes: a UTF-8 file is read twice, both
    times by many tasks (see `records`); in other encodings a file is one task.
    Without it a file is read once, and a row that such a break tears apart is an
    error.

    A cell is missing if it is exactly one of MISSING_TEXTS; white space counts as
    text.
    """
    if multi_line and encoding.upper().replace("-", "") == "UTF8":
        return to_contract(read_records(spark, path))
    text = spark.read.csv(
        path, header=True, enforceSchema=False, quote='"', escape='"', encoding=encoding,
        multiLine=multi_line, mode="FAILFAST",
    )
    return to_contract(text)


def to_contract(text: DataFrame) -> DataFrame:
    """Type the text columns of an invoice file."""
    types = {f.name: f.dataType for f in RAW.fields}

    def typed(name):
        value = F.col(name)
        value = F.when(~value.isin(*MISSING_TEXTS), value)
        kind = types.get(name, StringType())
        if isinstance(kind, StringType):
            return value.alias(name)
        value = value.try_cast(PRICE)
        return (value.try_cast("int") if isinstance(kind, IntegerType) else value).alias(name)

    return text.select(*[typed(c) for c in text.columns])
