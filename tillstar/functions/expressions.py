"""Column expressions shared by the operators. All are built-in functions."""

from pyspark.sql import Column
from pyspark.sql import functions as F

# Date texts that are recognised, the first of equally good ones wins.
ISO_FORMAT = "yyyy-MM-dd[ HH:mm[:ss[.SSSSSS]]]"
# Texts that ISO_FORMAT and a cast read alike, all digits made 1.
ISO_SHAPES = ("1111-11-11", "1111-11-11 11:11", "1111-11-11 11:11:11")
DATE_FORMATS = (
    ISO_FORMAT,
    "yyyy-MM-dd'T'HH:mm[:ss[.SSSSSS]]",
    "M/d/yyyy[ H:mm[:ss]]",
    "d/M/yyyy[ H:mm[:ss]]",
    "M/d/yy[ H:mm[:ss]]",
    "d/M/yy[ H:mm[:ss]]",
    "d.M.yyyy[ H:mm[:ss]]",
    "d-M-yyyy[ H:mm[:ss]]",
    "yyyy/M/d[ H:mm[:ss]]",
    "yyyyMMdd[ HH:mm[:ss]]",
)

# Region word lists, tested in this order.
REGIONS = (
    (
        "Europe",
        (
            "united kingdom", "germany", "france", "italy", "spain", "netherlands", "belgium",
            "switzerland", "austria", "sweden", "norway", "denmark", "finland",
        ),
    ),
    ("North America", ("united states", "canada", "mexico")),
    ("Asia", ("japan", "china", "india", "singapore", "south korea", "thailand", "malaysia")),
    ("Oceania", ("australia", "new zealand")),
)

# Shape of a product category, and the name for "none found".
CATEGORY_PATTERN = "([A-Z]{2,})"
NO_CATEGORY = "OTHER"


def parse_datetime(column, fmt: str = ISO_FORMAT) -> Column:
    """Text to timestamp_ntz; null where the text does not follow `fmt`.

    The text is read as UTC and rebuilt by arithmetic on a zone-less anchor, so
    the session time zone and its clock changes have no say in the result.

    Texts of an ISO shape are cast, which reads them as the format does at a fraction of
    the time.
    """
    column = F.col(column) if isinstance(column, str) else column
    if fmt == ISO_FORMAT:
        shaped = F.translate(column, "023456789", "1" * 9).isin(*ISO_SHAPES)
        return F.when(shaped, column.try_cast("timestamp_ntz")).otherwise(_read(column, fmt))
    return _read(column, fmt)


def _read(column: Column, fmt: str) -> Column:
    text = F.concat(column, F.lit(" +0000"))
    instant = F.try_to_timestamp(text, F.lit(f"{fmt} Z"))
    anchor = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    return F.timestamp_add("MICROSECOND", F.unix_micros(instant), anchor)


def date_parts(column) -> dict[str, Column]:
    """Calendar numbers of a date; the week starts on Monday = 0."""
    return {
        "year": F.year(column),
        "month": F.month(column),
        "day": F.dayofmonth(column),
        "day_of_week": F.weekday(column),
        "quarter": F.quarter(column),
    }


def date_key(column) -> Column:
    """Calendar day as the integer yyyyMMdd."""
    return F.year(column) * 10000 + F.month(column) * 100 + F.dayofmonth(column)


def is_weekend(column) -> Column:
    return (F.weekday(column) >= 5).cast("int")


def product_category(column) -> Column:
    """First run of two or more capitals in a description."""
    found = F.nullif(F.regexp_extract(column, CATEGORY_PATTERN, 1), F.lit(""))
    return F.coalesce(found, F.lit(NO_CATEGORY))


def region(column) -> Column:
    """Region of a country name, by the first word list with a hit."""
    name = F.lower(column)
    result = F.when(name.isNull(), "Unknown")
    for label, words in REGIONS:
        result = result.when(name.rlike("|".join(words)), label)
    return result.otherwise("Other")


def percent(part, total) -> Column:
    """Share in percent with two decimals; 0 for an empty total."""
    share = F.try_divide(F.col(part), F.col(total)) * 100.0
    return F.when(F.col(total) > 0, F.round(share, 2)).otherwise(F.lit(0.0))


def mean_of(total, count) -> Column:
    """Mean from an exact (decimal) sum and a count; null when nothing was counted."""
    return F.try_divide(total.cast("double"), count)
