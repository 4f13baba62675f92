import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tests.frames import column, doubles, raw, ts
from tillstar.functions import expressions
from tillstar.operators import clean
from tillstar.operators.columns import numeric_columns, text_columns
from tillstar.operators.quantiles import quantile_values


def test_columns_by_kind(spark):
    df = raw(spark, {})
    assert numeric_columns(df) == ["quantity", "unit_price"]
    assert text_columns(df) == [
        "invoice_no", "stock_code", "description", "invoice_date", "customer_id", "country",
    ]


@pytest.mark.parametrize("zone", ["UTC", "Europe/Berlin", "America/Sao_Paulo"])
def test_dates_are_parsed_without_time_zone(spark, zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        texts = ["2010-03-28 02:30:00", "2018-11-04 00:00:00", "1965-01-01 00:00:01", "bad", None]
        df = clean.parse_dates(raw(spark, *[{"invoice_date": t} for t in texts]))
        assert dict(df.dtypes)["invoice_date"] == "timestamp_ntz"
        expected = [ts(t) for t in texts[:3]] + [None, None]
        assert column(df, "invoice_date") == expected
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_date_format_is_a_parameter(spark):
    df = raw(spark, {"invoice_date": "12/1/2010 8:26"}, {"invoice_date": "bad"})
    df = clean.parse_dates(df, "M/d/yyyy H:mm")
    assert column(df, "invoice_date") == [ts("2010-12-01 08:26"), None]


def test_dates_need_their_column(spark):
    df = doubles(spark, x=[1.0])
    assert clean.parse_dates(df).columns == ["x"]


def test_median_fills_nulls(spark):
    df = doubles(spark, x=[1.0, 2.0, 3.0, 10.0, None, float("nan")], empty=[None] * 6)
    filled = clean.fill_numeric(df)
    assert column(filled, "x") == [1.0, 2.0, 3.0, 10.0, 2.5, 2.5]
    assert column(filled, "empty") == [None] * 6


def test_median_keeps_the_declared_type(spark):
    df = raw(spark, {"quantity": 1}, {"quantity": 4}, {"quantity": None, "unit_price": None})
    filled = clean.fill_numeric(df)
    assert filled.schema == df.schema or dict(filled.dtypes) == dict(df.dtypes)
    assert column(filled, "quantity") == [1, 4, 3]


def test_text_fill_leaves_dates_alone(spark):
    gaps = {"description": None, "customer_id": None, "invoice_date": "x", "invoice_no": "0"}
    df = clean.parse_dates(raw(spark, gaps, {}))
    filled = clean.fill_text(df).where("invoice_no = '0'")
    assert column(filled, "description", "customer_id", "invoice_date") == [("Unknown", "Unknown", None)]


@pytest.mark.parametrize(
    "texts",
    [
        ["12/1/2010 8:26", "1/13/2011 10:00", "bad", None],
        ["2010-12-01 08:26:00", "2011-01-13 10:00:00", "bad", None],
        ["2010-12-01 08:26:00.0", "2011-01-13 10:00:00.000000", None],
        ["2010-12-01T08:26", "2011-01-13T10:00:00", "13/13/2013 1:00"],
        ["1.12.2010 8:26", "13.1.2011 10:00"],
        ["13/1/2011 10:00", "1/12/2010 8:26", "14/1/2011 10:00"],
    ],
)
def test_date_formats_are_recognised(spark, texts):
    df = raw(spark, *[{"invoice_date": t, "invoice_no": str(i)} for i, t in enumerate(texts)])
    found = column(clean.parse_dates(df), "invoice_date")
    assert {ts("2010-12-01 08:26:00"), ts("2011-01-13 10:00:00")} <= set(found)


def test_typed_dates_are_taken_as_they_are(spark):
    df = spark.sql("SELECT DATE '2020-01-02' AS invoice_date")
    assert column(clean.parse_dates(df), "invoice_date") == [ts("2020-01-02 00:00:00")]
    df = spark.sql("SELECT TIMESTAMP_NTZ '2020-01-02 03:04:05.5' AS invoice_date")
    assert column(clean.parse_dates(df), "invoice_date") == [ts("2020-01-02 03:04:05.500000")]


def test_unreadable_dates_are_an_error(spark):
    with pytest.raises(ValueError, match="invoice_date"):
        clean.parse_dates(raw(spark, {"invoice_date": "soon"}, {"invoice_date": None}))
    none = clean.parse_dates(raw(spark, {"invoice_date": None}))
    assert dict(none.dtypes)["invoice_date"] == "timestamp_ntz"


DATES = [
    "2010-12-01 08:26:00", "2010-12-01", "2010-02-30", "2010-12-01T08:26", "12/1/2010 8:26", "1/12/2010", "13/1/2010 8:26",
    "1/13/2010", "12/1/10", "31.1.2010 10:00", "1-2-2010", "2010/1/31 1:02:03", "20101231", "20101331", "20101231 23:59",
    "not-a-date", "", "0/0/0000", "99/99/9999", "2010-12-01 24:00:00", "2010-12-01 08:26:00.123456", "+2010-12-01", "-1/2/2010",
]


def test_shapes_leave_out_no_format(spark):
    """What reads a text also reads its shape."""
    from tillstar.functions.expressions import DATE_FORMATS, parse_datetime

    df = spark.createDataFrame([(t,) for t in DATES], "x string")
    df = df.withColumn("shape", F.translate("x", "0123456789", "1" * 10))
    for fmt in DATE_FORMATS:
        lost = df.where(parse_datetime("x", fmt).isNotNull() & parse_datetime("shape", fmt).isNull())
        assert lost.count() == 0


def test_recognition_counts_all_rows(spark):
    def recognised(*texts):
        return clean.recognise_format(spark.createDataFrame([(t,) for t in texts], "invoice_date string"))

    assert recognised("1/2/2010", "1/13/2010", None) == "M/d/yyyy[ H:mm[:ss]]"
    assert recognised("1/2/2010", "13/1/2010", "junk") == "d/M/yyyy[ H:mm[:ss]]"
    assert recognised(None, None) == clean.DATE_FORMATS[0]
    with pytest.raises(ValueError, match="2 texts"):
        recognised("99/99/9999", "junk", None)


def test_repeats_count_null_as_equal(spark):
    rows = [{"description": "x"}, {"description": None}, {"description": None}, {"description": "x"}]
    assert clean.drop_repeats(raw(spark, *rows)).count() == 2


def test_quantiles(spark):
    df = doubles(spark, x=[1.0, 2.0, 3.0, 10.0, None], none=[None] * 5)
    found = quantile_values(df, ["x", "none"], [0.5, 0.25, 0.33])
    assert found["x"] == pytest.approx([2.5, 1.75, 1.99])
    assert found["none"] is None or found["none"] == [None] * 3


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(
    values=st.lists(st.integers(-50, 50).map(lambda i: i / 4), min_size=1, max_size=60),
    probabilities=st.lists(st.floats(0, 1), min_size=1, max_size=3),
)
@pytest.mark.parametrize("bits", [5, 16])
def test_quantiles_equal_linear_interpolation(spark, bits, values, probabilities):
    from tillstar.operators.quantiles import quantiles

    df = spark.createDataFrame([(v,) for v in values], "x double").repartition(3)
    found = quantiles(df, ["x"], probabilities, bits=bits).first()["x"]
    assert found == pytest.approx(list(np.quantile(values, probabilities)), abs=1e-9)


@pytest.mark.parametrize("bits", [7, 16, 22])
def test_quantiles_of_many_values(spark, bits):
    df = spark.range(100_000).select((F.pmod(F.col("id") * 7919, 100_003) * 1.0).alias("x"))
    df = df.union(spark.range(50_000).select(F.lit(5.0)))  # a third of all rows
    from tillstar.operators.quantiles import quantiles

    probabilities = [0.0, 0.1, 0.5, 0.77, 1.0]
    expected = df.agg(F.percentile("x", F.array(*map(F.lit, probabilities)))).first()[0]
    found = quantiles(df, ["x"], probabilities, bits=bits).first()["x"]
    assert found == pytest.approx(expected)


ODD_DOUBLES = [
    0.0, 5e-324, 2.2250738585072009e-308, 2.2250738585072014e-308, 1e-300, 0.1, 0.5, 1.0, 1.0000000000000002, 2.0,
    3.9999999999999996, 4.0, 8.0, 1e15, 2.0**53, 2.0**1023, 1.7976931348623157e308, float("inf"),
    *[2.0**k for k in range(-1074, 1024, 13)], *[np.nextafter(2.0**k, 0) for k in range(-1073, 1024, 13)],
]


def test_codes_are_the_bits_of_doubles(spark):
    import struct

    from tillstar.operators.quantiles import with_codes

    rows = [(float(v),) for v in ODD_DOUBLES] + [(-float(v),) for v in ODD_DOUBLES] + [(None,), (float("nan"),)]
    coded = with_codes(spark.createDataFrame(rows, "x double"), "x").collect()
    for value, code in coded:
        if value is None or value != value:
            assert code is None
        else:
            (bits,) = struct.unpack("q", struct.pack("d", abs(value)))
            assert code == (bits if value >= 0 else -bits)


@pytest.mark.parametrize("bits", [11, 16])
def test_quantiles_of_odd_doubles(spark, bits):
    finite = [v for v in ODD_DOUBLES if v != float("inf")]
    values = sorted([*finite, *[-v for v in finite]])
    df = spark.createDataFrame([(float(v),) for v in [*values, float("nan")]] + [(None,)], "x double")
    steps = [k / (len(values) - 1) for k in range(0, len(values), 9)]
    found = quantile_values(df, ["x"], steps, bits=bits)["x"]
    assert found == pytest.approx([values[round(p * (len(values) - 1))] for p in steps], rel=1e-9)
    infinite = spark.createDataFrame([(float("-inf"),), (1.0,), (float("inf"),)], "x double")
    assert quantile_values(infinite, ["x"], [0.0, 0.5, 1.0], bits=bits)["x"] == [float("-inf"), 1.0, float("inf")]


def test_quantiles_take_few_scans(spark, monkeypatch):
    """Four scans for any doubles, with no window and no sketch."""
    from tillstar.operators import quantiles as module

    scans = []
    plain = module._counts
    monkeypatch.setattr(module, "_counts", lambda *a: scans.append(a) or plain(*a))
    df = spark.range(20_000).select(*[F.rand(k).alias(f"x{k}") for k in range(4)])
    module.quantile_values(df, df.columns, [0.25, 0.5, 0.75])
    assert len(scans) <= 4


def test_approximate_quantiles_take_existing_values(spark):
    df = spark.range(1000).select(F.col("id").cast("double").alias("x"))
    (median,) = quantile_values(df, ["x"], [0.5], accuracy=10_000)["x"]
    assert median in (499.0, 500.0)


def test_outliers_lie_beyond_the_fence(spark):
    # q1 = 2, q3 = 4: the fence is [-1, 7], and its ends are inside.
    df = doubles(spark, x=[-1.0, 2.0, 3.0, 4.0, 7.0], y=[None] * 5)
    fence = clean.outlier_bounds(df)["x"]
    assert (fence.lower, fence.upper) == (-1.0, 7.0)
    assert column(clean.flag_outliers(df), "is_valid") == [1] * 5
    df = doubles(spark, x=[-1.5, 2.0, 3.0, 4.0, 7.0, 3.0, None])
    assert dict(column(clean.flag_outliers(df), "x", "is_valid"))[-1.5] == 0
    assert dict(column(clean.flag_outliers(df), "x", "is_valid"))[None] == 1


def test_any_column_makes_an_outlier(spark):
    x = [1.0] * 20 + [99.0, 1.0]
    y = [1.0] * 20 + [1.0, 99.0]
    flags = column(clean.flag_outliers(doubles(spark, x=x, y=y)), "is_valid")
    assert flags == [1] * 20 + [0, 0]


def test_flags_without_numbers(spark):
    df = spark.createDataFrame([("a",)], "s string")
    assert column(clean.flag_outliers(df), "is_valid") == [1]


def test_clean_fills_before_it_dedupes(spark, run_ts):
    # The null price becomes the median 2, which makes the last two lines equal.
    rows = [{"unit_price": 1}, {"unit_price": 3}, {"unit_price": 2}, {"unit_price": None}]
    df = clean.clean(raw(spark, *rows), run_ts)
    assert sorted(column(df, "unit_price")) == [1, 2, 3]
    assert set(column(df, "created_at")) == {run_ts}
    assert set(column(df, "is_valid")) == {1}


def test_texts_of_an_iso_shape_are_read_alike(spark):
    days = [f"{y}-{m}-{d}" for y in ("0000", "1900", "2000", "9999") for m in ("00", "02", "12", "13") for d in ("00", "01", "29", "30", "31")]
    texts = days + [f"{day} {time}" for day in days for time in ("00:00", "24:00", "23:59:59", "23:59:60", "12:60")]
    odd = ["2000-1-02", " 2000-01-02", "2000-01-02 1:00", "2000-01-02 10", "2000-01-02 10:00:00.5", "+2000-01-02", "\u0662000-01-02", "", None]
    df = spark.createDataFrame([(t,) for t in texts + odd], "x string")
    read = df.select("x", expressions.parse_datetime("x").alias("fast"), expressions._read(F.col("x"), expressions.ISO_FORMAT).alias("slow"))
    assert read.where("not (fast <=> slow)").isEmpty()
    assert read.where("fast is not null").count() > 40
    assert "CASE WHEN" in df.select(expressions.parse_datetime("x"))._jdf.queryExecution().analyzed().toString()
