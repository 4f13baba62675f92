from decimal import Decimal

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tests.frames import column, doubles, lines, raw, same_rows
from tillstar.functions import expressions as X
from tillstar.operators import rolling, segments, spread, transform
from tillstar.operators.clean import parse_dates


def test_amount_is_exact(spark):
    df = transform.add_amount(raw(spark, {"quantity": -3, "unit_price": "0.1"}))
    assert column(df, "total_amount") == [Decimal("-0.3")]


def test_date_parts(spark):
    texts = ["2020-01-01 00:00:00", "2020-01-05 23:59:59", "bad"]
    df = transform.add_date_parts(parse_dates(raw(spark, *[{"invoice_date": t} for t in texts])))
    names = [f"invoice_{p}" for p in ("year", "month", "day", "day_of_week", "quarter")]
    assert column(df, *names) == [(2020, 1, 1, 2, 1), (2020, 1, 5, 6, 1), (None,) * 5]


def test_product_category(spark):
    texts = ["WHITE HANGING", "T-LIGHT", "Unknown", "PACK OF 72", "abcDEfg", None, ""]
    df = transform.add_product_category(raw(spark, *[{"description": t} for t in texts]))
    expected = ["WHITE", "LIGHT", "OTHER", "PACK", "DE", "OTHER", "OTHER"]
    assert column(df, "product_category") == expected


def test_regions(spark):
    names = {
        "United Kingdom": "Europe", "EIRE": "Other", "USA": "Other", "Indiana": "Asia",
        "UNITED STATES": "North America", "New Zealand": "Oceania", "Hong Kong": "Other",
        "South Korea": "Asia", "": "Other", None: "Unknown",
    }
    df = spark.createDataFrame([(n,) for n in names], "c string").select(X.region("c"))
    assert [r[0] for r in df.collect()] == list(names.values())


def test_steps_need_their_columns(spark, run_ts):
    df = doubles(spark, x=[1.0])
    assert transform.transform(df).columns == ["x"]
    partial = raw(spark, {}).select("quantity", "unit_price")
    assert transform.transform(partial).columns == ["quantity", "unit_price", "total_amount"]


def totals_of(spark, totals):
    rows = [{"customer_id": str(i), "unit_price": t} for i, t in enumerate(totals)]
    return segments.customer_totals(lines(spark, *rows))


def test_totals_skip_nulls(spark):
    rows = [
        {"customer_id": "a", "unit_price": 2}, {"customer_id": "a", "unit_price": None},
        {"customer_id": "b", "unit_price": None}, {"customer_id": None, "unit_price": 9},
    ]
    found = segments.customer_totals(lines(spark, *rows))
    assert sorted(column(found, "customer_id", "total_sales", "n")) == [("a", 2, 2), ("b", 0, 1)]


def test_segments(spark):
    found = segments.segment_customers(totals_of(spark, [-5, 0, 3, 7, 20, 30]))
    got = column(found, "customer_segment", order=["customer_id"])
    assert got == [None, None, "Medium", "Medium", "High", "High"]


def test_segment_bins_are_closed_on_the_right(spark):
    # 101 totals 1..101: the cut points are the totals 34 and 68.
    found = segments.segment_customers(totals_of(spark, range(1, 102)))
    got = {int(t): s for t, s in column(found, "total_sales", "customer_segment")}
    assert (got[34], got[35], got[68], got[69]) == ("Low", "Medium", "Medium", "High")


@pytest.mark.parametrize("totals", [[-9, -8, -7, 5], [4, 4, 4, 4], [0, 0, 0, 5, 9, 10]])
def test_segments_need_increasing_cut_points(spark, totals):
    with pytest.raises(ValueError, match="0 < q33 < q67"):
        segments.segment_customers(totals_of(spark, totals))


@pytest.mark.parametrize("max_broadcast_bytes", [0, 10_000])
def test_segments_reach_every_line(spark, max_broadcast_bytes):
    rows = [{"customer_id": None if i % 9 == 0 else str(i % 7), "unit_price": 1 + i % 5,
             "invoice_no": str(i)} for i in range(300)]
    df = lines(spark, *rows)
    # A third of all lines from one customer.
    df = df.union(lines(spark, *[{"customer_id": "hot", "invoice_no": f"h{i}"} for i in range(150)]))
    found = segments.add_segments(df, max_broadcast_bytes=max_broadcast_bytes)
    assert found.count() == df.count()
    per_customer = dict(
        column(segments.segment_customers(segments.customer_totals(df)), "customer_id", "customer_segment")
    )
    for customer, segment in column(found, "customer_id", "customer_segment"):
        assert segment == per_customer.get(customer)


def test_hot_keys_are_few_and_shared_out(spark):
    counts = spark.createDataFrame([("a", 50), ("b", 30), ("c", 1), (None, 90)], "k string, n long")
    shares = int(spark.conf.get("spark.sql.shuffle.partitions"))
    hot = dict(column(spread.hot_keys(counts, "k"), "k", "_shares"))
    assert hot == {"a": -(-50 * shares // 171)} and len(hot) < shares


@pytest.mark.parametrize("rows", [0, 3, 5000])
def test_hot_keys_are_found_without_counting_every_key(spark, rows):
    df = spark.range(rows).select(
        F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 5 == 0, "warm").when(F.col("id") % 11 == 0, None)
        .otherwise(F.col("id").cast("string")).alias("k")
    )
    assert same_rows(spread.hot_keys_of(df, "k"), spread.hot_keys(spread.key_counts(df, "k"), "k"))


@pytest.mark.parametrize("how", ["inner", "left"])
def test_spread_join_equals_plain_join(spark, how):
    rows = spark.range(2000).select(
        F.col("id"),
        F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 11 == 0, None)
        .otherwise((F.col("id") % 40).cast("string")).alias("k"),
    )
    lookup = spark.createDataFrame([("hot", 1)] + [(str(i), i) for i in range(0, 40, 2)], "k string, v int")
    spreaded = spread.join_unique(rows, lookup, "k", spread.key_counts(rows, "k"), False, how)
    assert same_rows(spreaded, rows.join(lookup, "k", how))


def by_rolling(df):
    rows = df.select("country", F.col("invoice_date").cast("string"), "rolling_7d_sales").collect()
    return [tuple(r) for r in rows]


def rolling_by_country(df):
    """The expected value: one window per country."""
    window = Window.partitionBy("country").orderBy(*rolling.line_order(df)).rowsBetween(-6, 0)
    total, n = F.sum("total_amount").over(window), F.count("total_amount").over(window)
    mean = F.try_divide(total.cast("double"), n)
    return df.withColumn(rolling.NAME, F.when(F.col("country").isNotNull(), mean))


ROLLING = [rolling_by_country, rolling.add_rolling_sales]


@pytest.mark.parametrize("operator", ROLLING)
def test_rolling_mean(spark, operator):
    a, b = {"country": "A"}, {"country": "B"}
    df = lines(
        spark,
        {**a, "invoice_date": "bad", "unit_price": 5},
        {**a, "invoice_date": "2020-01-01 00:00:00", "unit_price": None},
        {**a, "invoice_date": "2020-01-02 00:00:00", "unit_price": 1},
        {**b, "invoice_date": "bad", "unit_price": 3},
        {"country": None, "unit_price": 3},
    )
    found = {(c, d): v for c, d, v in by_rolling(operator(df))}
    assert found == {
        ("A", "2020-01-01 00:00:00"): None,
        ("A", "2020-01-02 00:00:00"): 1.0,
        ("A", None): 3.0,
        ("B", None): 3.0,
        (None, "2020-01-01 10:00:00"): None,
    }


@pytest.mark.parametrize("operator", ROLLING)
def test_rolling_mean_spans_seven_lines(spark, operator):
    rows = [{"invoice_no": f"{i:02}", "unit_price": i} for i in range(10)]
    found = operator(lines(spark, *rows))
    got = column(found, "rolling_7d_sales", order=["invoice_no"])
    assert got == [0, 0.5, 1, 1.5, 2, 2.5, 3, 4, 5, 6]


@pytest.mark.parametrize("ranges, block_rows", [(40, 7), (40, 1000), (2, 50), (900, 6)])
def test_rolling_by_range_equals_rolling_by_country(spark, ranges, block_rows):
    # One country with most lines, one date with a third of them, tiny countries.
    df = spark.range(3000).select(
        F.col("id").cast("string").alias("invoice_no"),
        F.when(F.col("id") % 10 > 0, "big").otherwise((F.col("id") % 170).cast("string")).alias("country"),
        F.when(F.col("id") % 3 == 0, None)
        .otherwise(F.make_date(F.lit(2020), F.lit(1), (1 + F.col("id") % 28).cast("int")))
        .cast("timestamp_ntz").alias("invoice_date"),
        F.when(F.col("id") % 13 > 0, (F.col("id") % 97).cast("decimal(18,4)")).alias("total_amount"),
    ).withColumn("country", F.when(F.col("invoice_no") != "77", F.col("country")))
    before = {
        k: spark.conf.get(k)
        for k in ("spark.sql.adaptive.coalescePartitions.enabled", "spark.sql.shuffle.partitions")
    }
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", str(ranges))
    try:
        by_range = rolling.add_rolling_sales(df, block_rows).collect()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    by_country = rolling_by_country(df).collect()
    key = lambda r: int(r["invoice_no"])
    assert sorted(by_range, key=key) == sorted(by_country, key=key)


def test_broadcasts_are_decided_by_bytes(spark):
    narrow = spark.range(100).select(F.col("id").cast("string").alias("k"))
    wide = narrow.withColumn("text", F.repeat(F.lit("x"), F.lit(10_000)))
    assert spread.measured_bytes(narrow) == 100 * 16 + 190
    assert spread.is_small(narrow, 10_000) and not spread.is_small(wide, 10_000)


@pytest.mark.parametrize("block_rows", [7, 1000])
def test_segments_looked_up_in_blocks_are_those_of_a_broadcast(spark, block_rows):
    rows = [{"customer_id": [None, "Unknown", "a", "b", str(i)][i % 5], "unit_price": 1 + i % 7, "invoice_no": str(i),
             "country": [None, "France", "Spain"][i % 3], "invoice_date": ["bad", f"2020-01-{1 + i % 28:02}"][i % 4 > 0]}
            for i in range(200)]
    df = lines(spark, *rows).drop("total_amount")
    spread_out = transform.transform(df, block_rows=block_rows, max_broadcast_bytes=0)
    assert same_rows(spread_out, transform.transform(df, block_rows=block_rows))
    assert column(spread_out.where("customer_id is null"), "customer_segment").count(None) == 40


def test_large_segments_shuffle_lines_once(spark):
    df = lines(spark, *[{"customer_id": str(i % 9), "unit_price": 1 + i % 7, "invoice_no": str(i)} for i in range(50)])
    plan = transform.transform(df.drop("total_amount"), max_broadcast_bytes=0)._jdf.queryExecution().executedPlan().toString()
    # One key by which lines go, and no join of lines by customer.
    exchanges = [x for x in plan.splitlines() if "Exchange hashpartitioning" in x]
    assert len([x for x in exchanges if "customer_id" not in x and "_block" in x]) == 1
    assert not [x for x in exchanges if "_salt" in x]
    window = plan[: plan.index("Exchange hashpartitioning")]
    assert "Project" in window and "regexp_extract" in window
