import pytest
from pyspark.sql import functions as F

from tests.frames import column, doubles, lines, raw
from tillstar.plans import profile


def test_input_check(spark):
    rows = [{"description": "x"}, {"description": None}, {"description": None}, {"description": "x"},
            {"unit_price": None}]
    found = {r["column_name"]: r for r in profile.validate_input(raw(spark, *rows)).collect()}
    assert list(found) == [
        "invoice_no", "stock_code", "description", "quantity", "invoice_date", "unit_price",
        "customer_id", "country",
    ]
    assert found["description"]["missing_values"] == 2 and found["unit_price"]["missing_values"] == 1
    assert {(r["total_rows"], r["duplicates"]) for r in found.values()} == {(5, 2)}
    assert (found["quantity"]["data_type"], found["quantity"]["kind"]) == ("int", "numeric")
    assert (found["country"]["data_type"], found["country"]["kind"]) == ("string", "categorical")


def test_input_check_of_an_empty_table(spark):
    found = profile.validate_input(raw(spark, {}).limit(0)).first()
    assert (found["total_rows"], found["duplicates"], found["missing_values"]) == (0, 0, 0)


@pytest.mark.parametrize("accuracy", [None, 1000])
def test_numeric_summary(spark, accuracy):
    df = doubles(spark, x=[1.0, 2.0, 3.0, 10.0, None]).withColumn(
        "t", F.when(F.col("x") < 3, F.lit("1970-01-01 00:00:10").cast("timestamp_ntz"))
    ).withColumn("s", F.lit("text"))
    found = {r["column_name"]: r.asDict() for r in profile.numeric_summary(df, accuracy).collect()}
    assert set(found) == {"x", "t"}
    x = found["x"]
    assert (x["count"], x["mean"], x["min"], x["max"]) == (4, 4.0, 1.0, 10.0)
    assert x["std"] == pytest.approx(4.08248290463863)
    if accuracy is None:
        assert (x["q25"], x["q50"], x["q75"]) == (1.75, 2.5, 4.75)
    assert (found["t"]["count"], found["t"]["mean"], found["t"]["std"], found["t"]["q50"]) == (2, 10.0, None, 10.0)


def test_categorical_summary(spark):
    df = raw(spark, {"country": "A"}, {"country": "A"}, {"country": None})
    found = profile.categorical_summary(df).where("column_name = 'country'")
    assert column(found, "value", "count") == [("A", 2)]


def test_shape(spark):
    row = profile.shape(doubles(spark, x=[1.0, 2.0], y=[1.0, 2.0])).first()
    assert (row["rows"], row["columns"], row["column_names"]) == (2, 2, ["x", "y"])


def test_raw_dates_are_compared_as_timestamps(spark):
    df = raw(spark, {"invoice_date": "9/1/2010 8:00"}, {"invoice_date": "12/1/2010 8:00"},
             {"invoice_date": "bad"})
    row = profile.raw_stats(df, "M/d/yyyy H:mm").first()
    assert str(row["earliest_date"]) == "2010-09-01 08:00:00"
    assert str(row["latest_date"]) == "2010-12-01 08:00:00"
    assert (row["total_rows"], row["unique_dates"]) == (3, 2)


def test_processed_stats(spark):
    df = lines(spark, {"unit_price": 3}, {"unit_price": 5, "invoice_no": "2"}, {"unit_price": None})
    df = df.withColumn("is_valid", F.when(F.col("invoice_no") == "2", 0).otherwise(1))
    row = profile.processed_stats(df).first()
    assert (row["valid_rows"], row["invalid_rows"], row["total_sales"]) == (2, 1, 8.0)
    assert (row["avg_unit_price"], row["data_quality_percentage"]) == (4.0, 66.67)


def test_empty_tables_give_zero_percent(spark):
    df = lines(spark, {}).withColumn("is_valid", F.lit(1)).limit(0)
    row = profile.processed_stats(df).first()
    assert (row["total_sales"], row["avg_unit_price"], row["data_quality_percentage"]) == (0, 0, 0)
    assert profile.completeness(df).first()["missing_date_pct"] == 0
    assert profile.consistency(df).first()["negative_prices_pct"] == 0


def test_completeness_and_consistency(spark):
    df = lines(spark, {"customer_id": None}, {"unit_price": -1}, {"quantity": -1, "invoice_date": "bad"})
    complete, consistent = profile.completeness(df), profile.consistency(df)
    row = complete.first()
    assert (row["missing_customer_id_pct"], row["missing_date_pct"], row["missing_country_pct"]) == (33.33, 33.33, 0)
    row = consistent.first()
    assert (row["negative_amounts"], row["negative_prices"], row["negative_quantities"]) == (2, 1, 1)
    advice = [r["recommendation"] for r in profile.recommendations(complete, consistent).collect()]
    assert advice == [profile.ADVICE_CUSTOMERS, profile.ADVICE_AMOUNTS, profile.ADVICE_PRICES]


def test_no_findings_give_no_advice(spark):
    # One missing customer in twenty is exactly 5 %, which is not above the limit.
    df = lines(spark, {"customer_id": None}, *[{} for _ in range(19)])
    assert profile.recommendations(profile.completeness(df), profile.consistency(df)).isEmpty()


def test_whole_numbers_are_summed_exactly_without_decimals(spark):
    values = [2**31 - 1, -(2**31), 7, -65537, 0, None] * 50
    df = spark.createDataFrame([(v, None if v is None else float(v)) for v in values], "whole int, real double")
    found = {r["column_name"]: r.asDict() for r in profile.numeric_summary(df).collect()}
    assert {**found["whole"], "column_name": ""} == {**found["real"], "column_name": ""}
    plan = profile.numeric_summary(df.select("whole"))._jdf.queryExecution().optimizedPlan().toString()
    assert "decimal(28,8)" not in plan


def test_distinct_counts_do_not_expand_the_rows(spark):
    from tests.test_star import processed

    lines = processed(spark, *[{"customer_id": [None, "1", "2"][i % 3], "invoice_no": str(i), "country": "France"} for i in range(9)])
    for stats in (profile.processed_stats(lines), profile.raw_stats(raw(spark, {"customer_id": None}, {"customer_id": "1"}))):
        plan = stats._jdf.queryExecution().optimizedPlan().toString()
        assert "Expand" not in plan
    assert column(profile.processed_stats(lines), "unique_customers", "unique_countries") == [
        (lines.select("customer_id").where("customer_id is not null").distinct().count(), 1)
    ]
