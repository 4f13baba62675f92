import datetime as dt

import pytest
from pyspark.sql import functions as F

from tests.frames import column, lines, raw, same_rows
from tillstar.operators.segments import add_segments
from tillstar.operators.transform import add_product_category
from tillstar.plans import analytics, batch, profile, star


def processed(spark, *rows):
    df = lines(spark, *rows).withColumns(
        {"is_valid": F.lit(1), "customer_segment": F.lit("Low"), "rolling_7d_sales": F.lit(1.0)}
    )
    return add_product_category(df)


def build(df, run_ts):
    dims = [b(df, run_ts) for b in (star.dim_customer, star.dim_date, star.dim_product, star.dim_country)]
    return (star.fact_sales(df, dims[3], run_ts), *dims)


def test_customer_keeps_its_earliest_country(spark, run_ts):
    df = processed(
        spark,
        {"customer_id": "a", "country": "Italy", "invoice_date": "2020-01-02 00:00:00"},
        {"customer_id": "a", "country": "Spain", "invoice_date": "2020-01-01 00:00:00"},
        {"customer_id": "a", "country": "Chile", "invoice_date": "bad"},
        {"customer_id": "b", "country": "Spain", "invoice_date": "2020-01-01 00:00:00"},
        {"customer_id": "b", "country": "France", "invoice_date": "2020-01-01 00:00:00"},
        {"customer_id": "c", "country": "Peru", "invoice_date": "bad"},
        {"customer_id": None},
    )
    found = star.dim_customer(df, run_ts)
    assert sorted(column(found, "customer_id", "country")) == [("a", "Spain"), ("b", "France"), ("c", "Peru")]
    assert found.columns == ["customer_id", "customer_segment", "country", "created_at", "updated_at"]


def test_segment_default_needs_a_missing_column(spark, run_ts):
    df = processed(spark, {})
    assert column(star.dim_customer(df.drop("customer_segment"), run_ts), "customer_segment") == ["Unknown"]
    null = df.withColumn("customer_segment", F.lit(None).cast("string"))
    assert column(star.dim_customer(null, run_ts), "customer_segment") == [None]


def test_product_keeps_its_earliest_description(spark, run_ts):
    df = processed(
        spark,
        {"stock_code": "P1", "description": "NEW MUG", "invoice_date": "2021-01-01 00:00:00"},
        {"stock_code": "P1", "description": "old mug", "invoice_date": "2020-01-01 00:00:00"},
        {"stock_code": None},
    )
    found = star.dim_product(df, run_ts)
    assert column(found, "product_id", "stock_code", "description", "product_category") == [
        ("P1", "P1", "old mug", "OTHER")
    ]


def test_dates_are_calendar_days(spark, run_ts):
    texts = ["2020-01-04 01:00:00", "2020-01-04 23:00:00", "2020-01-06 00:00:00", "bad"]
    found = star.dim_date(processed(spark, *[{"invoice_date": t} for t in texts]), run_ts)
    got = column(found.drop("created_at"), *found.columns[:-1], order=["date_id"])
    assert got == [
        (20200104, dt.date(2020, 1, 4), 2020, 1, 4, 1, 5, "Saturday", "January", 1),
        (20200106, dt.date(2020, 1, 6), 2020, 1, 6, 1, 0, "Monday", "January", 0),
    ]


def test_countries_are_numbered_by_name(spark, run_ts):
    df = processed(spark, {"country": "Japan"}, {"country": "EIRE"}, {"country": "Japan"}, {"country": None})
    found = star.dim_country(df, run_ts)
    assert column(found, "country_id", "country_name", "region", order=["country_id"]) == [
        (1, "EIRE", "Other"), (2, "Japan", "Asia"),
    ]


CASES = [
    {"invoice_no": "ok"},
    {"invoice_no": "undated", "invoice_date": "bad"},
    {"invoice_no": "no customer", "customer_id": None},
    {"invoice_no": "empty customer", "customer_id": ""},
    {"invoice_no": "empty product", "stock_code": ""},
    {"invoice_no": "no country", "country": None},
    {"invoice_no": "empty country", "country": ""},
]


@pytest.mark.parametrize("max_broadcast_bytes", [0, 10_000])
def test_facts_need_all_keys(spark, run_ts, max_broadcast_bytes):
    df = processed(spark, *CASES)
    facts, *dims = build(df, run_ts)
    assert sorted(column(facts, "invoice_no")) == ["empty country", "ok"]
    looked_up = star.fact_sales_lookup(df, dims[0], dims[1], dims[2], dims[3], run_ts, max_broadcast_bytes)
    assert same_rows(facts, looked_up)


def test_lookup_drops_lines_absent_from_a_dimension(spark, run_ts):
    df = processed(spark, {"customer_id": "a"}, {"customer_id": "b"})
    _, customers, dates, products, countries = build(df, run_ts)
    some = customers.where("customer_id = 'a'")
    facts = star.fact_sales_lookup(df, some, dates, products, countries, run_ts)
    assert column(facts, "customer_id") == ["a"]


def test_facts_default_to_valid(spark, run_ts):
    df = processed(spark, {}).drop("is_valid")
    facts, *_ = build(df, run_ts)
    assert column(facts, "is_valid") == [1]


def test_dense_numbers_follow_the_line_order(spark):
    rows = [{"invoice_no": f"{i:03}", "invoice_date": f"2020-01-{1 + i % 28:02} 00:00:00"} for i in range(200)]
    numbered = star.number_lines(processed(spark, *rows).repartition(7))
    got = column(numbered, "fact_id", "invoice_date", "invoice_no", order=["fact_id"])
    assert [g[0] for g in got] == list(range(1, 201))
    assert [g[1:] for g in got] == sorted(g[1:] for g in got)


def test_key_checks_find_violations(spark, run_ts):
    df = processed(spark, {"customer_id": "a"}, {"customer_id": "b"})
    facts, customers, dates, products, countries = build(df, run_ts)
    clean = star.key_checks(facts, customers, dates, products, countries)
    assert clean.count() == 11 and set(column(clean, "violations")) == {0}
    broken = star.key_checks(
        facts, customers.where("customer_id = 'a'"), dates, products.union(products),
        countries.withColumn("country_name", F.lit(None).cast("string")),
    )
    found = {(c, t, k) for c, t, k, v in column(broken, *broken.columns) if v}
    assert found == {
        ("foreign key", "fact_sales", "customer_id"),
        ("primary key", "dim_product", "product_id"),
        ("not null", "dim_country", "country_name"),
    }


def test_months_are_ordered_by_number(spark, run_ts):
    df = processed(
        spark, {"invoice_date": "2020-02-01 00:00:00"}, {"invoice_date": "2020-01-01 00:00:00"},
        {"invoice_date": "2019-12-01 00:00:00"},
    )
    facts, _, dates, *_ = build(df, run_ts)
    months = [r["month_name"] for r in analytics.sales_trends_by_month(facts, dates).collect()]
    assert months == ["December", "January", "February"]


def test_analyses_leave_invalid_facts_out(spark, run_ts):
    df = processed(
        spark, {"invoice_no": "1", "quantity": 2, "unit_price": 3}, {"invoice_no": "2", "unit_price": 99},
    ).withColumn("is_valid", F.when(F.col("invoice_no") == "1", 1).otherwise(0))
    facts, customers, dates, products, countries = build(df, run_ts)
    assert analytics.top_countries(facts, countries).collect() == [("France", 1, 6.0, 3.0)]
    assert analytics.customer_segment_analysis(facts, customers).collect() == [("Low", 1, 1, 6.0, 6.0)]
    assert analytics.top_products(facts, products).collect() == [("P1", "RED MUG", 1, 6.0, 3.0)]
    assert analytics.month_totals(facts, dates).collect() == [(2020, "January", 6.0)]


def test_top_countries_are_ten(spark, run_ts):
    df = processed(spark, *[{"country": f"C{i:02}", "quantity": i} for i in range(15)])
    facts, _, _, _, countries = build(df, run_ts)
    top = analytics.top_countries(facts, countries).collect()
    assert [r["country_name"] for r in top] == [f"C{i:02}" for i in range(14, 4, -1)]
    assert analytics.country_totals(facts, countries).count() == 15


def test_star_stats(spark, run_ts):
    df = processed(spark, {"customer_id": "a"}, {"customer_id": "b"})
    stats = dict(column(profile.star_stats(*build(df, run_ts)), "stat", "value"))
    assert stats == {
        "fact_sales_count": 2, "valid_facts_count": 2, "invalid_facts_count": 0,
        "dim_customer_count": 2, "dim_date_count": 1, "dim_product_count": 1, "dim_country_count": 1,
    }


def test_segments_feed_the_customer_dimension(spark, run_ts):
    rows = [{"customer_id": str(i), "unit_price": t} for i, t in enumerate([-5, 0, 3, 7, 20, 30])]
    df = add_product_category(add_segments(lines(spark, *rows)))
    found = column(star.dim_customer(df, run_ts), "customer_segment", order=["customer_id"])
    assert found == [None, None, "Medium", "Medium", "High", "High"]


@pytest.mark.parametrize("files", [1, 5])
def test_files_show_that_ids_are_unique(spark, tmp_path, files):
    def stored(ids, name):
        path = f"{tmp_path}/{name}-{files}"
        spark.createDataFrame([(i,) for i in ids], "fact_id long").coalesce(files).write.parquet(path)
        return spark.read.parquet(path)

    in_order = spark.range(0, 1000, 1, files).withColumnRenamed("id", "fact_id")
    in_order.write.parquet(f"{tmp_path}/order-{files}")
    assert star.unique_by_runs(spark.read.parquet(f"{tmp_path}/order-{files}"), "fact_id")
    assert star.unique_by_runs(stored([5, 6, 7, 1, 2, 3], "parts"), "fact_id")
    assert star.unique_by_runs(stored([9, 7, 5], "reversed"), "fact_id")
    assert star.unique_by_runs(stored([], "empty"), "fact_id")
    for ids in ([1, 2, 3, 3], [1, 2, 2, 3], [1, 2, 3, 1, 2], [4, 5, 6, 5], [1, None], [None]):
        assert not star.unique_by_runs(stored(ids, "bad" + "-".join(map(str, ids))), "fact_id")
    # Not from files: it cannot be told.
    assert not star.unique_by_runs(spark.range(5).select(F.lit(1).alias("fact_id")).union(spark.range(2)), "fact_id")


def test_a_planted_repeat_is_counted(spark, run_ts, tmp_path):
    facts, *dims = build(processed(spark, *[{"invoice_no": str(i)} for i in range(20)]), run_ts)
    facts.write.parquet(f"{tmp_path}/facts")
    facts.where("fact_id = 7").write.mode("append").parquet(f"{tmp_path}/facts")
    checks = star.key_checks(spark.read.parquet(f"{tmp_path}/facts"), *dims)
    assert column(checks.where("column_name = 'fact_id'"), "violations") == [2]


def test_stored_ids_are_checked_without_a_shuffle_of_facts(spark, run_ts, tmp_path):
    facts, *dims = build(processed(spark, *[{"invoice_no": str(i)} for i in range(20)]), run_ts)
    facts.write.parquet(f"{tmp_path}/facts")
    checks = star.key_checks(spark.read.parquet(f"{tmp_path}/facts"), *dims)
    assert column(checks, "violations") == [0] * checks.count()
    plan = checks._jdf.queryExecution().optimizedPlan().toString()
    assert "Aggregate [customer_id" in plan and "Aggregate [fact_id" not in plan


def test_lookups_shuffle_only_what_facts_need(spark, run_ts, monkeypatch):
    seen, looked_up = [], star._looked_up

    def watched(lines, counted, *others):
        seen.append(set(lines.columns) | set(counted.columns))
        return looked_up(lines, counted, *others)

    monkeypatch.setattr(star, "_looked_up", watched)
    processed = batch.process(raw(spark, {"customer_id": "1"}, {"customer_id": "2", "quantity": 2}, {"customer_id": "3", "quantity": 3}), run_ts)
    dims = [build(processed, run_ts) for build in (star.dim_customer, star.dim_date, star.dim_product, star.dim_country)]
    facts = star.fact_sales_lookup(processed, *dims, run_ts, 0)
    assert facts.count() == 3 and len(seen) == 4
    assert not set().union(*seen) & {"created_at", "invoice_year", "customer_segment", "product_category"}
