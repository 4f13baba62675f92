import time

import pytest
from pyspark.sql import functions as F

from tests.frames import column, same_rows
from tillstar import schemas
from tillstar.operators import ranges, rolling, scratch, transform
from tillstar.operators.clean import clean
from tillstar.plans import batch, quality, star
from tillstar.sources import feed, versions
from tillstar.sources import layers as L
from tillstar.sources.reports import read_report, write_report

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def raw_lines(spark):
    return feed.invoice_lines(spark, SF)


@pytest.fixture(scope="module")
def built(spark, raw_lines, tmp_path_factory):
    from datetime import datetime

    layers = L.Layers(str(tmp_path_factory.mktemp("built")), "b_raw", "b_processed", "b_star")
    return batch.run(spark, raw_lines, layers, datetime(2024, 1, 1), source="order tables")


def test_tables_follow_their_contracts(spark, built):
    for layer, tables in L.TABLES.items():
        assert L.list_tables(spark, built, layer) == sorted(tables)
        for table, contract in tables.items():
            stored = L.read(spark, built, layer, table)
            assert [(f.name, f.dataType) for f in stored.schema] == [(f.name, f.dataType) for f in contract]


def test_second_run_gives_the_same_warehouse(spark, built, raw_lines, tmp_path, run_ts):
    layers = L.Layers(str(tmp_path), "twice_raw", "twice_processed", "twice_star")
    for _ in range(2):
        batch.run(spark, raw_lines, layers, run_ts, profiles=False)
    for layer, tables in L.TABLES.items():
        for table in tables:
            ours, first = (L.read(spark, x, layer, table) for x in (layers, built))
            assert same_rows(ours, first)


def test_result_does_not_depend_on_order_or_partitions(spark, built, raw_lines, run_ts):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "13")
    try:
        shuffled = raw_lines.orderBy(F.reverse("description"), "invoice_no").repartition(3)
        stored = L.read(spark, built, "processed", "processed_data")
        assert same_rows(transform.transform(clean(shuffled, run_ts)), stored)
        processed = batch.process(shuffled, run_ts, block_rows=10)
        assert same_rows(processed, stored)
        countries = L.read(spark, built, "warehouse", "dim_country")
        facts = L.read(spark, built, "warehouse", "fact_sales")
        assert same_rows(star.fact_sales(processed, countries, run_ts), facts)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_keys_hold(spark, built):
    tables = quality.warehouse_tables(spark, built)
    assert set(column(star.key_checks(*quality.star_tables(tables)), "violations")) == {0}


def test_facts_are_the_dated_lines(spark, built):
    processed = L.read(spark, built, "processed", "processed_data")
    dated = processed.where("invoice_date is not null and customer_id <> '' and stock_code <> ''")
    assert L.read(spark, built, "warehouse", "fact_sales").count() == dated.count() < processed.count()


def test_batch_writes_its_reports(spark, built):
    report = lambda name: read_report(spark, f"{built.root}/reports/{name}")
    summary = report("pipeline_summary").first()
    assert (summary["pipeline_status"], summary["timestamp"]) == ("Completed", "2024-01-01T00:00:00")
    assert summary["layers"]["warehouse_schema"] == "b_star"
    assert summary["data_source"] == "order tables"
    assert summary["fact_rows"] == L.read(spark, built, "warehouse", "fact_sales").count()
    columns = report("processed_columns").orderBy("position").collect()
    assert [(r["column_name"], r["data_type"]) for r in columns] == L.read(spark, built, "processed", "processed_data").dtypes
    assert report("input_check").count() == len(schemas.RAW)
    assert report("processed_shape").first()["columns"] == len(schemas.PROCESSED)
    assert report("numeric_summary").count() == 12
    counts = spark.read.parquet(f"{built.root}/reports/categorical_summary")
    assert counts.where("column_name = 'country'").count() == 25


def test_quality_reports(spark, built, run_ts):
    paths = quality.run(spark, built, run_ts)
    validation = read_report(spark, paths["validation_results"]).first()
    assert validation["raw_data"]["tables"] == ["raw_data"]
    rows = validation["raw_data"]["raw_data_stats"]["total_rows"]
    assert rows == L.read(spark, built, "raw", "raw_data").count()
    insights = validation["star_schema"]["insights"]
    assert len(insights["top_countries"]) == 10
    sales = [r["total_sales"] for r in insights["top_countries"]]
    assert sales == sorted(sales, reverse=True)
    months = [(r["year"], r["month"]) for r in insights["monthly_trends"]]
    assert months == sorted(months)
    report = read_report(spark, paths["data_quality_report"]).first()
    assert report["recommendations"] == ["Negative amounts found - implement data validation rules"]
    assert report["data_completeness"] == validation["data_quality"]["data_completeness"]
    samples = read_report(spark, paths["sample_queries_results"]).first()
    assert len(samples["top_products_by_sales"]) == 10
    assert "month" not in samples["sales_trends_by_month"][0]


def test_validation_skips_absent_tables(spark, layers, run_ts, built):
    # A warehouse without raw and processed tables still reports on what is there.
    partial = built._replace(raw=layers.raw)
    L.create(spark, layers)
    row = quality.validation_report(spark, partial, run_ts).first()
    assert row["raw_data"].asDict() == {"tables": []}
    assert row["processed_data"]["tables"] == ["processed_data"]


def test_batch_leaves_no_scratch(spark, raw_lines, tmp_path, run_ts, monkeypatch):
    monkeypatch.setattr(scratch, "scratch_root", lambda spark: str(tmp_path / "scratch"))
    layers = L.Layers(str(tmp_path / "w"), "s_raw", "s_processed", "s_star")
    batch.run(spark, raw_lines, layers, run_ts, profiles=False)
    assert [p for p in (tmp_path / "scratch").rglob("*") if p.is_file()] == []


@pytest.mark.parametrize("kind", ["date", "timestamp"])
def test_typed_dates_give_all_facts(spark, raw_lines, tmp_path, run_ts, kind):
    lines = raw_lines.where("invoice_date <> 'not-a-date'")
    typed = lines.withColumn("invoice_date", F.col("invoice_date").cast(kind))
    layers = L.Layers(str(tmp_path), f"{kind}_raw", f"{kind}_processed", f"{kind}_star")
    batch.run(spark, typed, layers, run_ts, profiles=False)
    processed = L.read(spark, layers, "processed", "processed_data")
    assert L.read(spark, layers, "warehouse", "fact_sales").count() == processed.count() > 0


@pytest.mark.parametrize("absent, gone", [
    ("unit_price", {"unit_price", "total_amount", "customer_segment", "rolling_7d_sales"}),
    ("description", {"description", "product_category"}),
])
def test_absent_columns_skip_their_steps(spark, raw_lines, tmp_path, run_ts, absent, gone):
    layers = L.Layers(str(tmp_path), f"{absent}_r", f"{absent}_p", f"{absent}_s")
    batch.run(spark, raw_lines.drop(absent), layers, run_ts, profiles=False)
    stored = L.read(spark, layers, "processed", "processed_data")
    assert set(schemas.PROCESSED.fieldNames()) - set(stored.columns) == gone
    assert L.read(spark, layers, "warehouse", "fact_sales").count() > 0


def test_star_names_the_columns_it_needs(spark, raw_lines, tmp_path, run_ts):
    layers = L.Layers(str(tmp_path), "c_raw", "c_processed", "c_star")
    with pytest.raises(ValueError, match="country"):
        batch.run(spark, raw_lines.drop("country"), layers, run_ts, profiles=False)
    assert "country" not in L.read(spark, layers, "processed", "processed_data").columns


def test_sql_text(spark, built):
    found = L.run_sql(
        spark,
        """SELECT dc.country_name, SUM(fs.total_amount) AS total_sales
           FROM b_star.fact_sales fs JOIN b_star.dim_country dc ON fs.country_id = dc.country_id
           WHERE fs.is_valid = 1 GROUP BY dc.country_name ORDER BY total_sales DESC""",
    )
    assert found.count() == 25


def test_approximate_statistics_run(spark, raw_lines, run_ts):
    processed = transform.transform(clean(raw_lines, run_ts, accuracy=100), accuracy=100)
    assert processed.where("is_valid = 1").count() > 0


def test_repeats_are_dropped_by_the_shuffle_that_sorts(spark, raw_lines):
    """One shuffle of whole lines, and the order holds whatever the types."""
    names = ["country", "invoice_date", "invoice_no", "stock_code", "description", "quantity", "unit_price", "customer_id"]
    for lines in (raw_lines, raw_lines.withColumn("unit_price", F.col("unit_price").cast("double"))):
        order = [F.col("country").asc(), *rolling.line_order(lines)]
        df = lines.repartition(5).localCheckpoint()
        plan = ranges._distinct(df, order, names)._jdf.queryExecution().executedPlan().toString()
        assert plan.count("rangepartitioning") == 1 and "hashpartitioning" not in plan
        sorted_ = rolling.sort_distinct_by_country(df)
        assert same_rows(sorted_.drop(ranges.RANGE, ranges.ROW), df.distinct())
        placed = column(sorted_, *names, order=[ranges.RANGE, ranges.ROW])
        assert placed == column(df.distinct(), *names, order=order)


def test_equal_doubles_of_two_signs_are_one_line(spark, raw_lines):
    lines = raw_lines.limit(50).withColumn("unit_price", F.lit(0.0)).localCheckpoint()
    both = lines.union(lines.withColumn("unit_price", F.lit(-0.0)))
    assert rolling.sort_distinct_by_country(both).count() == lines.distinct().count()


def _shuffle_files(spark):
    manager = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    return {f for f in manager.getAllFiles().mkString("|").split("|") if "shuffle_" in f}


def test_writes_leave_no_shuffle_files(spark, tmp_path, layers):
    """They would lie on the disks until the driver collects its garbage."""
    L.create(spark, layers)
    before, conf = _shuffle_files(spark), spark.conf.get(scratch._CLEANUP)
    df = spark.range(1000).repartition(3, "id")
    scratch.materialize(df, "kept")
    L.write(df, layers, "raw", "other")
    versions.add(spark, str(tmp_path), "some", df)
    write_report(df.groupBy().count(), str(tmp_path), "report")
    until = time.time() + 20
    while (left := _shuffle_files(spark) - before) and time.time() < until:
        time.sleep(0.2)
    assert not left
    assert spark.conf.get(scratch._CLEANUP) == conf


def test_stages_drop_their_scratch_before_the_next(spark, raw_lines, tmp_path, run_ts, monkeypatch):
    """The range-sorted lines, as many as the processed ones, are gone when the star is built."""
    monkeypatch.setattr(scratch, "scratch_root", lambda spark: str(tmp_path / "scratch"))
    seen, fact_sales = [], star.fact_sales

    def watched(*given):
        seen.append([p.name for p in (tmp_path / "scratch").rglob("*-*") if p.is_dir()])
        return fact_sales(*given)

    monkeypatch.setattr(star, "fact_sales", watched)
    layers = L.Layers(str(tmp_path / "w"), "g_raw", "g_processed", "g_star")
    batch.run(spark, raw_lines, layers, run_ts, profiles=False)
    (names,) = seen
    assert not [name for name in names if name.startswith(("country-ranges", "customer-totals"))]


def test_sorted_facts_store_only_fact_columns(spark, built, run_ts, tmp_path, monkeypatch):
    monkeypatch.setattr(scratch, "scratch_root", lambda spark: str(tmp_path))
    processed = L.read(spark, built, "processed", "processed_data")
    countries = L.read(spark, built, "warehouse", "dim_country")
    facts = star.fact_sales(processed, countries, run_ts)
    assert same_rows(facts, L.read(spark, built, "warehouse", "fact_sales"))
    (stored,) = (tmp_path / "tillstar").glob("facts-*")
    assert not {"description", "invoice_date", "country", "product_category", "created_at"} & set(spark.read.parquet(str(stored)).columns)
