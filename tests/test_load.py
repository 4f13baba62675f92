"""Loads: merged dimensions, appended facts, versions."""

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tests.frames import column, same_rows
from tests.test_star import build, processed
from tillstar.plans import load
from tillstar.sources import versions

LATER = datetime(2024, 1, 2)


@pytest.fixture
def root(tmp_path):
    return str(tmp_path / "star")


def lines(spark, *rows):
    """Lines from (customer, date, country, product, description)."""
    names = ("customer_id", "invoice_date", "country", "stock_code", "description")
    return processed(spark, *[{**dict(zip(names, r)), "invoice_no": str(i)} for i, r in enumerate(rows)])


FIRST = [
    ("a", "2020-01-02 00:00:00", "Italy", "P1", "MUG"), ("b", "2020-01-02 00:00:00", "Spain", "P2", None),
    ("c", "bad", "Peru", "P1", "MUG"), ("a", "2020-01-03 00:00:00", "Spain", "P1", "CUP"),
]
SECOND = [
    ("a", "2020-01-01 00:00:00", "Chile", "P2", None), ("b", "2020-01-04 00:00:00", "Aland", "P3", "BOX"),
    ("c", "2020-01-05 00:00:00", "Peru", "P1", "JUG"), ("d", "2020-01-05 00:00:00", "Italy", "P3", "BOX"),
]


def test_two_loads_are_one(spark, root, run_ts):
    first, second = lines(spark, *FIRST), lines(spark, *SECOND)
    load.append(spark, first, root, "one", run_ts)
    version = load.append(spark, second, root, "two", run_ts)
    assert (version.number, version.loads) == (2, {"one": {"facts": 3, "version": 1}, "two": {"facts": 4, "version": 2}})
    tables = load.tables(spark, root)
    facts, customers, dates, products, countries = build(first.unionByName(second), run_ts)
    times = [c for c in ("created_at", "updated_at")]
    for name, whole in (("dim_customer", customers), ("dim_date", dates), ("dim_product", products)):
        assert same_rows(tables[name].drop(*times), whole.drop(*times))
    # Numbers of countries and facts tell in which load they came.
    assert column(tables["dim_country"], "country_id", "country_name", order=["country_id"]) == [
        (1, "Italy"), (2, "Peru"), (3, "Spain"), (4, "Aland"), (5, "Chile"),
    ]
    assert same_rows(tables["dim_country"].select("country_name", "region"), countries.select("country_name", "region"))
    assert column(tables["fact_sales"], "fact_id", order=["fact_id"]) == [1, 2, 3, 4, 5, 6, 7]
    assert column(tables["fact_sales"], "customer_id", "date_id", order=["fact_id"])[2:4] == [("a", 20200103), ("a", 20200101)]

    def named(facts, countries):
        return facts.join(countries.select("country_id", "country_name"), "country_id").drop("fact_id", "country_id")

    assert same_rows(named(tables["fact_sales"], tables["dim_country"]), named(facts, countries))


def test_times_move_on_change_only(spark, root, run_ts):
    load.append(spark, lines(spark, *FIRST), root, "one", run_ts)
    load.append(spark, lines(spark, *SECOND), root, "two", LATER)
    tables = load.tables(spark, root)
    assert column(tables["dim_customer"], "customer_id", "country", "created_at", "updated_at", order=["customer_id"]) == [
        ("a", "Chile", run_ts, LATER), ("b", "Spain", run_ts, run_ts), ("c", "Peru", run_ts, run_ts),
        ("d", "Italy", LATER, LATER),
    ]
    assert column(tables["dim_product"], "product_id", "created_at", order=["product_id"]) == [
        ("P1", run_ts), ("P2", run_ts), ("P3", LATER),
    ]
    assert column(tables["fact_sales"], "created_at", order=["fact_id"]) == [run_ts] * 3 + [LATER] * 4


def test_a_load_of_a_known_name_adds_nothing(spark, root, run_ts):
    first = load.append(spark, lines(spark, *FIRST), root, "one", run_ts)
    assert load.append(spark, lines(spark, *SECOND), root, "one", LATER) == first
    assert load.tables(spark, root)["fact_sales"].count() == 3


def test_empty_loads(spark, root, run_ts):
    nothing = lines(spark, *FIRST).where("false")
    load.append(spark, nothing, root, "none", run_ts)
    assert load.tables(spark, root)["fact_sales"].count() == 0
    load.append(spark, lines(spark, *FIRST), root, "one", run_ts)
    version = load.append(spark, nothing, root, "more", LATER)
    assert version.loads["more"]["facts"] == 0
    assert column(load.tables(spark, root)["dim_customer"], "updated_at") == [run_ts] * 3


@pytest.mark.parametrize("stop", ["commit", "facts"])
def test_a_run_that_stops_halfway_changes_nothing(spark, root, run_ts, monkeypatch, stop):
    load.append(spark, lines(spark, *FIRST), root, "one", run_ts)
    before = {name: df.collect() for name, df in load.tables(spark, root).items()}

    def fail(*_, **__):
        raise OSError("stopped")

    with monkeypatch.context() as patch:
        patch.setattr(load.versions, "commit", fail) if stop == "commit" else patch.setattr(load.star, "fact_sales", fail)
        with pytest.raises(OSError, match="stopped"):
            load.append(spark, lines(spark, *SECOND), root, "two", LATER)
    assert {name: df.collect() for name, df in load.tables(spark, root).items()} == before
    # The same load can be tried again.
    assert load.append(spark, lines(spark, *SECOND), root, "two", LATER).number == 2
    assert load.tables(spark, root)["fact_sales"].count() == 7


def test_earlier_versions_stay_readable(spark, root, run_ts):
    load.append(spark, lines(spark, *FIRST), root, "one", run_ts)
    load.append(spark, lines(spark, *SECOND), root, "two", LATER)
    assert load.tables(spark, root, 1)["fact_sales"].count() == 3
    assert column(load.tables(spark, root, 1)["dim_customer"], "country", order=["customer_id"]) == ["Italy", "Spain", "Peru"]


def test_two_runs_cannot_commit_one_version(spark, root):
    version = versions.Version(1, {"t": ["x"]}, {})
    assert versions.commit(spark, root, version) == versions.current(spark, root)
    with pytest.raises(RuntimeError, match="another run"):
        versions.commit(spark, root, version)
    assert versions.current(spark, root) == version


def test_merge_takes_null_as_equal_and_keeps_what_is_not_fresh(spark, run_ts):
    schema = "id string, x string, y int, created_at timestamp_ntz, updated_at timestamp_ntz"
    stored = spark.createDataFrame(
        [("same", None, 1, run_ts, run_ts), ("other", "a", None, run_ts, run_ts), ("gone", "g", 3, run_ts, run_ts)], schema
    )
    fresh = spark.createDataFrame(
        [("same", None, 1, LATER, LATER), ("other", None, None, LATER, LATER), ("new", None, None, LATER, LATER)], schema
    )
    merged = load.merge_dimension(stored, fresh, "id", LATER)
    assert merged.columns == stored.columns
    assert column(merged, *merged.columns, order=["id"]) == [
        ("gone", "g", 3, run_ts, run_ts), ("new", None, None, LATER, LATER),
        ("other", None, None, run_ts, LATER), ("same", None, 1, run_ts, run_ts),
    ]
    again = load.merge_dimension(merged, fresh, "id", LATER + timedelta(days=1))
    assert same_rows(again, merged)


def test_columns_without_which_there_is_no_star(spark, root, run_ts):
    with pytest.raises(ValueError, match="country"):
        load.append(spark, lines(spark, *FIRST).drop("country"), root, "one", run_ts)
    assert versions.current(spark, root).number == 0


def test_many_loads_number_on(spark, root, run_ts):
    for k in range(4):
        load.append(spark, lines(spark, *FIRST), root, f"load {k}", run_ts)
    facts = load.tables(spark, root)["fact_sales"]
    assert column(facts, "fact_id", order=["fact_id"]) == list(range(1, 13))
    assert facts.agg(F.countDistinct("customer_id")).first()[0] == 2
