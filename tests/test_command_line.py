import os
import subprocess
import sys

import pytest

import tillstar
from tests.frames import column
from tillstar.__main__ import main
from tillstar.sources import layers as L
from tillstar.sources.reports import read_report

LINES = """invoice_no,stock_code,description,quantity,invoice_date,unit_price,customer_id,country
1,P1,WHITE HANGING HEART,6,12/1/2010 8:26,2.55,a,United Kingdom
1,P1,WHITE HANGING HEART,6,12/1/2010 8:26,2.55,a,United Kingdom
2,P2,JUMBO BAG,2,1/5/2011 9:00,10,b,Japan
3,P2,JUMBO BAG,9,bad,10,c,Japan
4,P3,,1,1/6/2011 9:00,40,d,France
"""


def drop_tables(spark, layers):
    for layer, tables in L.TABLES.items():
        for table in tables:
            spark.sql(f"DROP TABLE IF EXISTS {layers.name(layer, table)}")


def test_build_twice_and_report(spark, tmp_path):
    source, root = tmp_path / "lines.csv", str(tmp_path / "warehouse")
    source.write_text(LINES)
    layers = L.Layers(root)
    for _ in range(2):
        main(["build", root, "--source", str(source)])
        facts = L.read(spark, layers, "warehouse", "fact_sales")
        assert sorted(column(facts, "invoice_no")) == ["1", "2", "4"]
        # A new session's catalog does not know the tables that are on storage.
        drop_tables(spark, layers)
    main(["report", root])
    found = read_report(spark, f"{root}/reports/validation_results").first()
    assert found["raw_data"]["raw_data_stats"]["total_rows"] == 5
    # The price of line 4 is an outlier, so France has no valid sales.
    top = found["star_schema"]["insights"]["top_countries"]
    assert [(c["country_name"], c["total_sales"]) for c in top] == [("Japan", 20.0), ("United Kingdom", 15.3)]
    drop_tables(spark, layers)


def test_the_command_starts_by_its_path(tmp_path):
    script = os.path.join(os.path.dirname(tillstar.__file__), "__main__.py")
    (tmp_path / "lines.csv").write_text(LINES)
    command = [sys.executable, script, "build", str(tmp_path / "w"), "--source", str(tmp_path / "lines.csv")]
    env = os.environ | {"PYSPARK_SUBMIT_ARGS": "--master local[2] --conf spark.ui.enabled=false pyspark-shell"}
    subprocess.run(command, check=True, cwd=tmp_path, env=env, timeout=300)
    assert list((tmp_path / "w" / "data_warehouse" / "fact_sales").glob("*.parquet"))


def test_build_needs_a_source(spark, tmp_path):
    with pytest.raises(SystemExit):
        main(["build", str(tmp_path)])


def test_loads_are_added(spark, tmp_path):
    from tillstar.plans import load

    root = str(tmp_path / "star")
    (tmp_path / "one.csv").write_text(LINES)
    (tmp_path / "two.csv").write_text(LINES.splitlines()[0] + "\n" + "".join(
        f"{n},P{n % 3 + 1},NEW,{n},2/{n}/2011 9:00,{n},{c},Italy\n" for n, c in ((5, "a"), (6, "d"), (7, "e"))
    ))
    for name in ("one", "two", "two"):
        main(["load", root, "--source", str(tmp_path / f"{name}.csv"), "--name", name])
    tables = load.tables(spark, root)
    assert column(tables["fact_sales"], "fact_id", "invoice_no", order=["fact_id"]) == [
        (1, "1"), (2, "2"), (3, "4"), (4, "5"), (5, "6"), (6, "7"),
    ]
    assert column(tables["dim_customer"], "customer_id", "country", order=["customer_id"]) == [
        ("a", "United Kingdom"), ("b", "Japan"), ("c", "Japan"), ("d", "France"), ("e", "Italy"),
    ]
    with pytest.raises(SystemExit):
        main(["load", root, "--source", str(tmp_path / "one.csv")])
