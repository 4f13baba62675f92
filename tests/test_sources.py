from decimal import Decimal

import pytest
from pyspark.errors import AnalysisException

from tests.frames import column, raw, same_rows
from tillstar import schemas
from tillstar.operators import scratch
from tillstar.sources import csv, feed
from tillstar.sources import layers as L
from tillstar.sources.reports import read_report, write_report


def test_csv_columns_are_found_by_name(spark, tmp_path):
    (tmp_path / "lines.csv").write_text(
        "country,quantity,unit_price,customer_id,note\n"
        '"A, ""B""",6,2.55,017850,x\n'
        "NA,6.0,,17850.0,\n"
        "null,abc,1e1, ,n/a\n"
        '"two\nlines",1,1,  NA ,\n'
    )
    df = csv.read_invoice_csv(spark, str(tmp_path / "lines.csv"))
    types = dict(df.dtypes)
    assert (types["quantity"], types["unit_price"], types["note"]) == ("int", "decimal(18,4)", "string")
    assert column(df, "country", "quantity", "unit_price", "customer_id", "note") == [
        ('A, "B"', 6, Decimal("2.5500"), "017850", "x"),
        (None, 6, None, "17850.0", None),
        (None, None, Decimal("10.0000"), " ", None),
        ("two\nlines", 1, Decimal("1.0000"), "  NA ", None),
    ]


def test_csv_files_must_share_their_header(spark, tmp_path):
    (tmp_path / "a.csv").write_text("invoice_no,country\n1,Italy\n")
    (tmp_path / "b.csv").write_text("invoice_no,country\n2,Spain\n")
    assert csv.read_invoice_csv(spark, str(tmp_path)).count() == 2
    (tmp_path / "c.csv").write_text("country,invoice_no\nItaly,3\n")
    with pytest.raises(Exception, match="header"):
        csv.read_invoice_csv(spark, str(tmp_path)).collect()


def test_csv_may_hold_line_breaks(spark, tmp_path):
    (tmp_path / "lines.csv").write_text('invoice_no,description\n1,"two\nlines"\n')
    df = csv.read_invoice_csv(spark, str(tmp_path / "lines.csv"))
    assert column(df, "invoice_no", "description") == [("1", "two\nlines")]


def test_csv_torn_rows_are_an_error(spark, tmp_path):
    (tmp_path / "lines.csv").write_text('invoice_no,description,country\n1,"two\nlines",Italy\n')
    with pytest.raises(Exception, match="MALFORMED"):
        csv.read_invoice_csv(spark, str(tmp_path / "lines.csv"), multi_line=False).collect()


def test_csv_encoding(spark, tmp_path):
    (tmp_path / "lines.csv").write_bytes("description\nCAFÉ\n".encode("latin-1"))
    df = csv.read_invoice_csv(spark, str(tmp_path / "lines.csv"), encoding="ISO-8859-1")
    assert column(df, "description") == ["CAFÉ"]


def test_layer_modes(spark, layers):
    L.create(spark, layers)
    df = raw(spark, {"invoice_no": "1"}, {"invoice_no": "2"})
    assert same_rows(L.write(df, layers, "raw", "raw_data", "fail"), df)
    assert L.write(df, layers, "raw", "raw_data", "append").count() == 4
    assert L.write(df, layers, "raw", "raw_data").count() == 2
    with pytest.raises(AnalysisException):
        L.write(df, layers, "raw", "raw_data", "fail")


def test_layers_are_listed(spark, layers):
    L.create(spark, layers)
    L.create(spark, layers)
    assert L.list_tables(spark, layers, "raw") == []
    assert not L.has_table(spark, layers, "raw", "raw_data")
    L.write(raw(spark, {}), layers, "raw", "raw_data")
    L.write(raw(spark, {}), layers, "raw", "more")
    assert L.list_tables(spark, layers, "raw") == ["more", "raw_data"]
    assert L.has_table(spark, layers, "raw", "raw_data")


def test_contract_orders_and_types_columns(spark, layers):
    L.create(spark, layers)
    shuffled = raw(spark, {}).select(*reversed(schemas.RAW.fieldNames())).withColumnRenamed("country", "land")
    stored = L.write(shuffled, layers, "raw", "raw_data")
    assert stored.columns == [c for c in schemas.RAW.fieldNames() if c != "country"]


def test_roots_with_equal_names_read_their_own(spark, layers, tmp_path):
    roots = [layers._replace(root=str(tmp_path / x)) for x in ("it's a", "b")]
    for n, root in enumerate(roots, 1):
        L.attach(spark, root)
        assert L.list_tables(spark, root, "raw") == []
        L.write(raw(spark, *[{"invoice_no": str(i)} for i in range(n)]), root, "raw", "raw_data")
    for n, root in enumerate(roots, 1):
        L.attach(spark, root)
        assert L.read(spark, root, "raw", "raw_data").count() == n
        assert spark.table(root.name("raw", "raw_data")).count() == n


def test_attach_finds_stored_tables(spark, layers):
    L.create(spark, layers)
    L.write(raw(spark, {}), layers, "raw", "raw_data")
    other = layers._replace(raw=layers.raw)
    spark.sql(f"DROP TABLE {layers.raw}.raw_data")
    assert not L.has_table(spark, other, "raw", "raw_data")
    L.attach(spark, other)
    assert L.read(spark, other, "raw", "raw_data").count() == 1
    assert not L.has_table(spark, other, "processed", "processed_data")


def test_reports_keep_nulls(spark, tmp_path):
    df = spark.createDataFrame([("a", None)], "x string, y string")
    path = write_report(df, str(tmp_path), "report")
    assert read_report(spark, path).columns == ["x", "y"]
    write_report(df, str(tmp_path), "report")


def test_scratch_folder_is_the_checkpoint_folder(spark):
    root = spark.conf.get("spark.checkpoint.dir")
    assert scratch.scratch_root(spark) == root.rstrip("/")
    stored = scratch.materialize(spark.range(3), "test")
    assert f"{root.rstrip('/')}/tillstar/test-" in stored.inputFiles()[0]
    assert stored.count() == 3


def test_scratch_folder_is_never_guessed_on_a_cluster():
    class Session:
        class conf:
            get = staticmethod({"spark.master": "yarn"}.get)

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        scratch.scratch_root(Session)


def test_feed_joins_are_independent_of_size(spark, monkeypatch):
    sf_dir = "/root/testdata/sf0.001"
    plain = feed.invoice_lines(spark, sf_dir)
    monkeypatch.setattr(feed, "is_small", lambda df: False)
    spread = feed.invoice_lines(spark, sf_dir)
    assert plain.schema == schemas.RAW or plain.columns == schemas.RAW.fieldNames()
    assert same_rows(plain, spread)
