"""CSV files with line breaks in cells, read in byte ranges."""

import csv
import io
import random

import pytest

from tests.frames import column
from tillstar.sources.csv import read_invoice_csv
from tillstar.sources.records import read_records, records


@pytest.fixture
def small_ranges(spark):
    """Byte ranges of so many bytes."""
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes", "spark.sql.files.minPartitionNum")
    before = {name: spark.conf.get(name, None) for name in names}

    def use(size):
        spark.conf.set(names[0], size)
        spark.conf.set(names[1], 0)
        spark.conf.set(names[2], 1)

    yield use
    for name, value in before.items():
        spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def written(rows, end="\n", header=("a", "b", "c")):
    out = io.StringIO(newline="")
    writer = csv.writer(out, lineterminator=end)
    writer.writerows([header, *rows])
    return out.getvalue()


def cells(seed, n):
    r = random.Random(seed)
    parts = ["x", "plain text", '"', '""', "\n", "\n\n", ",", "é日", 'say "yes"\n"no"', " ", "'", "\\", "\r\n"]
    return [[str(k), *("".join(r.choices(parts, k=r.randrange(4))) for _ in range(2))] for k in range(n)]


@pytest.mark.parametrize("size", [7, 64, 1000, 10**6])
def test_any_range_size_gives_the_same_rows(spark, tmp_path, small_ranges, size):
    rows = cells(size, 120)
    (tmp_path / "lines.csv").write_text(written(rows), newline="")
    small_ranges(size)
    found = read_records(spark, str(tmp_path))
    assert sorted((a, b or "", c or "") for a, b, c in column(found, "a", "b", "c")) == sorted(map(tuple, rows))


def test_a_file_is_read_by_many_tasks(spark, tmp_path, small_ranges):
    rows = [[str(k), f"line one of {k}\nline two, \"quoted\"", "end"] for k in range(2000)]
    (tmp_path / "lines.csv").write_text(written(rows))
    small_ranges(4096)
    path = str(tmp_path / "lines.csv")
    found = read_records(spark, path)
    assert found.rdd.getNumPartitions() > 10
    assert sorted(map(tuple, found.collect())) == sorted(map(tuple, rows))
    # As Spark's own reader has it, in one task.
    plain = spark.read.csv(path, header=True, multiLine=True, quote='"', escape='"')
    assert plain.exceptAll(found).isEmpty() and found.exceptAll(plain).isEmpty()


def test_a_cell_may_span_many_ranges(spark, tmp_path, small_ranges):
    long = "\n".join(f"line {k}" for k in range(500))
    rows = [["1", long, "x"], ["2", "", long], ["3", "b", "c"]]
    (tmp_path / "lines.csv").write_text(written(rows))
    small_ranges(50)
    assert sorted(column(read_records(spark, str(tmp_path)), "a", "b", "c"))[0] == ("1", long, "x")
    assert column(read_records(spark, str(tmp_path)), "a", order=["a"]) == ["1", "2", "3"]


@pytest.mark.parametrize("size", [10, 10**6])
def test_line_ends_marks_and_blank_lines(spark, tmp_path, small_ranges, size):
    text = "\ufeffa,b,c\r\n1,\"two\r\nlines\",x\r\n\r\n2,y,z\r\n"
    (tmp_path / "lines.csv").write_bytes(text.encode())
    (tmp_path / "more.csv").write_bytes(b"a,b,c\n3,p,q")
    (tmp_path / "empty.csv").write_bytes(b"")
    (tmp_path / "header.csv").write_bytes(b"a,b,c\n")
    small_ranges(size)
    found = column(read_records(spark, str(tmp_path)), "a", "b", "c", order=["a"])
    assert found == [("1", "two\r\nlines", "x"), ("2", "y", "z"), ("3", "p", "q")]


@pytest.mark.parametrize("size", [12, 10**6])
def test_a_quote_that_is_not_closed_is_an_error(spark, tmp_path, small_ranges, size):
    (tmp_path / "lines.csv").write_text('a,b\n1,x\n2,"open\n3,y\n4,z\n')
    small_ranges(size)
    with pytest.raises(Exception, match="never closed"):
        read_records(spark, str(tmp_path)).collect()


def test_broken_rows_and_headers_are_errors(spark, tmp_path):
    (tmp_path / "lines.csv").write_text('a,b\n1,"x\ny"\n2\n')
    with pytest.raises(Exception, match="MALFORMED"):
        read_records(spark, str(tmp_path)).collect()
    (tmp_path / "lines.csv").write_text("a,b\n1,x\n")
    (tmp_path / "other.csv").write_text("b,a\n1,x\n")
    with pytest.raises(Exception, match="another header"):
        read_records(spark, str(tmp_path)).count()


def test_first_records_are_marked(spark, tmp_path, small_ranges):
    (tmp_path / "one.csv").write_text('"a\nname",b\n1,2\n')
    (tmp_path / "two.csv").write_text('"a\nname",b\n3,4\n')
    small_ranges(5)
    found = records(spark, str(tmp_path))
    assert sorted(column(found.where("is_first"), "record")) == ['"a\nname",b'] * 2
    assert column(read_records(spark, str(tmp_path)), "b", order=["b"]) == ["2", "4"]


def test_repeated_and_missing_names(spark, tmp_path):
    (tmp_path / "lines.csv").write_text("country,,note,note\nItaly,1,x,y\n")
    found = read_invoice_csv(spark, str(tmp_path / "lines.csv"))
    plain = spark.read.csv(str(tmp_path / "lines.csv"), header=True)
    assert found.columns == plain.columns
    assert [tuple(r) for r in found.collect()] == [("Italy", "1", "x", "y")]
