"""The entry without its optional part."""

import subprocess
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent


@pytest.mark.parametrize("absent", ["tillstar.llm", "public_tokenizers", "corpus_pipeline"])
def test_entry_stands_without_the_text_operators(absent):
    code = (
        f"import sys; sys.modules[{absent!r}] = None\n"
        "import __spark_entry__ as entry\n"
        "assert set(entry.queries()) == set(entry._QUERIES)\n"
        "assert set(entry.oracle_sql()) == set(entry.queries())\n"
    )
    done = subprocess.run([sys.executable, "-c", code], cwd=ROOT, capture_output=True, text=True, timeout=120)
    assert done.returncode == 0, done.stderr
    assert "no queries on text corpora" in done.stderr


def test_layers_are_built_when_they_are_read(spark, monkeypatch, tmp_path):
    """A query on the raw layer builds no star; the last stage leaves the warehouse of the batch."""
    import __spark_entry__ as entry

    from tests.frames import same_rows
    from tillstar.plans import batch
    from tillstar.sources import feed
    from tillstar.sources import layers as L

    folder, built = entry.ENTRY_DIR, []
    monkeypatch.setattr(entry, "_stored", {})
    stages = {n: lambda *a, n=n, f=f: (built.append(n), f(*a)) for n, f in entry._STAGES.items()}
    monkeypatch.setattr(entry, "_STAGES", stages)
    for query, expected in (
        ("validate_input", ["raw"]), ("segment_cutoffs", ["raw", "processed"]), ("customer_totals", ["raw", "processed"]),
        ("fact_sales", ["raw", "processed", "dimensions"]), ("q_star_stats", list(stages)), ("layer_tables", list(stages)),
    ):
        assert entry.queries()[query](spark, folder).count()
        assert built == expected
    ours = entry.layers_of(spark, folder)
    whole = L.Layers(str(tmp_path), "e_raw", "e_processed", "e_star")
    batch.run(spark, feed.invoice_lines(spark, folder), whole, entry.RUN_TS, profiles=False, source="order tables")
    for layer, tables in L.TABLES.items():
        assert L.list_tables(spark, ours, layer) == sorted(tables)
        for table in tables:
            assert same_rows(L.read(spark, ours, layer, table), L.read(spark, whole, layer, table))
    summary = [entry.read_report(spark, f"{batch.reports(x)}/pipeline_summary").drop("layers") for x in (ours, whole)]
    assert same_rows(*summary)
