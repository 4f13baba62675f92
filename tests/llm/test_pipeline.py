import subprocess
import sys

import duckdb

import __spark_entry__ as entry
import corpus_pipeline
from tests.llm import frames
from tests.llm.test_contamination import expected as hits
from tests.llm.test_neardup import expected as groups
from tillstar.llm import queries

SF = "/root/testdata/sf0.001"


def test_queries_are_registered():
    names = {f"op{n}_" for n in range(1, 14)}
    found = [q for q in entry.queries() if q.startswith("op")]
    assert {q[: q.index("_") + 1] for q in found} == names and len(found) == 13
    assert entry.queries()["pipeline"] is corpus_pipeline.run
    assert set(queries.ORACLES) <= set(queries.QUERIES)


def test_stages_and_run_equal_brute_force(spark):
    docs = frames.sample("sf0.001", columns="doc_id, text, lang", limit=10**6)
    items = frames.sample("sf0.001", "benchmark", "item_id, text", 10**6)
    left = [r[:2] for r in docs if r[1] and any(c.isalpha() for c in r[1])]
    kept = {i for i, _, _, stays in groups(left, 5) if stays}
    left = [r for r in left if r[0] in kept]
    bad = {r[0] for r in hits(left, items) if r[-1]}
    found = corpus_pipeline.run(spark, SF)
    assert {r.doc_id for r in found.select("doc_id").collect()} == {i for i, _ in left} - bad
    assert len(corpus_pipeline.STAGES) == 5 and corpus_pipeline.ORACLE_SQL is None


def test_filters_keep_columns(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, SF).columns == docs.columns


def test_other_queries_do_without_this_package():
    code = (
        "import sys; sys.modules['corpus_pipeline'] = None; sys.modules['tillstar.llm'] = None\n"
        "import __spark_entry__ as e; assert not any(q.startswith('op') for q in e.queries())"
    )
    root = entry.__file__.rsplit("/", 1)[0]
    subprocess.run([sys.executable, "-c", code], check=True, cwd=root, timeout=120)


def test_every_op_query_returns_all_rows(spark):
    def rows(table):
        return duckdb.sql(f"SELECT count(*) FROM '{SF}/{table}.parquet'").fetchall()[0][0]

    n = rows("documents")
    # Rows of pages, words and items; their own tests compare them whole.
    others = ("op1_url_filter", "op11_spelling_variants", "op12_ranked_search", "op13_vector_duplicates", "pipeline")
    for name, query in queries.QUERIES.items():
        if name not in others:
            assert query(spark, SF).count() == n, name
    assert queries.op13_vector_duplicates(spark, SF).count() == rows("embeddings")
    assert queries.op12_ranked_search(spark, SF).count() <= 20 * rows("benchmark")
