import numpy as np
from pyspark.sql import functions as F

from tests.llm import frames
from tillstar.llm import language

def may_learn():
    return F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(4)) != 2


def test_held_out_accuracy(spark):
    rows = frames.sample("sf0.01", limit=1000)
    docs = frames.docs(spark, rows)
    found = language.identify(docs, may_learn()).withColumn("held", ~may_learn()).collect()
    truth = {r[0]: r[2] for r in rows}
    held = [r for r in found if r.held]
    right = [r.lang_pred == truth[r.doc_id] for r in held]
    assert len(held) > 150 and np.mean(right) > 0.97
    assert abs(np.mean([r.score for r in held]) - np.mean(right)) < 0.05


def test_awkward_texts_are_unknown_or_scored(spark):
    rows = [(1000 + i, *r[1:]) for i, r in enumerate(frames.sample("sf0.01", limit=120))]
    found = language.identify(frames.docs(spark, rows + frames.AWKWARD), may_learn()).collect()
    assert len(found) == len(rows) + len(frames.AWKWARD)
    for row in found:
        if row.text is None or not any(c.isalpha() for c in row.text):
            assert (row.lang_pred, row.score) == ("und", 0.0)
        else:
            assert row.lang_pred in {"en", "fr", "de", "es"} and 0 <= row.score <= 1


def test_nothing_to_learn_from(spark):
    docs = frames.docs(spark, [(1, "some text", None), (2, None, "en")])
    assert {tuple(r[2:]) for r in language.identify(docs, may_learn()).collect()} == {("und", 0.0)}
    assert language.identify(frames.docs(spark, []), may_learn()).count() == 0


def test_ids_do_not_change_a_prediction(spark):
    rows = frames.sample("sf0.01", limit=100)
    docs = frames.docs(spark, rows)
    classes, weights, heat = language.learn(docs, may_learn(), "doc_id", "lang", "text", 1000)
    texts = [r[1] for r in rows]
    whole = language.predict(texts, classes, weights, heat)
    alone = [language.predict([t], classes, weights, heat) for t in texts]
    assert whole[0] == [a[0][0] for a in alone]
    assert np.allclose(whole[1], [a[1][0] for a in alone], atol=1e-6)


def test_filter_keeps_columns_and_clean_rows(spark):
    rows = [(1000 + i, *r[1:]) for i, r in enumerate(frames.sample("sf0.01", limit=200))]
    docs = frames.docs(spark, rows + frames.AWKWARD)
    kept = language.keep_identified(docs, may_learn())
    assert kept.columns == docs.columns
    ids = {r.doc_id for r in kept.select("doc_id").collect()}
    assert {r[0] for r in rows} <= ids and not ids & {1, 2, 3, 4}


def test_temperature_softens_overconfidence():
    r = np.random.default_rng(1)
    truth = r.integers(0, 3, 2000)
    scores = r.normal(size=(2000, 3))
    scores[np.arange(2000), truth] += 1.0
    assert 3 < language.temperature(scores * 5, truth) < 8
