import hashlib
import re

from pyspark.sql import functions as F

from tests.llm import frames
from tillstar.llm import fingerprints


def paragraphs(text):
    return {p for p in re.split(fingerprints.PARAGRAPH_END, text) if p}


def likeness(a, b):
    return len(a & b) / len(a | b) if a | b else 1.0


def check(rows, found):
    ordered = sorted(rows, key=lambda r: -r[0])
    for row, following in zip(ordered, ordered[1:] + ordered[:1], strict=True):
        text, other = row[1] or "", following[1] or ""
        third = len(text) // 3
        edit = text[: len(text) - third] + other[:third]
        n, sha, near_edited, near_next = found[row[0]]
        assert (n, sha) == (len(text), hashlib.sha256(edit.encode()).hexdigest())
        assert abs(near_edited - likeness(paragraphs(text), paragraphs(edit))) < 1e-9
        assert abs(near_next - likeness(paragraphs(text), paragraphs(other))) < 1e-9


COLUMNS = ("n_chars", "edited_sha256", "near_edited", "near_next")


def test_equals_digest_sets(spark):
    rows = [r[:2] for r in frames.sample("sf0.01", limit=150)]
    check(rows, frames.by_id(fingerprints.edits(frames.docs(spark, rows)), *COLUMNS))


def test_awkward_texts_and_gaps_between_ids(spark):
    named = {i: t for i, t in frames.AWKWARD if i is not None}
    rows = list(named.items()) + [(10**12, "far. away\n"), (-5, "😀 below. zero"), (5 * 10**6, "in another block. é")]
    check(rows, frames.by_id(fingerprints.edits(frames.docs(spark, rows)), *COLUMNS))


def test_repeated_and_missing_ids_and_single_rows(spark):
    assert fingerprints.edits(frames.docs(spark, frames.AWKWARD)).count() == len(frames.AWKWARD)
    assert fingerprints.edits(frames.docs(spark, [])).count() == 0
    (row,) = fingerprints.edits(frames.docs(spark, [(1, "alone here. so")])).collect()
    assert row.near_next == 1.0


def test_equal_texts_have_equal_fingerprints(spark):
    docs = frames.docs(spark, frames.AWKWARD)
    seen = {}
    for row in fingerprints.fingerprints(docs).collect():
        assert seen.setdefault(row.text or "", row.fingerprint) == row.fingerprint
    texts = [t for t in seen if t.strip()]
    assert len({seen[t] for t in texts}) == len(texts)


def test_peeling_recovers_differing_digests(spark):
    a = F.array(*[F.xxhash64(F.lit(i)) for i in range(40)])
    b = F.array(*[F.xxhash64(F.lit(i)) for i in range(8, 44)])
    cells = fingerprints.subtract(fingerprints.sketch(a, 16), fingerprints.sketch(b, 16))
    want = [F.xxhash64(F.lit(i)) for i in [*range(8), *range(40, 44)]]
    row = spark.range(1).select(fingerprints.peel(cells, 16).alias("p"), F.array(*want).alias("want")).first()
    assert row.p.whole and sorted(row.p.found) == sorted(row.want)


def test_peeling_fails_when_overfull_and_groups_answer(spark):
    a = F.transform(F.sequence(F.lit(1), F.lit(900)), lambda i: F.xxhash64(i))
    b = F.transform(F.sequence(F.lit(700), F.lit(1500)), lambda i: F.xxhash64(i))
    cells = fingerprints.subtract(fingerprints.sketch(F.col("a"), 16), fingerprints.sketch(F.col("b"), 16))
    row = (
        spark.range(1).select(a.alias("a"), b.alias("b"))
        .select(fingerprints.peel(cells, 16)["whole"].alias("whole"), fingerprints.differing_in_groups(F.col("a"), F.col("b")).alias("n"))
        .first()
    )
    assert not row.whole and row.n == 699 + 600


def test_no_python_in_the_plan(spark):
    plan = fingerprints.edits(frames.docs(spark, frames.AWKWARD))._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|MapInArrow", plan)


def test_edits_leave_the_other_sentences_and_parts_of_long_lines(spark):
    """Sentences that all begin with T, and a line without a sentence end."""
    sentences = " ".join(f"The number {i} stands here." for i in range(30))
    line = " ".join(chr(97 + i * 7 % 26) + w for i, w in enumerate(frames.random_words(1, 600, 10**6)))
    rows = [(2, sentences), (1, line), (0, "other")]
    found = frames.by_id(fingerprints.edits(frames.docs(spark, rows)), *COLUMNS)
    check(rows, found)
    assert found[2][2] > 0.3 and found[1][2] > 0.4


def test_difference_sketch_equals_subtraction(spark):
    rows = [(list(range(0, 40, 2)), list(range(0, 40, 3))), ([], [5]), ([7], []), ([], []), ([1, 2], [1, 2])]
    df = spark.createDataFrame(rows, "a array<long>, b array<long>")
    a, b = (F.transform(F.col(c), lambda x: F.xxhash64(x)) for c in "ab")
    for width in fingerprints.GROUP_WIDTHS:
        both = fingerprints.subtract(fingerprints.sketch(a, width), fingerprints.sketch(b, width))
        for row in df.select(fingerprints.difference_sketch(a, b, width).alias("x"), both.alias("y")).collect():
            assert row.x == row.y


def test_groups_are_sketched_from_signed_digests(spark):
    """One list of digests with signs gives the difference, whatever else its entries carry."""
    a, b = list(range(0, 30, 2)), list(range(0, 30, 3))
    values = [(9, x, 1) for x in a] + [(9, x, -1) for x in b]
    df = spark.createDataFrame([(a, b, values)], "a array<long>, b array<long>, v array<struct<group:int,digest:long,sign:int>>")
    for width in fingerprints.GROUP_WIDTHS:
        both = fingerprints.subtract(fingerprints.sketch(F.col("a"), width), fingerprints.sketch(F.col("b"), width))
        row = df.select(fingerprints.signed_sketch(F.col("v"), width).alias("x"), both.alias("y")).first()
        assert row.x == row.y
    row = df.select(fingerprints.differing_in_groups(F.col("a"), F.col("b")).alias("n")).first()
    assert row.n == len(set(a) ^ set(b))


def test_dealt_digests_are_cut_into_runs_of_one_group(spark):
    keys = [[], [4], [0, 0, 0], [0, 1, 1, 5, 5, 5, 9], list(range(30))]
    rows = [([(k, i) for i, k in enumerate(ks)],) for ks in keys]
    df = spark.createDataFrame(rows, "v array<struct<group:int,digest:long>>")
    each = fingerprints._of_runs(F.col("v"), "group", lambda run: F.transform(run, lambda x: x["group"]))
    got = [r.x for r in df.select(each.alias("x")).collect()]
    assert sorted(got) == sorted([[k] * ks.count(k) for k in sorted(set(ks))] for ks in keys)


def test_peeling_that_runs_out_of_rounds_is_not_whole(spark, monkeypatch):
    monkeypatch.setattr(fingerprints, "ROUNDS", 1)
    df = spark.range(0, 40).select(F.transform(F.sequence(F.lit(1), F.col("id") % 20 + 1), lambda i: F.xxhash64(i, "id")).alias("a"))
    cells = fingerprints.sketch(F.col("a"), 8)
    rows = df.select("a", fingerprints.peel(cells, 8).alias("p")).collect()
    assert {r.p.whole for r in rows} == {True, False}
    assert all(r.p.whole == (sorted(r.p.found) == sorted(r.a)) for r in rows)
