import math
import re

import pytest

from tests.compare import connect, differences
from tillstar.llm import queries, urls

SF = "/root/testdata/sf0.01"


def pages(spark, rows):
    full = [(i, u, h, "clash", 1) for i, u, h in rows]
    return spark.createDataFrame(full, "page_id long, url string, html string, host string, path int")


def judged(spark, rows):
    return {r.page_id: tuple(r)[1:] for r in urls.judge(pages(spark, rows)).collect()}


def test_parsing_and_rules(spark):
    found = judged(spark, [
        (1, None, None), (2, "no scheme", "x"), (3, "http://A.Example.ORG/es/x?y", ""),
        (4, "https://example.org", ""), (5, "https://x.example.org/en/15#t", ""), (6, "a://b.com/fr/?q", ""),
        (7, "http://notorg/x", ""), (8, "x://com/de/1", ""), (9, "http://ex.com?u=http://a.org/", ""),
        (10, "http://Ö.org/\n/es/", ""), (11, "://org/", ""),
    ])
    assert found[1] == ("", "", None, "allow") and found[2] == ("", "", None, "allow")
    assert found[3] == ("a.example.org", "/es/x", "example.org/es/", "block")
    assert found[4] == ("example.org", "", None, found[4][3])
    assert found[5][2:] == ("example.org/en/1", "block") and found[6][2:] == ("com/fr/", "allow")
    assert found[7][2] is None and found[8][2:] == ("com/de/", "block")
    assert found[9][:2] == ("ex.com", "")
    assert found[10][:3] == ("Ö.org", "/\n/es/", "org/") and found[11][2] == "org/"


def link(*hosts):
    return "".join(f'<p><a class=x href="https://{h}/p">t</a>' for h in hosts)


def test_distrust_reaches_those_who_link_to_blocked_hosts(spark):
    rows = [(1, "http://bad.com/de/", ""), (2, "http://farm.net/x", link("bad.com")), (3, "http://far.net/x", link("farm.net")),
            (4, "http://good.org/", link("fine.net")), (5, "http://fine.net/x", "<a href=/rel>"), (6, "http://alone.net/x", None)]
    verdicts = {i: r[3] for i, r in judged(spark, rows).items()}
    assert verdicts == {1: "block", 2: "block", 3: "block", 4: "allow", 5: "allow", 6: "allow"}


def test_scores_equal_power_iteration(spark):
    edges = [("a", "b", 2.0), ("a", "c", 1.0), ("b", "c", 1.0), ("c", "a", 1.0), ("d", "c", 3.0)]
    hosts = [("a", 3, 0), ("b", 0, 0), ("c", 0, 2), ("d", 1, 2)]
    found = urls.host_scores(
        spark.createDataFrame(hosts, "host string, allowed long, blocked long"),
        spark.createDataFrame(edges, "source string, target string, n double"),
    )
    got = {r.host: (r.trust, r.distrust) for r in found.collect()}

    def rank(seeds, arcs):
        scores = dict(seeds)
        for _ in range(urls.STEPS):
            after = {h: s * (1 - urls.DAMPING) for h, s in seeds.items()}
            for a, b, n in arcs:
                total = sum(m for x, _, m in arcs if x == a)
                after[b] = after.get(b, 0) + scores.get(a, 0) * n / total * urls.DAMPING
            scores = after
        return scores

    trust = rank({"a": 0.75, "d": 0.25}, edges)
    distrust = rank({"c": 0.5, "d": 0.5}, [(b, a, n) for a, b, n in edges])
    for host, (t, d) in got.items():
        assert math.isclose(t, trust.get(host, 0), abs_tol=1e-9) and math.isclose(d, distrust.get(host, 0), abs_tol=1e-9)


def test_empty_table(spark):
    assert judged(spark, []) == {}


def test_equals_sql(spark):
    con = connect(SF)
    name = "op1_url_filter"
    assert differences(spark, con, SF, queries.QUERIES[name], queries.ORACLES[name]) == []


def test_no_python_in_the_plan(spark):
    plan = urls.judge(pages(spark, [(1, "http://a.org/", "")]))._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|MapInArrow", plan)


@pytest.mark.parametrize("url,host", [("http://u@H:80/x", "u@h:80"), ("http:///x", "")])
def test_odd_hosts(spark, url, host):
    assert judged(spark, [(1, url, None)])[1][0] == host


def test_distrust_reaches_the_far_end_of_a_chain(spark):
    """Further than the number of steps, and below any fixed number of decimals."""
    n = 3 * urls.STEPS
    rows = [(0, "http://bad.com/de/", "")]
    names = ["bad.com"] + [f"h{i}.net" for i in range(1, n)]
    rows += [(i, f"http://{names[i]}/x", link(names[i - 1])) for i in range(1, n)]
    assert {r[3] for r in judged(spark, rows).values()} == {"block"}


def test_small_scores_count(spark):
    """One blocked page of a thousand million, shared by thousands of hosts that link to it."""
    hosts = spark.createDataFrame(
        [("big", 0, 10**9), ("bad", 0, 1)] + [(f"h{i}", 0, 0) for i in range(3000)],
        "host string, allowed long, blocked long",
    )
    far = [(f"g{i}", f"h{i}", 1.0) for i in range(3000)]
    edges = spark.createDataFrame(
        [(f"h{i}", "bad", 1.0) for i in range(3000)] + far + [("f", "g0", 1.0), ("f", "e", 10.0**9)] + [("z", "g0", 10.0**9)],
        "source string, target string, n double",
    )
    scores = {r.host: r for r in urls.host_scores(hosts, edges).collect()}
    assert 0 < scores["f"].distrust < 1e-15 and scores["f"].trust == 0
