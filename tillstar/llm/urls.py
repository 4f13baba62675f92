"""URL filters: rules first, then trust and distrust propagated over host edges.

A page whose url a rule fits gets the longest rule's verdict. The others get their host's:
trust is a personalised PageRank from hosts with allowed pages along the edges, distrust
one from hosts with blocked pages against them, and a host is blocked if distrust is more
than BLOCK_ABOVE of both. STEPS steps are taken, and more as long as they reach hosts, so
that every host that a path leads to is scored. A host that neither reaches is allowed.

Edges are the links between pages of different hosts, weighted by pages that hold them,
and one edge each way between a host and the domain above it, down to two labels.

Defined cases: a null url, or one without `://`, has empty host and path; a host without a
page, and a page without html, only lack edges; repeated rows are judged one by one and
count each for their host; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillstar.operators.scratch import materialize


class Rule(NamedTuple):
    host: str
    path: str
    verdict: str

    @property
    def text(self) -> str:
        return self.host + self.path


# Fixed values of the registered query: host, path, verdict.
RULES = (
    Rule("org", "/", "allow"),
    Rule("example.org", "/es/", "block"),
    Rule("example.org", "/en/1", "block"),
    Rule("com", "/fr/", "allow"),
    Rule("com", "/de/", "block"),
)
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
URL = r"(?s)^.*?://([^/?#]*)([^?#]*)"
LINK = r"""(?i)<a\s[^>]*?href\s*=\s*["']?\s*(?:https?:)?//([^/?#"'\s>]+)"""

DAMPING = 0.85
STEPS = 8
BLOCK_ABOVE = 0.75
# No score of a host that is reached falls below this.
LEAST = 1e-300
# Steps whose plan is run as one.
_AT_ONCE = 4
_DIGITS = 15


def host_of(url: Column) -> Column:
    return F.coalesce(F.translate(F.regexp_extract(url, URL, 1), UPPER, LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, URL, 2), F.lit(""))


def fitting(rules: Sequence[Rule], value: str) -> Column:
    """`text` or `verdict` of the longest rule that fits host and path, else null."""
    found = F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: (len(r.text), r.verdict == "block")):
        here = (F.col("host") == rule.host) | F.col("host").endswith("." + rule.host)
        fits = here & F.col("path").startswith(rule.path)
        found = F.when(fits, F.lit(getattr(rule, value))).otherwise(found)
    return found


def link_edges(pages: DataFrame) -> DataFrame:
    """(source, target, n): pages of one host that link to another."""
    linked = pages.select(
        F.col("host").alias("source"),
        F.explode(F.array_distinct(F.regexp_extract_all("html", F.lit(LINK), F.lit(1)))).alias("target"),
    ).withColumn("target", F.translate("target", UPPER, LOWER))
    edges = linked.where("source != target and source != '' and target != ''")
    return edges.groupBy("source", "target").agg(F.count(F.lit(1)).cast("double").alias("n"))


def domain_edges(hosts: DataFrame) -> DataFrame:
    """(source, target, n): one edge each way between a host and the domain above it."""
    labels = F.split("host", r"\.")
    named = hosts.where(F.col("host").rlike("[a-z]$")).select(labels.alias("labels"))
    named = named.where(F.size("labels") > 2)
    steps = F.explode(F.sequence(F.lit(1), F.size("labels") - 2)).alias("from")
    suffix = lambda begin: F.array_join(F.slice("labels", begin, F.size("labels")), ".")
    up = named.select("labels", steps).select(
        suffix(F.col("from")).alias("source"), suffix(F.col("from") + 1).alias("target")
    ).distinct()
    down = up.select(F.col("target").alias("source"), F.col("source").alias("target"))
    return up.union(down).withColumn("n", F.lit(1.0))


def host_scores(hosts: DataFrame, edges: DataFrame) -> DataFrame:
    """(host, trust, distrust) after STEPS steps, or as many more as reach further hosts.

    hosts: (host, allowed, blocked), numbers of pages; edges: (source, target, n).
    """
    # One graph for both: kind 0 follows the edges, kind 1 goes against them.
    forward = edges.select(F.lit(0).alias("kind"), F.col("source").alias("host"), F.col("target").alias("next"), "n")
    backward = edges.select(F.lit(1).alias("kind"), F.col("target").alias("host"), F.col("source").alias("next"), "n")
    both = forward.union(backward)
    totals = both.groupBy("kind", "host").agg(F.sum("n").alias("total"))
    graph = materialize(
        both.join(totals, ["kind", "host"]).select("kind", "host", "next", (F.col("n") / F.col("total")).alias("share")),
        "host-graph",
    )
    sums = hosts.agg(F.sum("allowed").alias("a"), F.sum("blocked").alias("b")).first()
    seeds = hosts.select(
        "host",
        F.explode(
            F.array(
                F.struct(F.lit(0).alias("kind"), (F.col("allowed") / F.lit(max(sums.a or 0, 1))).alias("score")),
                F.struct(F.lit(1).alias("kind"), (F.col("blocked") / F.lit(max(sums.b or 0, 1))).alias("score")),
            )
        ).alias("seed"),
    ).select("host", "seed.kind", "seed.score").where("score > 0")
    seeds = materialize(seeds, "host-seeds")
    home = seeds.withColumn("score", F.col("score") * F.lit(1 - DAMPING))
    scores = seeds
    # Seeds come in at every step, so a host once reached stays so.
    step = 0
    while step < STEPS or _reaches_more(scores, graph):
        for _ in range(_AT_ONCE):
            moved = scores.join(graph, ["kind", "host"]).select(
                F.col("next").alias("host"),
                "kind",
                F.greatest(F.col("score") * F.col("share") * DAMPING, F.lit(LEAST)).alias("score"),
            )
            scores = home.union(moved).groupBy("host", "kind").agg(F.sum("score").alias("score"))
        step += _AT_ONCE
        scores = materialize(scores, "host-scores")
    of = lambda kind: F.coalesce(F.sum(F.when(F.col("kind") == kind, F.col("score"))), F.lit(0.0))
    return scores.groupBy("host").agg(of(0).alias("trust"), of(1).alias("distrust"))


def _reaches_more(scores: DataFrame, graph: DataFrame) -> bool:
    """Whether an edge leads from a host with a score to one without."""
    reached = scores.join(graph, ["kind", "host"]).select(F.col("next").alias("host"), "kind")
    return not reached.join(scores, ["host", "kind"], "left_anti").isEmpty()


def judge(pages: DataFrame, rules: Sequence[Rule] = RULES, id: str = "page_id") -> DataFrame:
    """One row per page: id, host, path, rule (that fits, else null), verdict."""
    parsed = pages.select(
        F.col(id), host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"), "html"
    )
    ruled = parsed.drop("html").withColumns(
        {"rule": fitting(rules, "text"), "by_rule": fitting(rules, "verdict")}
    )
    is_ = lambda verdict: F.count(F.when(F.col("by_rule") == verdict, 1))
    hosts = materialize(
        ruled.where("host != ''").groupBy("host").agg(is_("allow").alias("allowed"), is_("block").alias("blocked")),
        "hosts",
    )
    links = materialize(link_edges(parsed), "link-edges")
    named = hosts.select("host").union(links.select("target")).distinct()
    edges = links.union(domain_edges(named)).groupBy("source", "target").agg(F.sum("n").alias("n"))
    scores = host_scores(hosts, edges)
    # The share is rounded, as scores have no least size.
    share = F.round(F.col("distrust") / (F.col("trust") + F.col("distrust")), _DIGITS)
    blocked = scores.where(share > BLOCK_ABOVE).select("host", F.lit("block").alias("by_host"))
    verdict = F.coalesce("by_rule", "by_host", F.lit("allow"))
    return ruled.join(blocked, "host", "left").select(id, "host", "path", "rule", verdict.alias("verdict"))


def oracle(rules: Sequence[Rule] = RULES) -> str:
    """The same verdicts in SQL over `pages`."""

    def case(value: str) -> str:
        longest_first = sorted(rules, key=lambda r: (-len(r.text), r.verdict != "block"))
        return "CASE " + " ".join(
            f"WHEN (host = '{r.host}' OR ends_with(host, '.{r.host}')) AND starts_with(path, '{r.path}') "
            f"THEN '{getattr(r, value)}'"
            for r in longest_first
        ) + " END"

    lower = f"translate({{}}, '{UPPER}', '{LOWER}')"
    link = LINK.replace("'", "''")
    steps, before = "", "seeds"
    for step in range(1, STEPS + 1):
        steps += f"""
        s{step} AS (SELECT host, kind, sum(score) AS score FROM (
            SELECT host, kind, score * {1 - DAMPING!r} AS score FROM seeds UNION ALL
            SELECT g.next, g.kind, s.score * g.share * {DAMPING} FROM {before} s JOIN graph g USING (kind, host)
        ) GROUP BY host, kind),"""
        before = f"s{step}"
    return f"""
    WITH parsed AS (
        SELECT page_id, html,
               coalesce({lower.format(f"regexp_extract(url, '{URL}', 1)")}, '') AS host,
               coalesce(regexp_extract(url, '{URL}', 2), '') AS path
        FROM pages),
    ruled AS (SELECT page_id, host, path, {case("text")} AS rule, {case("verdict")} AS by_rule FROM parsed),
    hosts AS (SELECT host, count(*) FILTER (by_rule = 'allow') AS allowed,
                     count(*) FILTER (by_rule = 'block') AS blocked
              FROM ruled WHERE host <> '' GROUP BY host),
    found AS (SELECT page_id, host AS source, {lower.format("target")} AS target
              FROM (SELECT page_id, host, unnest(list_distinct(regexp_extract_all(html, '{link}', 1))) AS target
                    FROM parsed)),
    links AS (SELECT source, target, count(*)::DOUBLE AS n FROM found
              WHERE source <> target AND source <> '' AND target <> '' GROUP BY ALL),
    labelled AS (SELECT string_split(host, '.') AS labels
                 FROM (SELECT host FROM hosts UNION SELECT target FROM links)
                 WHERE regexp_matches(host, '[a-z]$')),
    climbing AS (SELECT labels, unnest(generate_series(1, len(labels) - 2)) AS k
                 FROM labelled WHERE len(labels) > 2),
    up AS (SELECT DISTINCT array_to_string(list_slice(labels, k, len(labels)), '.') AS source,
                           array_to_string(list_slice(labels, k + 1, len(labels)), '.') AS target FROM climbing),
    edges AS (SELECT source, target, sum(n) AS n FROM (
        SELECT * FROM links UNION ALL SELECT source, target, 1.0 FROM up
        UNION ALL SELECT target, source, 1.0 FROM up) GROUP BY ALL),
    both_ways AS (SELECT 0 AS kind, source AS host, target AS next, n FROM edges
                  UNION ALL SELECT 1, target, source, n FROM edges),
    graph AS (SELECT kind, host, next, n / sum(n) OVER (PARTITION BY kind, host) AS share FROM both_ways),
    seeds AS (
        SELECT host, 0 AS kind, allowed / (SELECT greatest(sum(allowed), 1)::DOUBLE FROM hosts) AS score
        FROM hosts WHERE allowed > 0 UNION ALL
        SELECT host, 1, blocked / (SELECT greatest(sum(blocked), 1)::DOUBLE FROM hosts)
        FROM hosts WHERE blocked > 0),{steps}
    scores AS (SELECT host, coalesce(round(sum(score) FILTER (kind = 0), {_DIGITS}), 0) AS trust,
                      coalesce(round(sum(score) FILTER (kind = 1), {_DIGITS}), 0) AS distrust
               FROM {before} GROUP BY host)
    SELECT page_id, host, path, rule,
           coalesce(by_rule, CASE WHEN distrust > {BLOCK_ABOVE} * (trust + distrust) THEN 'block' END, 'allow')
               AS verdict
    FROM ruled LEFT JOIN scores USING (host)
    """
