"""URL filters (operator 8): host rules, and trust propagated over the link graph.

Rules judge a page by host and path.  Pages that no rule fits get the verdict of
their host: trust spreads along links by personalised PageRank from hosts with
allowed pages, distrust spreads against the links from hosts with blocked pages,
because a host that links to blocked ones is suspect.  A host is blocked if its
distrust is more than ``STRICTNESS`` percent of its trust.

Amounts are whole numbers and travel round by round: what a host gets in one
round it passes on in the next, less the damping.  Rounds go on until no host
has got as much as ``LEAST``, so there is no fixed number of steps.  A page gives
the same amount in every table, so equal neighbourhoods are judged alike in
small and large ones.  A round is a join of the amounts with the host edges and
a sum with a map-side part, settled, so that rounds don't pile up in the plan.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from pagewinnow.functions import patterns as P
from pagewinnow.llm.shared import settle, table

# fixed values: (host, path), verdict
RULES = (
    ("org", "/", "allow"),
    ("example.org", "/es/", "block"),
    ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"),
    ("com", "/de/", "block"),
)
#: what a page that a rule judges gives to its host; 9 * 10**10 such pages fit into 64 bits
UNIT = 10**8
DAMPING = 85
#: less than this ten-thousandth of a page's amount, got in one round, counts but isn't passed on
LEAST = UNIT // 10**4
STRICTNESS = 100
#: rounds after which the amounts are added up
FOLD = 8
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: host in an address, in quotes or bare; a link without one stays on the page's own host
LINKED_HOST = r"""(?i)^["']?\s*(?:https?:)?//([^/?#"'\s>]+)"""


def host_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path; both empty without ``://``."""
    at = F.locate("://", url)
    rest = F.coalesce(F.when(at > 0, F.substring(url, at + 3, F.length(url))), F.lit(""))
    return F.translate(F.regexp_extract(rest, r"^([^/?#]*)", 1), UPPER, LOWER), F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def ruled(host: Column, path: Column, rules) -> tuple[Column, Column]:
    """The longest rule that fits, as text, and its verdict; else nulls."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for h, p, v in sorted(rules, key=lambda r: (len(r[0] + r[1]), r)):
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        rule = F.when(fits, F.lit(h + p)).otherwise(rule)
        verdict = F.when(fits, F.lit(v)).otherwise(verdict)
    return rule, verdict


def host_edges(pages: DataFrame) -> DataFrame:
    """``src, dst, n``: how many links lead from host to host; links within a host are left out."""
    host, _ = host_path(F.col("url").cast("string"))
    tags = F.regexp_extract_all(F.col("html").cast("string"), F.lit(P.named_tag("a")), F.lit(0))
    tags = pages.select(host.alias("src"), F.explode(F.filter(tags, lambda t: F.contains(t, F.lit("//")))).alias("tag"))
    links = tags.select("src", F.regexp_extract(F.regexp_extract("tag", P.attribute("href"), 1), LINKED_HOST, 1).alias("dst"))
    links = links.where("dst <> ''")
    links = links.select("src", F.translate("dst", UPPER, LOWER).alias("dst")).where("src <> dst and src <> ''")
    return links.groupBy("src", "dst").agg(F.count("*").alias("n"))


def spread(edges: DataFrame, seeds: DataFrame, source: str, target: str, least: int = LEAST) -> DataFrame:
    """Personalised PageRank ``host, score`` from ``seeds(host, n)`` along ``source -> target``.

    The part of each way is the damping to the power of its length, divided
    among the links of each host on it.  Starts jobs, a few a round.
    """
    fresh = settle(seeds.select("host", F.expr(f"n * {UNIT // 100 * (100 - DAMPING)}").alias("amount")))
    out = edges.groupBy(source).agg(F.sum("n").alias("total"))
    ways = settle(edges.join(out, source).select(F.col(source).alias("host"), F.col(target).alias("to"), "n", "total"))
    # the product with the damping may need more than 64 bits
    part = f"cast((amount div total) * n AS decimal(20, 0)) * {DAMPING} div 100"
    got, parts = fresh, []
    if ways.isEmpty():
        return got.withColumnRenamed("amount", "score")
    while not fresh.where(F.col("amount") >= least).isEmpty():
        passed = fresh.where(F.col("amount") >= least).join(ways, "host")
        passed = passed.select(F.col("to").alias("host"), F.expr(part).alias("amount")).where("amount > 0")
        fresh = settle(passed.groupBy("host").agg(F.sum("amount").alias("amount")))
        parts.append(fresh)
        if len(parts) == FOLD:
            got, parts = settle(added_up([got, *parts])), []
    return added_up([got, *parts]).withColumnRenamed("amount", "score")


def added_up(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts).groupBy("host").agg(F.sum("amount").alias("amount"))


def judged(pages: DataFrame, rules=RULES) -> DataFrame:
    """``page_id, host, path, rule, verdict`` for every row of ``pages(page_id, url, html)``.

    A null url, or one without ``://``, has an empty host and path, which no
    rule fits; an empty or unknown host has neither trust nor distrust and is
    allowed.  Null html has no links; an address in quotes may hold any character,
    and very long html is read whole.  Repeated rows are judged alike, and each
    counts.  A host may be a seed of both kinds.  Other columns are ignored,
    whatever their names.
    """
    host, path = host_path(F.col("url").cast("string"))
    rows = pages.select("page_id", host.alias("host"), path.alias("path"))
    rule, verdict = ruled(F.col("host"), F.col("path"), rules)
    rows = rows.select("page_id", "host", "path", rule.alias("rule"), verdict.alias("by_rule"))
    known = settle(rows.where("by_rule is not null").groupBy("host", "by_rule").agg(F.count("*").alias("n")))
    edges = settle(host_edges(pages))
    if (known.agg(F.sum("n")).first()[0] or 0) * UNIT >= 2**63:
        raise ValueError(f"amounts of more than {2**63 // UNIT} judged pages don't fit into 64 bits")
    trust = spread(edges, known.where("by_rule = 'allow'"), "src", "dst")
    distrust = spread(edges, known.where("by_rule = 'block'"), "dst", "src")
    both = trust.select("host", F.col("score").alias("trust"), F.lit(0).cast("long").alias("distrust"))
    both = both.unionByName(distrust.select("host", F.lit(0).cast("long").alias("trust"), F.col("score").alias("distrust")))
    scores = both.groupBy("host").agg(F.sum("trust").alias("trust"), F.sum("distrust").alias("distrust"))
    more = f"cast(distrust AS decimal(20, 0)) * 100 > cast(trust AS decimal(20, 0)) * {STRICTNESS}"
    blocked = settle(scores.where(more).select("host"))
    blocked = blocked.withColumn("blocked", F.lit(True))
    return rows.join(blocked, "host", "left").select(
        "page_id",
        "host",
        "path",
        "rule",
        F.coalesce("by_rule", F.when(F.col("blocked"), "block").otherwise("allow")).alias("verdict"),
    )


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judged(table(spark, sf_dir, "pages"))


def oracle(rules=RULES) -> str:
    """The same in SQL, the rounds as a recursion."""
    quoted = lambda pattern: pattern.replace("'", "''")
    # read on their own here: a tag with its quoted values, then its attributes up to the address
    tag = r"""(?i)<a\s(?:[^"'>]|"[^"]*"|'[^']*')*>"""
    value = r"""(?:"[^"]*"|'[^']*'|[^\s"'>][^\s>]*)"""
    href = rf"(?i)^<a(?:[\s/]+[^\s=>/]+(?:\s*=\s*{value})?)*?[\s/]+href\s*=\s*({value})"
    cases = lambda what: "CASE " + " ".join(
        f"WHEN (host = '{h}' OR ENDS_WITH(host, '.{h}')) AND STARTS_WITH(path, '{p}') THEN '{h + p if what == 'rule' else v}'"
        for h, p, v in sorted(rules, key=lambda r: (-len(r[0] + r[1]), r))
    ) + " END"
    parts = [
        f"""cut AS (SELECT page_id, html, CASE WHEN INSTR(url, '://') > 0 THEN SUBSTR(url, INSTR(url, '://') + 3) ELSE '' END AS rest FROM pages),
named AS (SELECT page_id, html, TRANSLATE(REGEXP_EXTRACT(COALESCE(rest, ''), '^([^/?#]*)', 1), '{UPPER}', '{LOWER}') AS host,
  REGEXP_EXTRACT(COALESCE(rest, ''), '^[^/?#]*([^?#]*)', 1) AS path FROM cut),
ruled AS (SELECT page_id, host, path, {cases("rule")} AS rule, {cases("verdict")} AS by_rule FROM named),
known AS (SELECT host, by_rule, COUNT(*) AS n FROM ruled WHERE by_rule IS NOT NULL GROUP BY 1, 2),
tags AS (SELECT host AS src, UNNEST(REGEXP_EXTRACT_ALL(html, '{quoted(tag)}')) AS t FROM named),
found AS (SELECT src, REGEXP_EXTRACT(REGEXP_EXTRACT(t, '{quoted(href)}', 1), '{quoted(LINKED_HOST)}', 1) AS dst FROM tags),
edges AS (SELECT src, TRANSLATE(dst, '{UPPER}', '{LOWER}') AS dst, COUNT(*) AS n FROM found WHERE src <> '' AND dst <> '' AND src <> TRANSLATE(dst, '{UPPER}', '{LOWER}') GROUP BY 1, 2)"""
    ]
    for name, verdict, a, b in (("t", "allow", "src", "dst"), ("d", "block", "dst", "src")):
        parts.append(
            f"""{name}ways AS (SELECT {a} AS host, {b} AS target, n, SUM(n) OVER (PARTITION BY {a}) AS total FROM edges),
{name}rounds AS (SELECT host, (n * {UNIT // 100 * (100 - DAMPING)})::HUGEINT AS amount FROM known WHERE by_rule = '{verdict}'
  UNION ALL SELECT target, SUM((amount // total) * n * {DAMPING} // 100)::HUGEINT FROM {name}rounds JOIN {name}ways USING (host)
  WHERE amount >= {LEAST} GROUP BY target),
{name} AS (SELECT host, SUM(amount) AS score FROM {name}rounds GROUP BY host)"""
        )
    return (
        "WITH RECURSIVE "
        + ",\n".join(parts)
        + f"""
SELECT page_id, host, path, rule, COALESCE(by_rule, CASE WHEN COALESCE(d.score, 0) * 100 > COALESCE(t.score, 0) * {STRICTNESS} THEN 'block' ELSE 'allow' END) AS verdict
FROM ruled LEFT JOIN t USING (host) LEFT JOIN d USING (host)"""
    )
