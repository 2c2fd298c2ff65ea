"""Mixing sources to target weights (operator 4): budgets down a tree, token prefixes of seeded epochs.

Leaves are (domain, language, source).  A token budget goes down the tree in
proportion to weights.  A node takes no more than the leaves below it can give
in ``max_epochs`` passes; what it can't take goes to its siblings, and only if
all of them are full does the parent ask for less, so that the ancestor's other
children get it.  That is water filling at each node, and as nodes are few it
is a window over the node's children, sorted by capacity per weight.

A leaf gives whole epochs and, of the next one, the documents in a seeded order
as long as the tokens before them are fewer than the rest of its budget.  The
order is cut into buckets by the leading bits of the hash; running sums are
taken over buckets and inside them, so a leaf with a third of all rows is
spread over many tasks and the result is that of one global order.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from pagewinnow.llm.shared import settle, table, written

NODE = ("domain", "language", "source")
#: documents of one bucket of a leaf's order
BUCKET_ROWS = 400
#: parts that a leaf's rows are joined in
SALTS = 64
WORDS = r"[^\x20\x09-\x0D]+"


@dataclass(frozen=True)
class Targets:
    """Weights are whole numbers; names that aren't listed get 1."""

    domain_of: dict[str, str] = field(
        default_factory=lambda: {
            f"src{i}": d for d, part in (("web", range(5)), ("books", range(5, 10)), ("news", range(10, 15)), ("forums", range(15, 20))) for i in part
        }
    )
    domains: dict[str, int] = field(default_factory=lambda: {"web": 3, "books": 4, "news": 2, "forums": 2})
    languages: dict[str, int] = field(default_factory=lambda: {"en": 5, "de": 2, "fr": 2})
    sources: dict[str, int] = field(default_factory=dict)
    budget_percent: int = 80
    max_epochs: int = 2
    seed: int = 17


def _lookup(key: Column, values: dict, default) -> Column:
    out = F.lit(default)
    for k, v in values.items():
        out = F.when(key == k, F.lit(v)).otherwise(out)
    return out


def _filled(nodes: DataFrame, parent: list[str], weights: dict[str, int], name: str) -> DataFrame:
    """Budgets of the children of each ``parent``, from its ``given``."""
    nodes = nodes.withColumn("weight", _lookup(F.col(name), weights, 1).cast("long"))
    by = Window.partitionBy(*parent) if parent else Window.partitionBy(F.lit(0))
    order = by.orderBy(F.col("capacity").cast("double") / F.col("weight"), name)
    before = F.coalesce(F.sum("capacity").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    after = F.sum("weight").over(order.rowsBetween(0, Window.unboundedFollowing))
    nodes = nodes.withColumn("full", F.col("capacity") * after <= F.col("weight") * (F.col("given") - before))
    rest = F.col("given") - F.sum(F.when(F.col("full"), F.col("capacity")).otherwise(0)).over(by)
    share = F.sum(F.when(F.col("full"), 0).otherwise(F.col("weight"))).over(by)
    nodes = nodes.withColumn("rest", rest).withColumn("share", share)
    budget = F.when(F.col("full"), F.col("capacity")).otherwise(F.expr("(weight * rest) div greatest(share, 1)"))
    return nodes.withColumn("budget", budget).drop("weight", "full", "rest", "share", "given")


def budgets(leaves: DataFrame, targets: Targets) -> DataFrame:
    """``leaves(domain, language, source, n_docs, supply)`` with ``budget`` in tokens."""
    leaves = leaves.withColumn("capacity", F.col("supply") * targets.max_epochs)
    total = Window.partitionBy(F.lit(0))
    given = F.expr(f"(total * {targets.budget_percent}) div 100")
    level = leaves.groupBy("domain").agg(F.sum("capacity").alias("capacity"), F.sum("supply").alias("supply"))
    level = level.withColumn("total", F.sum("supply").over(total)).withColumn("all", F.sum("capacity").over(total))
    level = level.withColumn("given", F.least(given, "all")).drop("total", "all", "supply")
    domains = _filled(level, [], targets.domains, "domain").select("domain", F.col("budget").alias("given"))
    level = leaves.groupBy("domain", "language").agg(F.sum("capacity").alias("capacity")).join(domains, "domain")
    languages = _filled(level, ["domain"], targets.languages, "language").select("domain", "language", F.col("budget").alias("given"))
    return _filled(leaves.join(languages, ["domain", "language"]), ["domain", "language"], targets.sources, "source")


def decided(docs: DataFrame, targets: Targets | None = None, carry: tuple[str, ...] = ()) -> DataFrame:
    """A row per row of ``docs(doc_id, text, lang, source)`` with its leaf, ``n_tokens`` and ``copies``.

    ``copies`` is how often the mix holds the document, 0 if not at all.  Tokens
    are words split at ASCII white space; null texts have none.  Documents
    without tokens come along where the prefix reaches them.  Null languages
    and sources make leaves of their own, named ``(none)``; a null id is ordered
    by the text ``null``.  Repeated rows are documents of their own; identical
    ones may change places.  ``carry`` names columns that are returned as
    ``carried_`` and their name; other columns are ignored.
    """
    targets = targets or Targets()
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    source = F.coalesce(F.col("source").cast("string"), F.lit("(none)"))
    rows = docs.select(
        F.col("doc_id"),
        _lookup(source, targets.domain_of, "other").alias("domain"),
        F.coalesce(F.col("lang").cast("string"), F.lit("(none)")).alias("language"),
        source.alias("source"),
        F.regexp_count(text, F.lit(WORDS)).cast("long").alias("n_tokens"),
        *(F.col(c).alias(f"carried_{c}") for c in carry),
    )
    leaves = rows.groupBy(*NODE).agg(F.count("*").alias("n_docs"), F.sum("n_tokens").alias("supply"))
    leaves = written(budgets(settle(leaves), targets), "leaves")
    whole = F.expr("budget div greatest(supply, 1)")
    leaves = leaves.select(
        *NODE,
        whole.alias("epochs"),
        (F.col("budget") - whole * F.col("supply")).alias("rest"),
        F.ceil(F.col("n_docs") / BUCKET_ROWS).cast("long").alias("buckets"),
    )
    name = F.coalesce(F.col("doc_id").cast("string"), F.lit("null"))
    # the written leaves' size is known, so a short list is broadcast; a long one is joined in salted parts,
    # also because a partition by leaf would serve the windows below and keep a hot leaf in one task
    leaves = leaves.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    rows = rows.withColumn("salt", F.pmod(F.xxhash64("doc_id", "n_tokens"), F.lit(SALTS)).cast("int"))
    rows = rows.join(leaves, [*NODE, "salt"]).drop("salt")
    rows = rows.withColumn("order", F.md5(F.concat_ws(":", F.lit(str(targets.seed)), F.col("epochs").cast("string"), name)))
    lead = F.conv(F.substring("order", 1, 8), 16, 10).cast("long")
    rows = rows.withColumn("bucket", F.shiftright(lead * F.col("buckets"), 32))
    # settled, else one exchange by leaf would serve the sums and the window, with a row per task and bucket
    cells = settle(rows.groupBy(*NODE, "bucket").agg(F.sum("n_tokens").alias("n")))
    upto = Window.partitionBy(*NODE).orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    cells = cells.select(*NODE, "bucket", F.coalesce(F.sum("n").over(upto), F.lit(0)).alias("before"))
    inside = Window.partitionBy(*NODE, "bucket").orderBy("order", "n_tokens").rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.join(cells, [*NODE, "bucket"])
    begins = F.col("before") + F.coalesce(F.sum("n_tokens").over(inside), F.lit(0))
    copies = F.col("epochs") + (begins < F.col("rest")).cast("long")
    return rows.select("doc_id", *NODE, "n_tokens", copies.alias("copies"), *(f"carried_{c}" for c in carry))


def mixed(docs: DataFrame, targets: Targets | None = None, columns: tuple[str, ...] | None = None) -> DataFrame:
    """The mix itself: ``columns`` of the documents, a row for every copy."""
    columns = columns or tuple(docs.columns)
    chosen = decided(docs, targets, columns).where("copies > 0")
    chosen = chosen.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))))
    return chosen.select(*(F.col(f"carried_{c}").alias(c) for c in columns))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decided(table(spark, sf_dir, "documents"))


def _cases(column: str, values: dict, default) -> str:
    show = lambda v: f"'{v}'" if isinstance(v, str) else str(v)
    return "CASE " + " ".join(f"WHEN {column} = '{k}' THEN {show(v)}" for k, v in values.items()) + f" ELSE {show(default)} END"


def oracle(targets: Targets | None = None) -> str:
    """The same in SQL: water filling by plain sums over the siblings, one running sum over each leaf."""
    t = targets or Targets()

    def level(name: str, source: str, parent: str, key: str, weights: dict[str, int]) -> str:
        weight = _cases(key, weights, 1) if weights else "1"
        over = f"PARTITION BY {parent}" if parent else ""
        return f"""
{name}_w AS (SELECT *, CAST({weight} AS BIGINT) AS weight FROM {source}),
{name}_f AS (SELECT *, capacity * SUM(weight) OVER ({over} ORDER BY CAST(capacity AS DOUBLE) / weight, {key} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)
    <= weight * (given - COALESCE(SUM(capacity) OVER ({over} ORDER BY CAST(capacity AS DOUBLE) / weight, {key} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) AS full_up
  FROM {name}_w),
{name} AS (SELECT *, CASE WHEN full_up THEN capacity ELSE (weight * (given - SUM(CASE WHEN full_up THEN capacity ELSE 0 END) OVER ({over})))
    // GREATEST(SUM(CASE WHEN full_up THEN 0 ELSE weight END) OVER ({over}), 1) END AS budget FROM {name}_f),"""

    return rf"""
WITH docs AS (
  SELECT doc_id, {_cases("COALESCE(source, '(none)')", t.domain_of, "other")} AS domain, COALESCE(lang, '(none)') AS language,
    COALESCE(source, '(none)') AS source, CAST(LEN(REGEXP_EXTRACT_ALL(COALESCE(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS n_tokens
  FROM documents),
leaf AS (SELECT domain, language, source, CAST(SUM(n_tokens) AS BIGINT) AS supply, CAST(SUM(n_tokens) AS BIGINT) * {t.max_epochs} AS capacity FROM docs GROUP BY 1, 2, 3),
top AS (SELECT domain, SUM(capacity) AS capacity, LEAST((SELECT SUM(supply) FROM leaf) * {t.budget_percent} // 100, (SELECT SUM(capacity) FROM leaf)) AS given FROM leaf GROUP BY 1),
{level("d", "top", "", "domain", t.domains)}
mid AS (SELECT domain, language, SUM(leaf.capacity) AS capacity, ANY_VALUE(d.budget) AS given FROM leaf JOIN d USING (domain) GROUP BY 1, 2),
{level("l", "mid", "domain", "language", t.languages)}
low AS (SELECT leaf.*, l.budget AS given FROM leaf JOIN l USING (domain, language)),
{level("s", "low", "domain, language", "source", t.sources)}
plan AS (SELECT domain, language, source, budget // GREATEST(supply, 1) AS epochs, budget - budget // GREATEST(supply, 1) * supply AS rest FROM s),
ordered AS (SELECT docs.*, epochs, rest, MD5(CONCAT('{t.seed}:', CAST(epochs AS BIGINT), ':', COALESCE(CAST(doc_id AS VARCHAR), 'null'))) AS place
  FROM docs JOIN plan USING (domain, language, source))
SELECT doc_id, domain, language, source, n_tokens, CAST(epochs + CASE WHEN COALESCE(SUM(n_tokens) OVER (
    PARTITION BY domain, language, source ORDER BY place, n_tokens ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) < rest THEN 1 ELSE 0 END AS BIGINT) AS copies
FROM ordered"""
