"""Exact top-k search by inner product: a Voronoi join (operator 7).

Vectors are grouped by their nearest pivot; the pivots are a bounded sample.  A
group's summary is its size, the radius around its pivot and its longest
vector.  From summaries alone a query learns a lower bound for its k-th score
(groups counted from the best guaranteed score downwards) and for each group the
highest score it could hold.  A query is sent only to groups that can reach its
bound; rows of its own id, which are no candidates, don't count for it.  Equal
rows are kept once with their number.  Groups are dealt out in blocks by a hash
of id and vector, queries in blocks as well, and each pair of blocks is solved by
one exact integer product.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from pagewinnow.llm.shared import settle, ship, table

ship(__name__)

#: bound of the sample of pivots
PIVOTS = 64
#: rows of a block of candidates, and of queries
BLOCK, QUERY_BLOCK = 512, 1024
SCALE = 1024
TOP = 10
#: components beyond this are whole numbers as they are; and the limits of a double
WHOLE, LARGEST = float(1 << 52), 1.7976931348623157e308
#: the limits of a score
LOW, HIGH = -(1 << 63), (1 << 63) - 1


def whole_vectors(rows: DataFrame, scale: int) -> DataFrame:
    """``vec_id, v``: components ``floor(scale * x)``; rows with a null id or vector or a bad component are left out."""
    v = F.col("embedding").cast("array<double>")
    good = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    rows = rows.select(F.col("vec_id").cast("long"), v.alias("v")).where(F.col("vec_id").isNotNull() & F.col("v").isNotNull() & good)
    # only products beyond a double's limits are cut
    scaled = lambda x: F.greatest(F.lit(-LARGEST), F.least(F.lit(LARGEST), x * scale))
    whole = lambda x: F.when(F.abs(x) < WHOLE, F.floor(x).cast("double")).otherwise(x)
    return rows.select("vec_id", F.transform(F.transform("v", scaled), whole).alias("v"))


def pivots_of(vectors: DataFrame, most: int) -> dict[int, np.ndarray]:
    """Pivots for each length of vectors that the sample holds."""
    sample = vectors.orderBy(F.xxhash64("vec_id", "v"), "vec_id", "v").limit(most).collect()
    by: dict[int, list] = {}
    for r in sample:
        by.setdefault(len(r["v"]), []).append(r["v"])
    return {n: np.unique(np.array(v, float).reshape(len(v), n), axis=0) for n, v in by.items()}


def pivot_matrix(pivots: dict[int, np.ndarray], size: int) -> np.ndarray:
    return pivots.get(size, np.zeros((1, size)))


def grouped(vectors: DataFrame, pivots: dict[int, np.ndarray]) -> DataFrame:
    """Adds ``size`` (components), ``cell`` (nearest pivot), ``away`` (distance to it) and ``norm``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(1)
            sizes = np.diff(lists.offsets.to_numpy())
            values = lists.values.to_numpy()[lists.offsets[0].as_py() :]
            begins = np.cumsum(sizes) - sizes
            cell, away, norm = np.zeros(len(sizes), np.int32), np.zeros(len(sizes)), np.zeros(len(sizes))
            for size in np.unique(sizes):
                at = np.flatnonzero(sizes == size)
                m = values[begins[at][:, None] + np.arange(size)]
                p = pivot_matrix(pivots, int(size))
                near = ((p * p).sum(axis=1)[None, :] - 2 * m @ p.T).argmin(axis=1)
                cell[at], norm[at] = near, np.sqrt((m * m).sum(axis=1))
                away[at] = np.sqrt(((m - p[near]) ** 2).sum(axis=1))
            arrays = [*batch.columns, pa.array(sizes.astype("i4")), pa.array(cell), pa.array(away), pa.array(norm)]
            yield pa.RecordBatch.from_arrays(arrays, ["vec_id", "v", "copies", "size", "cell", "away", "norm"])

    return vectors.mapInArrow(run, "vec_id long, v array<double>, copies long, size int, cell int, away double, norm double")


def wanted_cells(query: np.ndarray, own: np.ndarray | int, pivots: np.ndarray, cells: np.ndarray, k: int) -> np.ndarray:
    """Which of ``cells`` (number, rows, radius, longest) can hold one of the query's k best.

    ``own`` is how many rows of each cell have the query's id.
    """
    length = np.sqrt(query @ query)
    middle = pivots[cells[:, 0].astype(int)] @ query
    slack = 1e-9 * (np.abs(middle) + length * (cells[:, 2] + cells[:, 3])) + 1e-6
    upper = np.minimum(middle + length * cells[:, 2], length * cells[:, 3]) + slack
    lower = np.maximum(middle - length * cells[:, 2], -length * cells[:, 3]) - slack
    lower = np.where(np.isnan(lower), -np.inf, lower)  # beyond a double's limits nothing is known
    order = np.argsort(-lower, kind="stable")
    rows = np.cumsum((cells[:, 1] - own)[order])
    reached = np.flatnonzero(rows >= k)
    return ~(upper < (lower[order[reached[0]]] if len(reached) else -np.inf))


def best_of(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the k highest scores, ties to the smaller id."""
    if scores.dtype == object:
        return np.array(sorted(range(len(scores)), key=lambda i: (-scores[i], ids[i]))[:k], np.int64)
    if len(scores) > 4 * k:
        least = np.partition(scores, len(scores) - k)[len(scores) - k]
        at = np.flatnonzero(scores >= least)
    else:
        at = np.arange(len(scores))
    return at[np.lexsort((ids[at], -scores[at]))[:k]]


def exact_products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact integer inner products; Python's integers where a long may be too small."""
    most = (np.abs(a).max(initial=0) * np.abs(b).max(initial=0)) * max(a.shape[1], 1)
    if most < 2**53:
        return (a @ b.T).astype(np.int64)
    whole = np.frompyfunc(int, 1, 1)
    exact = whole(a) @ whole(b).T
    return exact if most >= 2**62 else exact.astype(np.int64)


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact integer inner products; those beyond 64 bits are cut to its limits."""
    return np.clip(exact_products(a, b), LOW, HIGH).astype(np.int64)


def beyond(score: int) -> bytes:
    """Orders, by bytes, scores that are cut to the same limit."""
    if LOW < score <= HIGH:
        return b""
    over = score - HIGH if score > 0 else LOW - score
    size = (over.bit_length() + 7) // 8
    name = size.to_bytes(2, "big") + over.to_bytes(size, "big")
    # of low ones the less exceeding is the higher
    return name if score > 0 else bytes(255 - x for x in name) + b"\xff"


def top_k(rows: DataFrame, every: int = 100, k: int = TOP, scale: int = SCALE) -> DataFrame:
    """``query_id, rank, vec_id, score``: the k best candidates of each row whose id is divisible by ``every``.

    Candidates of a query are all rows with another id and as many components.
    Rows with a null id, a null vector, or a null or non-finite component take
    no part.  Repeated candidates each take a rank; repeated queries (equal id
    and vector) are one, and queries of one id with different vectors are ranked
    each for itself.  Empty vectors score 0 with each other.  Ranks are by exact
    scores; a score that doesn't fit a long is given as the long nearest to it.
    A component whose product with ``scale`` is no finite double counts as the
    largest one.  Other columns are ignored.
    """
    vectors = settle(whole_vectors(rows, scale).groupBy("vec_id", "v").agg(F.count("*").alias("copies")))
    pivots = pivots_of(vectors, PIVOTS)
    vectors = settle(grouped(vectors, pivots))
    summary = vectors.groupBy("size", "cell").agg(F.sum("copies").alias("rows"), F.count("*").alias("kinds"), F.max("away").alias("radius"), F.max("norm").alias("longest"))
    # a row per pivot and length: no more than PIVOTS rows, plus one for each odd length
    summary = settle(summary)
    known: dict[int, list] = {}
    for r in summary.where(F.col("size").isin(list(pivots) or [-1])).collect():
        known.setdefault(r["size"], []).append((r["cell"], r["rows"], r["radius"], r["longest"]))
    cells = {n: np.array(sorted(v), float) for n, v in known.items()}
    blocks = F.ceil(F.col("kinds") / BLOCK).cast("int")

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep, to = [], []
            for i, (v, size, held) in enumerate(zip(*(batch.column(c).to_pylist() for c in (1, 2, 3)), strict=True)):
                if size in cells:
                    rows_of = {x["cell"]: x["rows"] for x in held}
                    own = np.array([rows_of.get(int(c), 0) for c in cells[size][:, 0]])
                    ok = wanted_cells(np.array(v, float), own, pivot_matrix(pivots, size), cells[size], k)
                    found = cells[size][ok, 0].astype(int).tolist()
                else:
                    found = [0]
                keep += [i] * len(found)
                to += found
            part = batch.take(pa.array(keep, pa.int64()))
            yield pa.RecordBatch.from_arrays([*part.columns[:3], pa.array(to, pa.int32())], ["vec_id", "v", "size", "cell"])

    asking = vectors.where(F.col("vec_id") % every == 0)
    n_queries = asking.count()
    # no more cells for an id than there are pivots
    held = asking.groupBy("vec_id", "size", "cell").agg(F.sum("copies").alias("rows"))
    held = settle(held.groupBy("vec_id", "size").agg(F.collect_list(F.struct("cell", "rows")).alias("held")))
    asking = asking.select("vec_id", "v", "size").join(held, ["vec_id", "size"]).select("vec_id", "v", "size", "held")
    asking = asking.mapInArrow(route, "vec_id long, v array<double>, size int, cell int")
    part = F.pmod(F.xxhash64(F.lit("query"), "vec_id", "v"), F.lit(-(-max(n_queries, 1) // QUERY_BLOCK)))
    asking = asking.groupBy("size", "cell", part.alias("part")).agg(F.collect_list(F.struct("vec_id", "v")).alias("queries"))
    asking = asking.join(summary.select("size", "cell", blocks.alias("blocks")), ["size", "cell"])
    asking = asking.withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).drop("blocks", "part")
    block = F.pmod(F.xxhash64("vec_id", "v"), F.col("blocks")).cast("int")
    asked = vectors.join(summary.select("size", "cell", blocks.alias("blocks")), ["size", "cell"])
    asked = asked.groupBy("size", "cell", block.alias("block")).agg(F.collect_list(F.struct("vec_id", "v", "copies")).alias("candidates"))
    pairs = asked.join(asking, ["size", "cell", "block"]).select("size", "candidates", "queries")

    def solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                size = batch.column(0)[i].as_py()
                (ids, m), (asks, q) = (matrix(batch.column(c)[i].values, size) for c in (1, 2))
                scores = exact_products(q, m)
                # a row's copies have places of their own, of which no more than k can be reached
                copies = np.minimum(batch.column(1)[i].values.field(2).to_numpy(), k)
                ids, scores = np.repeat(ids, copies), np.repeat(scores, copies, axis=1)
                out = []
                for j in range(len(asks)):
                    other = np.flatnonzero(ids != asks[j])
                    at = other[best_of(scores[j, other], ids[other], k)]
                    out.append((np.full(len(at), asks[j]), np.full(len(at), j), ids[at], scores[j, at]))
                a, number, c, d = (np.concatenate(x) for x in zip(*out, strict=True))
                extra = pa.array([beyond(x) for x in d] if d.dtype == object else [b""] * len(d), pa.binary())
                d = np.clip(d, LOW, HIGH).astype(np.int64)
                tags = np.array([hash_of(v) for v in q], np.int64)[number]
                yield pa.RecordBatch.from_arrays([*(pa.array(x) for x in (a, tags, c, d)), extra], ["query_id", "tag", "vec_id", "score", "beyond"])

    def hash_of(v: np.ndarray) -> int:
        import zlib

        return zlib.crc32(v.tobytes())

    def matrix(structs: pa.StructArray, size: int) -> tuple[np.ndarray, np.ndarray]:
        lists = structs.field(1)
        return structs.field(0).to_numpy(), lists.flatten().to_numpy().reshape(len(lists), size)

    found = pairs.mapInArrow(solve, "query_id long, tag long, vec_id long, score long, beyond binary")
    order = Window.partitionBy("query_id", "tag").orderBy(F.desc("score"), F.desc("beyond"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(table(spark, sf_dir, "embeddings"))


ORACLE = f"""
WITH v AS (SELECT vec_id, [FLOOR({SCALE} * CAST(x AS DOUBLE)) FOR x IN embedding] AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND LEN([1 FOR x IN embedding IF x IS NULL OR NOT ISFINITE(x)]) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id AS vec_id, CAST(LIST_DOT_PRODUCT(q.v, c.v) AS BIGINT) AS score
  FROM (SELECT * FROM v WHERE vec_id % 100 = 0) q JOIN v c ON q.vec_id <> c.vec_id AND LEN(q.v) = LEN(c.v))
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s) WHERE rank <= {TOP}"""
