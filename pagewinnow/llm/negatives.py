"""Hard negatives by threshold joins over an inverted index (operator 12).

Rows lie in blocks of bounded size.  Anchors, a stated hundredth of the rows,
meet every block in blocks of their own.  A block's index lists, dimension by
dimension, the rows whose remaining norm can still matter: a row's last
dimensions are left out where their norm times the longest anchor's stays below
the threshold, for a pair that meets in none of the others can't reach it.
Partial scores are summed up along the lists; a pair is dropped as soon as its
sum and the product of both remaining norms stay below the anchor's threshold,
and survivors are summed to the end, exactly.

A task keeps the best rows of its anchors' windows from block to block, and a
full window raises its anchor's threshold.

Thresholds begin high and are lowered, for the anchors (then for the windows of
an anchor's positives) that are not full yet, down to where every row that may
count has been reached.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from pagewinnow.llm.knn import HIGH, LARGEST, LOW, WHOLE
from pagewinnow.llm.shared import settle, ship, table, written

ship(__name__)

#: rows of a block, anchors of a block
BLOCK, ASK_BLOCK = 2048, 128
#: blocks of anchors that travel together, and units of work for each core
ASKS, UNITS = 16, 4
#: dimensions whose lists are summed up before pairs are dropped again
STRIP = 8
#: share of pairs below which they are followed one by one
FEW = 0.05
#: thresholds for positives, as shares of anchor norm times longest norm; after these every row counts
COSINES = (0.5, 0.3)
#: thresholds for negatives, in percent of the positive's score; the lowest allowed one ends them
PERCENTS = (75, 55)
SCALE = 256


def whole_rows(rows: DataFrame, scale: int) -> DataFrame:
    """``vec_id, label, v`` with ``floor(scale * x)``; rows with a null or a component that is not finite are left out."""
    v = F.col("embedding").cast("array<double>")
    good = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    # only products beyond a double's limits are cut; large ones are whole numbers as they are
    scaled = lambda x: F.greatest(F.lit(-LARGEST), F.least(F.lit(LARGEST), x * scale))
    whole = lambda x: F.when(F.abs(x) < WHOLE, F.floor(x).cast("double")).otherwise(x)
    named = F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("embedding").isNotNull()
    rows = rows.where(named & good).select(F.col("vec_id").cast("long"), F.col("label").cast("long"), v.alias("v"))
    return rows.select("vec_id", "label", F.transform(F.transform("v", scaled), whole).alias("v"))


def remaining(m: np.ndarray) -> np.ndarray:
    """Norms of what remains of each row from each dimension on, and nothing after the last."""
    with np.errstate(over="ignore"):
        tails = np.sqrt(np.cumsum((m * m)[:, ::-1], axis=1))[:, ::-1]
    return np.hstack([tails, np.zeros((len(m), 1))])


class Index:
    """The inverted index of a block for anchors no longer than ``longest`` and no threshold below ``least``."""

    def __init__(self, rows: np.ndarray, longest: float, least: float):
        # heavy dimensions first, so that norms fall soon
        self.dims = np.argsort(-np.abs(rows).sum(axis=0), kind="stable")
        rows = rows[:, self.dims]
        norms = remaining(rows)
        with np.errstate(invalid="ignore", over="ignore"):
            listed = ~(norms[:, :-1] * longest * (1 + 1e-9) + 1e-6 < least)
        lengths = listed.sum(axis=1) if rows.shape[1] else np.full(len(rows), int(least <= 0))
        #: rows with the most listed dimensions first: each dimension's list is a beginning of them
        self.order = np.argsort(-lengths, kind="stable")
        self.rows, self.norms = rows[self.order], norms[self.order]
        self.lengths = lengths[self.order]
        self.most = np.abs(rows).max(initial=0)
        self.cuts = list(range(0, rows.shape[1], STRIP))

    def survivors(self, asks: np.ndarray, least: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray | list[int]]:
        """Anchor, row (of the block) and exact score of each wanted pair that reaches its anchor's threshold."""
        asks = asks[:, self.dims]
        norms = remaining(asks)
        size = self.rows.shape[1]
        alive = np.take(wanted, self.order, axis=1) & (self.lengths > 0)
        sums = np.zeros(alive.shape)
        a = r = part = None
        with np.errstate(invalid="ignore", over="ignore"):
            for begin in self.cuts:
                end = min(begin + STRIP, size)
                if a is None and np.count_nonzero(alive) <= FEW * alive.size:
                    a, r = np.nonzero(alive)
                    # the lists of short rows ended before
                    part = np.einsum("ij,ij->i", asks[a, :begin], self.rows[r, :begin])
                if a is None:
                    # rows that left the lists keep what was said of them then
                    n = int((self.lengths > begin).sum())
                    sums[:, :n] += asks[:, begin:end] @ self.rows[:n, begin:end].T
                    rest = np.multiply.outer(norms[:, end] * (1 + 1e-9), self.norms[:n, end])
                    rest += sums[:, :n]
                    alive[:, :n] &= ~(rest < least[:, None] - 1e-6)
                else:
                    part = part + np.einsum("ij,ij->i", asks[a, begin:end], self.rows[r, begin:end])
                    rest = norms[a, end] * self.norms[r, end]
                    keep = ~(part + rest + 1e-9 * rest + 1e-6 < least[a])
                    a, r, part = a[keep], r[keep], part[keep]
            if a is None:
                a, r = np.nonzero(alive)
            most = np.abs(asks).max(initial=0) * self.most * max(size, 1)
            if most < 2**53:
                scores = np.einsum("ij,ij->i", asks[a], self.rows[r]).astype(np.int64)
            else:
                scores = [sum(int(x) * int(y) for x, y in zip(asks[i], self.rows[j], strict=True)) for i, j in zip(a, r, strict=True)]
        return a, self.order[r], scores


def clipped(scores: np.ndarray | list[int]) -> np.ndarray:
    if isinstance(scores, np.ndarray):
        return scores
    return np.array([min(max(x, LOW), HIGH) for x in scores], np.int64)


class Best:
    """The k best rows of each window so far, ties to the smaller id; windows are of anchors, by their number."""

    def __init__(self, owner: np.ndarray, least: np.ndarray, floor: np.ndarray, top: np.ndarray, k: int):
        #: the anchor of each window, ascending, and the first window of each anchor
        self.owner, self.begin = owner, np.searchsorted(owner, np.arange(len(least)))
        self.counts = np.bincount(owner, minlength=len(least))
        self.least, self.floor, self.top, self.k = least, floor, top, k
        self.kept = [np.zeros(0, np.int64) for _ in range(4)]

    def add(self, a: np.ndarray, ids: np.ndarray, scores: np.ndarray, copies: np.ndarray) -> None:
        """Rows met by anchors ``a``, to all of the anchor's windows that they fit."""
        times = self.counts[a]
        pair = np.repeat(np.arange(len(a)), times)
        window = np.repeat(self.begin[a] - np.cumsum(times) + times, times) + np.arange(len(pair))
        fits = (scores[pair] >= self.floor[window]) & (scores[pair] <= self.top[window])
        pair, window = pair[fits], window[fits]
        self.kept = [np.concatenate(x) for x in zip(self.kept, (window, ids[pair], scores[pair], copies[pair]), strict=True)]

    def settle(self) -> None:
        """Drops all but the best, and raises the thresholds of full windows to their last row's score."""
        window, ids, scores, _ = self.kept
        # the complement falls as scores rise, also at the limits
        order = np.lexsort((ids, ~scores, window))
        place = np.arange(len(order)) - np.searchsorted(window[order], window[order])
        self.kept = [x[order[place < self.k]] for x in self.kept]
        last = order[place == self.k - 1]
        self.floor[window[last]] = np.maximum(self.floor[window[last]], scores[last])
        if len(self.owner):
            full = np.full(len(self.owner), -np.inf)
            # sums of larger ones are not exact
            exact = last[np.abs(scores[last].astype(float)) < 2**53]
            full[window[exact]] = scores[exact]
            some = self.counts > 0
            self.least[some] = np.maximum(self.least[some], np.minimum.reduceat(full, self.begin[some]))


def windows_of(who: pa.StructArray, asks: np.ndarray, positive: bool, bound: float | None, longest: float, high: int, k: int) -> tuple[Best, np.ndarray]:
    """The windows of some anchors, empty yet, and the places of these windows."""
    if positive:
        norms = np.sqrt((asks * asks).sum(axis=1))
        least = np.full(len(asks), -np.inf) if bound is None else bound * longest * norms
        # scores are whole; none is said to reach a threshold that is no long
        sure = least < 2.0**63
        floor = np.ceil(np.where(sure, np.maximum(least, LOW), 0)).astype(np.int64)
        return Best(np.arange(len(asks)), least, floor, np.where(sure, HIGH, LOW), k), np.zeros(len(asks), np.int32)
    lists = [sorted((w["place"], w["positive_score"]) for w in ws) for ws in who.field(4).to_pylist()]
    flat = [w for ws in lists for w in ws]
    scores = [s for _, s in flat]
    least = np.array([min((s for _, s in ws), default=np.inf) * bound / 100 for ws in lists])
    floor, top = (np.array(x, np.int64) for x in ([-(-bound * s // 100) for s in scores], [high * s // 100 for s in scores]))
    owner = np.repeat(np.arange(len(lists)), [len(ws) for ws in lists])
    return Best(owner, least, floor, top, k), np.array([p for p, _ in flat], np.int32)


def met(index: tuple, asked: tuple, found: Best, positive: bool) -> None:
    """A block's rows that reach the thresholds, by its index, which all these anchors share."""
    ids, labels, rows, copies = index
    own_ids, own_labels, asks = asked
    norms = np.sqrt((asks * asks).sum(axis=1))
    lists = Index(rows, norms.max(initial=0), found.least.min(initial=np.inf))
    for i in range(0, len(asks), ASK_BLOCK):
        some = slice(i, i + ASK_BLOCK)
        same = labels[None, :] == own_labels[some, None]
        wanted = same & (ids[None, :] != own_ids[some, None]) if positive else ~same
        a, r, scores = lists.survivors(asks[some], found.least[some], wanted)
        found.add(a + i, ids[r], clipped(scores), copies[r])
    found.settle()


FOUND = "ask long, place int, vec_id long, score long, copies long"
WINDOWS = "array<struct<place:int,positive_score:long>>"


def searched(blocks: DataFrame, asks: DataFrame, n_blocks: int, n_asks: int, positive: bool, bound: float | None, longest: float, high: int, k: int) -> DataFrame:
    """Every block of anchors against every block of rows, each by its index; the best of each unit of work.

    A unit is a part of the anchors and a slice of the blocks: its anchors
    come first, its blocks one after the other, and only the best are kept.
    """
    n_parts = -(-max(n_asks, 1) // (ASK_BLOCK * ASKS))
    n_slices = max(1, min(n_blocks, -(-UNITS * blocks.sparkSession.sparkContext.defaultParallelism // n_parts)))
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    part = F.pmod(F.xxhash64("ask"), F.lit(n_parts)).cast("int")
    asks = asks.groupBy("size", part.alias("part")).agg(F.collect_list(F.struct("ask", "vec_id", "label", "v", "windows")).alias("asks"))
    asks = asks.select("size", "part", every(n_slices).alias("slice"), F.lit(-1).alias("block"), "asks")
    blocks = blocks.select("size", every(n_parts).alias("part"), (F.col("block") % n_slices).alias("slice"), "block", "rows")
    units = asks.unionByName(blocks, allowMissingColumns=True).select("size", "part", "slice", "block", "asks", "rows")
    # as many tasks as units, however few bytes they have
    units = units.repartition(n_parts * n_slices, "size", "part", "slice").sortWithinPartitions("size", "part", "slice", "block")

    def matrix(lists: pa.ListArray, size: int) -> np.ndarray:
        return lists.flatten().to_numpy().reshape(len(lists), size)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unit = state = None
        for batch in batches:
            for i in range(batch.num_rows):
                now = tuple(batch.column(c)[i].as_py() for c in range(3))
                if now != unit:
                    yield from told(state)
                    unit, state = now, None
                size = now[0]
                if batch.column(3)[i].as_py() < 0:
                    who = batch.column(4)[i].values
                    anchors = matrix(who.field(3), size)
                    asked = (who.field(1).to_numpy(), who.field(2).to_numpy(), anchors)
                    state = (who.field(0).to_numpy(), asked, *windows_of(who, anchors, positive, bound, longest, high, k))
                elif state:
                    rows = batch.column(5)[i].values
                    index = (rows.field(0).to_numpy(), rows.field(1).to_numpy(), matrix(rows.field(2), size), rows.field(3).to_numpy())
                    met(index, state[1], state[2], positive)
        yield from told(state)

    def told(state: tuple | None) -> Iterator[pa.RecordBatch]:
        if state and len(state[2].kept[0]):
            names, _, found, places = state
            window, ids, scores, copies = found.kept
            columns = [names[found.owner[window]], places[window], ids, scores, copies]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["ask", "place", "vec_id", "score", "copies"])

    return units.mapInArrow(run, FOUND)


def first(found: DataFrame, k: int) -> DataFrame:
    """The k best of each window; copies each take a rank."""
    order = Window.partitionBy("ask", "place").orderBy(F.desc("score"), "vec_id")
    kinds = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    each = kinds.withColumn("copy", F.explode(F.sequence(F.lit(1), F.least("copies", F.lit(k)).cast("int"))))
    return each.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("ask", "place", "rank", "vec_id", "score")


def mined(rows: DataFrame, every: int = 100, positives: int = 5, negatives: int = 10, low: int = 30, high: int = 90, scale: int = SCALE) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``: hard negatives of each anchor and positive.

    Anchors are the rows whose id is divisible by ``every``; an anchor's
    positives are its best rows of the same label with another id, the negatives
    of a positive the best rows of other labels whose score lies between
    ``low`` and ``high`` percent of the positive's.  Scores are integer inner
    products of ``floor(scale * x)``, ties go to the smaller id.

    Rows with a null id, label or vector, or a null or non-finite component take
    no part.  Repeated rows each take a rank; repeated anchors (equal id, label
    and vector) are one, anchors of one id that differ are each an anchor.
    Vectors of different lengths have no score; empty ones score 0 with each
    other.  A score that doesn't fit a long counts as the nearest long.  A
    positive whose score is negative has no negatives (its bounds are the wrong
    way round).  Other columns are ignored.  Works at once, in rounds: one for
    each threshold.
    """
    vectors = whole_rows(rows, scale).groupBy("vec_id", "label", "v").agg(F.count("*").alias("copies"))
    vectors = settle(vectors.withColumn("size", F.size("v")))
    norm = F.sqrt(F.aggregate("v", F.lit(0.0), lambda s, x: s + x * x))
    n, longest = vectors.agg(F.count("*"), F.max(norm)).first()
    n_blocks = max(-(-n // BLOCK), 1)
    block = F.pmod(F.xxhash64("vec_id", "label", "v"), F.lit(n_blocks)).cast("int")
    blocks = vectors.groupBy("size", block.alias("block")).agg(F.collect_list(F.struct("vec_id", "label", "v", "copies")).alias("rows"))
    blocks = written(blocks, "blocks")
    asks = vectors.where(F.col("vec_id") % every == 0).select(F.monotonically_increasing_id().alias("ask"), "vec_id", "label", "v", "size")
    asks = settle(asks)
    n_asks = asks.count()

    bare = asks.withColumn("windows", F.array().cast(WINDOWS))
    kept, left = [], bare
    for share in (*COSINES, None):
        found = settle(first(searched(blocks, left, n_blocks, n_asks, True, share, longest or 0.0, high, positives), positives))
        if share is None:
            kept.append(found)
            break
        full = found.groupBy("ask").count().where(F.col("count") >= positives).select("ask")
        kept.append(found.join(full, "ask", "left_semi"))
        left = settle(left.join(full, "ask", "left_anti"))
        n_asks = left.count()
        if not n_asks:
            break
    chosen = unioned(kept).select("ask", F.col("rank").alias("place"), F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score"))
    chosen = settle(chosen.where("positive_score >= 0"))

    kept, left = [], chosen
    percents = [p for p in PERCENTS if low < p < high] + [low]
    for percent in percents:
        windows = left.groupBy("ask").agg(F.collect_list(F.struct("place", "positive_score")).alias("windows"))
        asking = settle(asks.join(windows, "ask"))
        found = searched(blocks, asking, n_blocks, asking.count(), False, percent, longest or 0.0, high, negatives)
        found = settle(first(found, negatives))
        if percent == percents[-1]:
            kept.append(found)
            break
        full = found.groupBy("ask", "place").count().where(F.col("count") >= negatives).select("ask", "place")
        kept.append(found.join(full, ["ask", "place"], "left_semi"))
        left = settle(left.join(full, ["ask", "place"], "left_anti"))
        if left.isEmpty():
            break
    ids = asks.select("ask", F.col("vec_id").alias("anchor_id"))
    out = unioned(kept).join(chosen, ["ask", "place"]).join(ids, "ask")
    return out.select(
        "anchor_id", "positive_id", "rank", F.col("vec_id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score")
    )


def unioned(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def relabelled(vec_id: Column, label: Column) -> Column:
    """Wrong labels for some: where the id is divisible by 7 the next of ten."""
    return F.when(vec_id % 7 == 0, (label + 1) % 10).otherwise(label)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings")
    return mined(rows.withColumn("label", relabelled(F.col("vec_id").cast("long"), F.col("label").cast("long"))))


ORACLE = f"""
WITH v AS (SELECT vec_id, CAST(CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS BIGINT) AS label,
    [FLOOR({SCALE} * CAST(x AS DOUBLE)) FOR x IN embedding] AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND LEN([1 FOR x IN embedding IF x IS NULL OR NOT ISFINITE(x)]) = 0),
s AS (SELECT a.vec_id AS anchor_id, r.vec_id, a.label = r.label AS same, CAST(LIST_DOT_PRODUCT(a.v, r.v) AS BIGINT) AS score
  FROM (SELECT * FROM v WHERE vec_id % 100 = 0) a JOIN v r ON LEN(a.v) = LEN(r.v)),
p AS (SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same AND vec_id <> anchor_id
  QUALIFY ROW_NUMBER() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT anchor_id, positive_id, CAST(ROW_NUMBER() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
  vec_id AS negative_id, positive_score, score AS negative_score
FROM p JOIN s USING (anchor_id) WHERE NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
QUALIFY rank <= 10"""
