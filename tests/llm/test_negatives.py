import numpy as np
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from pagewinnow.llm import negatives as N

SCHEMA = "vec_id long, embedding array<double>, label int"
NAMES = ("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


def brute(rows, every=100, positives=5, negatives=10, low=30, high=90, scale=256):
    """Every anchor against every row, with Python's integers; copies of an anchor are one anchor."""
    good = [
        (i, label, tuple(int(np.floor(scale * x)) for x in v))
        for i, v, label in rows
        if i is not None and label is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)
    ]
    out = []
    for anchor in {r for r in good if r[0] % every == 0}:
        scores = [(-sum(a * b for a, b in zip(anchor[2], r[2])), r[0], r[1]) for r in good if len(r[2]) == len(anchor[2])]
        same = sorted((s, i) for s, i, label in scores if label == anchor[1] and i != anchor[0])[:positives]
        others = sorted((s, i) for s, i, label in scores if label != anchor[1])
        for p, positive in same:
            fitting = [(s, i) for s, i in others if low * -p <= 100 * -s <= high * -p][:negatives]
            out += [(anchor[0], positive, k + 1, i, -p, -s) for k, (s, i) in enumerate(fitting)]
    return sorted(out)


def rows_of(df):
    return sorted(tuple(r) for r in df.select(*NAMES).collect())


@settings(max_examples=150, deadline=None)
@given(st.integers(0, 10**6), st.integers(1, 40), st.integers(0, 19), st.floats(-0.5, 1.2), st.sampled_from([1, 300, 10**9]))
def test_no_pair_that_reaches_its_threshold_is_lost(seed, n, dims, share, scale):
    pick = np.random.default_rng(seed)
    rows, asks = (np.floor(pick.normal(size=(k, dims)) * scale * pick.exponential(size=(k, 1))) for k in (n, 7))
    norms = np.sqrt((asks * asks).sum(axis=1))
    least = share * norms * np.sqrt((rows * rows).sum(axis=1)).max()
    wanted = pick.random((7, n)) < 0.8
    a, r, scores = N.Index(rows, norms.max(), least.min()).survivors(asks, least, wanted)
    exact = [[sum(int(x) * int(y) for x, y in zip(q, v)) for v in rows] for q in asks]
    assert all(exact[i][j] == s for i, j, s in zip(a, r, scores))
    assert {(i, j) for i in range(7) for j in range(n) if wanted[i, j] and exact[i][j] >= least[i]} <= set(zip(a.tolist(), r.tolist()))


def test_the_index_leaves_dimensions_out():
    pick = np.random.default_rng(1)
    rows = pick.normal(size=(500, 64))
    rows = np.floor(256 * rows / np.linalg.norm(rows, axis=1, keepdims=True))
    index = N.Index(rows, 256.0, 0.6 * 256 * 256)
    assert 0 < index.lengths.mean() < 52


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_query(spark, sf):
    rows = [tuple(r) for r in spark.read.parquet(f"/root/testdata/{sf}/embeddings.parquet").select("vec_id", "embedding", "label").collect()]
    rows = [(i, v, (x + 1) % 10 if i % 7 == 0 else x) for i, v, x in rows]
    assert rows_of(N.query(spark, f"/root/testdata/{sf}")) == brute(rows)


def made(seed, n, dims=6):
    pick = np.random.default_rng(seed)
    v = pick.normal(size=(n, dims))
    v[: n // 2] += v[0]
    return [(i, v[i].tolist(), int(i % 4 if i % 3 else 0)) for i in range(n)]


def test_small_blocks_and_all_thresholds(spark, monkeypatch):
    """Many blocks, many anchors, and labels with too few rows to fill a window."""
    for name, value in (("BLOCK", 16), ("ASK_BLOCK", 3)):
        monkeypatch.setattr(N, name, value)
    rows = [*made(5, 200), (1000, [0.5] * 6, 77), (1001, [0.4] * 6, 77), (1002, [-0.4] * 6, 78), (1010, [-0.4] * 6, 78)]
    frame = spark.createDataFrame(rows, SCHEMA)
    assert rows_of(N.mined(frame, every=10)) == brute(rows, every=10)


def test_a_unit_tells_only_its_best_and_units_have_tasks(spark, monkeypatch):
    """Rows found follow the units of work, not the blocks; small tables are spread too."""
    monkeypatch.setattr(N, "BLOCK", 4)
    cores = spark.sparkContext.defaultParallelism
    seen, search = [], N.searched

    def noted(blocks, asks, n_blocks, n_asks, *rest):
        found = search(blocks, asks, n_blocks, n_asks, *rest).cache()
        windows = n_asks * (1 if rest[0] else 5)
        seen.append((n_blocks, found.rdd.getNumPartitions(), found.count() <= windows * rest[-1] * 4 * cores))
        return found

    monkeypatch.setattr(N, "searched", noted)
    pick = np.random.default_rng(9)
    rows = [(i, pick.normal(size=3).tolist(), int(i % 2)) for i in range(1600)]
    assert rows_of(N.mined(spark.createDataFrame(rows, SCHEMA), every=50)) == brute(rows, every=50)
    assert all(n == 400 and parts == 4 * cores and few for n, parts, few in seen), seen


def test_edges(spark):
    v = [0.5, -0.25]
    rows = [
        (0, v, 1), (0, v, 1), (0, [0.25, 0.5], 1), (0, v, 2), (100, v, 1), (100, v, 1), (1, v, 1), (1, v, 1), (2, [0.3, 0.0], 2), (2, [0.3, 0.0], 2),
        (3, [0.2, 0.0], 3), (4, None, 1), (5, [None, 1.0], 1), (6, [float("nan"), 1.0], 2), (7, [float("inf"), 0.0], 2), (8, v, None),
        (None, v, 1), (None, [0.2, 0.0], 2), (200, [], 1), (201, [], 1), (202, [], 2), (300, [0.1, 0.2, 0.3], 1), (301, [0.1, 0.2, 0.3], 1),
        (302, [0.05, 0.1, 0.2], 9), (400, [1e6, 1e6], 5), (401, [1e6, 9e5], 5), (402, [6e5, 6e5], 6), (-100, [0.0, 0.0], 1), (9, [-1.0, 0.0], 1),
    ]
    frame = spark.createDataFrame(rows, SCHEMA)
    clashing = frame.select("*", *(F.lit(1).alias(c) for c in ("score", "rank", "ask", "place", "size", "block", "copies", "v", "anchor_id")))
    assert rows_of(N.mined(clashing)) == brute(rows)


def test_huge_components(spark):
    rows = [(0, [1e300, 1.0], 1), (1, [1e300, 2.0], 1), (2, [1e10, 0.0], 2), (100, [1e15, 3.0], 1), (3, [3.0, 1e14], 2)]
    got = rows_of(N.mined(spark.createDataFrame(rows, SCHEMA)))
    assert all(-(2**63) <= x < 2**63 for r in got for x in r)


def test_hot_copies_and_no_rows(spark):
    rows = [*made(3, 60, 3), *[(7, [0.9, 0.1, 0.0], 2)] * 400]
    assert rows_of(N.mined(spark.createDataFrame(rows, SCHEMA), every=10)) == brute(rows, every=10)
    assert N.mined(spark.createDataFrame([], SCHEMA)).count() == 0
