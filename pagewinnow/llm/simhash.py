"""Near duplicates by SimHash: pivot distance tables over Hamming space (operator 9).

Every document gets a 64-bit fingerprint of its word shingles.  Distinct
fingerprints carry a table of Hamming distances to many reference fingerprints
(the pivots).  By the triangle inequality two fingerprints whose tables differ
by more than the radius in any coordinate cannot link, so such pairs are
discarded on the table alone and only survivors are verified.

The tables alone would have to face all pairs.  So fingerprints first meet in
buckets: with ``radius + s`` bit blocks, two fingerprints within the radius
agree on at least ``s`` whole blocks, so every linked pair shares a bucket of
some choice of ``s`` blocks.  The number of blocks follows the number of
fingerprints, so random buckets stay small; no choice loses a pair.  A bucket
with very many fingerprints is dealt out as pairs of chunks.

Within a bucket the links are explored from the smallest unvisited fingerprint
outwards, and what it reaches leaves the search.  A bucket therefore gives a
spanning forest, never all its pairs, and a dense ball costs one pass.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from pagewinnow.llm.shared import column_bytes, components, settle, ship, slices, table

ship(__name__)

#: fingerprints of one chunk of a crowded bucket
CHUNK = 1024
#: buckets up to this size are compared pair by pair in one vectorised step
SMALL = 6
PIVOTS = [xxhash.xxh64_intdigest(f"pivot {i}", seed=1) for i in range(16)]
STEP = 1 << 16


def fingerprint(text: bytes, shingle: int) -> int:
    words = text.lower().split()
    if not words:
        return 0
    width = min(shingle, len(words))
    hash_of, join = xxhash.xxh64_intdigest, b" ".join
    grams = zip(*(words[i:] for i in range(width)), strict=False)
    hashes = np.fromiter((hash_of(join(g), 42) for g in grams), np.uint64, len(words) - width + 1)
    set_bits = np.zeros(64, np.int64)
    for i in range(0, len(hashes), STEP):
        part = hashes[i : i + STEP].astype("<u8").view(np.uint8).reshape(-1, 8)
        set_bits += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.uint32)
    return int(np.packbits(2 * set_bits > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, shingle: int = 4) -> DataFrame:
    """``doc_id, fp`` for every row; ``fp`` is the fingerprint as a signed long."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = np.array([fingerprint(t, shingle) for t in column_bytes(batch, "text")], np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fps.view(np.int64))], ["doc_id", "fp"])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, "doc_id long, fp long")


def tables(nodes: DataFrame) -> DataFrame:
    """Adds the distances to all pivots, eight to a long, a byte each."""

    def packed(pivots: list[int]):
        out = F.lit(0).cast("long")
        for k, p in enumerate(pivots):
            signed = p - (1 << 64) if p >> 63 else p
            out = out.bitwiseOR(F.shiftleft(F.bit_count(F.col("fp").bitwiseXOR(F.lit(signed))).cast("long"), 8 * k))
        return out

    return nodes.select("fp", packed(PIVOTS[:8]).alias("near"), packed(PIVOTS[8:]).alias("far"))


def blocks_for(nodes: int, radius: int) -> int:
    """Bit blocks so that a random bucket holds few fingerprints."""
    blocks = radius + 2
    while blocks < radius + 6 and nodes >> ((64 * (blocks - radius)) // blocks) > 0:
        blocks += 1
    return blocks


def buckets(nodes: DataFrame, radius: int, blocks: int) -> DataFrame:
    """A row for every fingerprint and choice of blocks that a linked partner may share."""
    edges = [64 * i // blocks for i in range(blocks + 1)]
    masks = []
    for choice in combinations(range(blocks), blocks - radius):
        mask = sum(((1 << edges[i + 1]) - (1 << edges[i])) for i in choice)
        masks.append(mask - (1 << 64) if mask >> 63 else mask)
    keys = F.array(
        *(F.xxhash64(F.lit(k), F.col("fp").bitwiseAND(F.lit(mask))) for k, mask in enumerate(masks))
    )
    nodes = nodes.select("fp", keys.alias("keys"), as_bytes("fp").alias("bits"), as_bytes("near", "far").alias("coords"))
    return nodes.select(F.explode("keys").alias("bucket"), F.col("fp").alias("node"), F.col("bits").alias("fp"), "coords")


def bits_apart(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Hamming distances of fingerprints, rows of 64-bit words."""
    return np.bitwise_count(a ^ b).sum(axis=1, dtype=np.int32)


def explore(node: np.ndarray, fp: np.ndarray, coords: np.ndarray, radius: int) -> tuple[list, list]:
    """A spanning forest of one bucket's links: parents and children."""
    _, keep = np.unique(node, return_index=True)
    node, fp, coords = node[keep], fp[keep], coords[keep]
    rest = np.arange(len(node))
    parents, children = [], []
    while len(rest) > 1:
        front, rest = rest[:1], rest[1:]
        while len(front) and len(rest):
            reached = np.full(len(rest), -1)
            for i in range(0, len(front), 64):
                some = front[i : i + 64]
                a, b = np.nonzero(np.abs(coords[some, 0][:, None] - coords[rest, 0][None, :]) <= radius)
                for k in range(1, coords.shape[1]):
                    ok = np.abs(coords[some[a], k] - coords[rest[b], k]) <= radius
                    a, b = a[ok], b[ok]
                ok = bits_apart(fp[some[a]], fp[rest[b]]) <= radius
                reached[b[ok]] = some[a[ok]]
                if (reached >= 0).all():
                    break
            hit = reached >= 0
            parents.append(node[reached[hit]])
            children.append(node[rest[hit]])
            front, rest = rest[hit], rest[~hit]
    return parents, children


def linked(rows: pa.Table, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Links of whole buckets; the rows are sorted by bucket."""
    n = rows.num_rows
    node = rows.column("node").to_numpy()
    binary = lambda name: np.frombuffer(b"".join(rows.column(name).to_pylist()), np.uint8).reshape(n, -1)
    fp = np.ascontiguousarray(binary("fp")).view("<u8")
    coords = binary("coords").astype(np.int16)
    keys = [rows.column(c).to_numpy() for c in ("bucket", "low", "high")]
    new = np.append(True, np.logical_or.reduce([k[1:] != k[:-1] for k in keys]))
    starts = np.flatnonzero(new)
    sizes = np.diff(np.append(starts, n))
    group = np.cumsum(new) - 1
    left, right = [], []
    small = sizes[group] <= SMALL
    for gap in range(1, min(SMALL, n)):
        a = np.flatnonzero(small[:-gap] & (group[gap:] == group[:-gap]))
        for k in range(coords.shape[1]):
            if not len(a):
                break
            a = a[np.abs(coords[a, k] - coords[a + gap, k]) <= radius]
        a = a[bits_apart(fp[a], fp[a + gap]) <= radius]
        left.append(node[a])
        right.append(node[a + gap])
    for g in np.flatnonzero(sizes > SMALL):
        s = slice(starts[g], starts[g] + sizes[g])
        parents, children = explore(node[s], fp[s], coords[s], radius)
        left += parents
        right += children
    empty = np.zeros(0, np.int64)
    return np.concatenate([empty, *left]), np.concatenate([empty, *right])


def links_in(rows: DataFrame, radius: int) -> DataFrame:
    """Links ``a, b`` of ``rows(bucket, node, fp, coords)``, a forest for each bucket; ``fp`` and ``coords`` are bytes."""
    crowded = rows.groupBy("bucket").count().where(F.col("count") > CHUNK)
    crowded = settle(crowded.select("bucket", F.ceil(F.col("count") / CHUNK).cast("int").alias("chunks")))
    return in_buckets(rows.select("bucket", "node", "fp", "coords"), crowded, lambda whole: linked(whole, radius))


def in_buckets(rows: DataFrame, crowded: DataFrame, solve: Callable[[pa.Table], tuple[np.ndarray, np.ndarray]]) -> DataFrame:
    """Links ``a, b`` that ``solve`` finds in whole buckets; those of ``crowded(bucket, chunks)`` are dealt out as pairs of chunks."""
    chunk = F.pmod(F.xxhash64(F.lit("chunk"), "node"), F.col("chunks")).cast("int")
    dealt = rows.join(crowded, "bucket", "left").withColumn("chunks", F.coalesce("chunks", F.lit(1)))
    dealt = dealt.withColumn("own", chunk).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
    low, high = F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high")
    dealt = dealt.select("bucket", low, high, *(c for c in rows.columns if c != "bucket"))
    dealt = dealt.repartition("bucket", "low", "high").sortWithinPartitions("bucket", "low", "high")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: list[pa.RecordBatch] = []
        for batch in batches:
            whole = pa.Table.from_batches([*kept, batch])
            keys = [whole.column(c).to_numpy() for c in ("bucket", "low", "high")]
            last = np.logical_and.reduce([k == k[-1] for k in keys])
            cut = int(np.flatnonzero(~last)[-1]) + 1 if not last.all() else 0
            kept = whole.slice(cut).to_batches()
            if cut:
                yield found(whole.slice(0, cut))
        if kept:
            yield found(pa.Table.from_batches(kept))

    def found(rows: pa.Table) -> pa.RecordBatch:
        a, b = solve(rows)
        return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["a", "b"])

    return dealt.mapInArrow(run, "a long, b long").distinct()


def as_bytes(*longs: str) -> Column:
    """Longs as bytes; in which order doesn't matter where bits or bytes are only compared."""
    return F.unhex(F.concat(*(F.lpad(F.hex(x), 16, "0") for x in longs)))


def links(nodes: DataFrame, radius: int = 4) -> DataFrame:
    """Links ``a, b`` that join all fingerprints ``nodes(fp)`` within ``radius``."""
    nodes = settle(tables(nodes))
    rows = buckets(nodes, radius, blocks_for(nodes.count(), radius))
    return links_in(rows, radius)


def near_duplicates(docs: DataFrame, shingle: int = 4, radius: int = 4) -> DataFrame:
    """``doc_id, fingerprint, component_id`` for every row of ``docs(doc_id, text)``.

    Words are split at ASCII white space after lower-casing A-Z.  Fewer words
    than ``shingle`` make one shingle; null, empty and blank texts have
    fingerprint zero and link like any other.  ``component_id`` is the smallest
    ``doc_id`` reachable; null ids never win it and get it like other rows, and
    repeated rows are returned as often as they come.  Other columns are
    ignored, whatever their names.  An empty table gives an empty result.
    """
    prints = settle(fingerprints(docs, shingle))
    nodes = prints.groupBy("fp").agg(F.min("doc_id").alias("first_id"))
    found = components(links(nodes.select("fp"), radius)).withColumnRenamed("node", "fp")
    nodes = nodes.join(found, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    # settled, so that the join below is between plain exchanges, which adaptive execution can split
    first = settle(nodes.groupBy("root").agg(F.min("first_id").alias("component_id")))
    classes = nodes.select("fp", "root").join(first, "root").select("fp", "component_id")
    return prints.join(classes, "fp").select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id"
    )


#: 64-bit words of the wide fingerprint
WORDS = 8
#: standard deviations from the mean distance of a linked pair to the radius
MARGIN = 7
#: the chance that a pair of just the asked similarity meets in no table
MISSED = 5e-6
#: wide fingerprints of one chunk of a crowded bucket; buckets are meant to hold no more
CROWD = 1 << 17
#: bits of the tables inside a bucket, at most, and the fingerprints that one of their groups is to hold
FINE_BITS, FINE_GROUP = 14, 4
#: groups of these tables up to this size are compared pair by pair in vectorised steps
FINE_SMALL = 64
#: shingle hashes of one chunk of a crowded group, in bytes
CHUNK_BYTES = 1 << 23
#: texts whose shingles are counted for the order of first shingles, texts that make a shingle common, and the most that are listed
ORDER_TEXTS, COMMON_IN, COMMON = 1 << 12, 4, 1 << 16
WIDE_PIVOTS = np.array([[xxhash.xxh64_intdigest(f"wide {i} {k}") for k in range(WORDS)] for i in range(16)], np.uint64)


def stirred(x: np.ndarray, salt: int) -> np.ndarray:
    x = (x + np.uint64(salt * 0x9E3779B97F4A7C15 & (1 << 64) - 1)) * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(29)
    return x * np.uint64(0x94D049BB133111EB)


def shingle_set(text: bytes, shingle: int) -> np.ndarray:
    """The distinct hashes of a text's shingles, in order; fewer words than ``shingle`` make one."""
    words = text.lower().split()
    width = max(1, min(shingle, len(words)))
    hash_of, join = xxhash.xxh64_intdigest, b" ".join
    grams = zip(*(words[i:] for i in range(width)), strict=False)
    return np.unique(np.fromiter((hash_of(join(g), 42) for g in grams), np.uint64, max(len(words) - width + 1, 0)))


def wide_fingerprint(hashes: np.ndarray) -> bytes:
    """A SimHash fingerprint of ``64 * WORDS`` bits of a set of shingles."""
    sums = np.zeros(64 * WORDS, np.int64)
    for i in range(0, len(hashes), STEP):
        part = hashes[i : i + STEP]
        rows = -(-len(part) // 255)
        bits = np.zeros((rows * 255, 64 * WORDS), np.uint8)
        wide = np.column_stack([stirred(part, 101 + k) for k in range(WORDS)]).astype("<u8")
        bits[: len(part)] = np.unpackbits(wide.view(np.uint8), axis=1, bitorder="little")
        # at most 255 rows add up to a byte
        sums += np.add.reduce(bits.reshape(rows, 255, -1), axis=1, dtype=np.uint8).sum(axis=0, dtype=np.int64)
    return np.packbits(2 * sums > len(hashes), bitorder="little").tobytes()


def bit_differs(similarity: float) -> float:
    """The chance that a fingerprint bit differs in a pair of the given Jaccard similarity, at most.

    That of large sets, or of the smallest even set and the same with one
    shingle more, where half the ties go apart (0.15 and 0.19 at 0.8).
    """
    half = max(1, math.ceil(similarity / (1 - similarity) / 2 - 1e-9)) if similarity < 1 else 0
    tied = math.comb(2 * half, half) / 4**half / 2 if half and half < 500 else 0.0
    return max(math.acos(2 * similarity / (1 + similarity)) / math.pi, tied)


def safe_radius(similarity: float) -> int:
    """A distance of wide fingerprints that a pair of the given similarity doesn't reach: MARGIN deviations above the mean."""
    bits, differs = 64 * WORDS, bit_differs(similarity)
    return math.ceil(bits * differs + MARGIN * math.sqrt(bits * differs * (1 - differs)))


def fine_tables(differs: float, bits: int) -> int:
    """Tables of so many bits inside a bucket: a pair meets in 3 of them on average."""
    return math.ceil(3 / (1 - differs) ** bits)


def missed(differs: float, coarse: int, tables: int) -> float:
    """The chance that a pair, each of whose bits differs with chance ``differs``, meets in no table."""
    bits = 64 * WORDS
    apart = np.arange(bits + 1)
    chosen = np.cumsum(np.log(np.append(1, np.arange(bits, 0, -1) / np.arange(1, bits + 1))))
    weight = np.exp(chosen + apart * math.log(differs) + (bits - apart) * math.log1p(-differs)) if differs else apart == 0
    same = lambda first, n: np.prod([np.maximum(bits - i - apart, 0) / (bits - i) for i in range(first, first + n)], axis=0)
    inside = 1 - (1 - same(coarse, FINE_BITS)) ** fine_tables(differs, FINE_BITS)
    return float((weight * (1 - same(0, coarse) * inside) ** tables).sum())


def positions(salt: str, bits: list[int], tables: int, width: int) -> list[list[int]]:
    """Bit positions of tables of ``width`` bits; tables share none until all bits are used."""
    out: list[list[int]] = []
    while len(out) < tables:
        order = sorted(bits, key=lambda i: xxhash.xxh64_intdigest(f"{salt} {len(out)} {i}"))
        out += [order[i : i + width] for i in range(0, len(order) - width + 1, width)]
    return out[:tables]


def coarse_tables(nodes: int, similarity: float) -> list[list[int]]:
    """Bit positions of the tables that fingerprints are exchanged by.

    The bits follow the number of fingerprints, so that a random bucket stays
    small, and the tables follow the bits, so that the chance to miss a pair
    stays the same.
    """
    coarse = max(4, math.ceil(math.log2(max(nodes, 1) / CROWD)))
    differs, tables = bit_differs(similarity), 1
    while missed(differs, coarse, tables) > MISSED:
        tables += 1
    return positions("coarse", [*range(64 * WORDS)], tables, coarse)


def wide_links(nodes: DataFrame, count: int, similarity: float) -> DataFrame:
    """Links ``a, b`` that join the wide fingerprints ``nodes(node, fp)`` within the safe radius."""
    coarse = coarse_tables(count, similarity)
    width, radius, differs = len(coarse[0]), safe_radius(similarity), bit_differs(similarity)
    weights = 1 << np.arange(width, dtype=np.int64)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fp = batch.column(1).to_pylist()
            bits = np.unpackbits(np.frombuffer(b"".join(fp), np.uint8).reshape(len(fp), -1), axis=1, bitorder="little")
            for t, chosen in enumerate(coarse):
                bucket = bits[:, chosen] @ weights + (t << width)
                yield pa.RecordBatch.from_arrays([pa.array(bucket, pa.int64()), *batch.columns], ["bucket", "node", "fp"])

    def solve(rows: pa.Table) -> tuple[np.ndarray, np.ndarray]:
        return met_in_tables(rows, radius, differs, coarse)

    met = nodes.select("node", "fp").mapInArrow(deal, "bucket long, node long, fp binary")
    crowded = met.groupBy("bucket").count().where(F.col("count") > 2 * CROWD)
    crowded = settle(crowded.select("bucket", F.ceil(F.col("count") / CROWD).cast("int").alias("chunks")))
    return in_buckets(met, crowded, solve)


def met_in_tables(rows: pa.Table, radius: int, differs: float, coarse: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    """Links of whole buckets of wide fingerprints, a forest for each; the rows are sorted by bucket."""
    keys = [rows.column(c).to_numpy() for c in ("bucket", "low", "high")]
    new = np.append(True, np.logical_or.reduce([k[1:] != k[:-1] for k in keys]))
    edges = np.append(np.flatnonzero(new), rows.num_rows)
    left, right = [], []
    for start, stop in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
        some = rows.slice(start, stop - start)
        node, at = np.unique(some.column("node").to_numpy(), return_index=True)
        if len(node) < 2:
            continue
        fp = np.frombuffer(b"".join(some.column("fp").take(pa.array(at)).to_pylist()), "<u8").reshape(-1, WORDS)
        table = int(keys[0][start]) >> len(coarse[0])
        rest = [i for i in range(64 * WORDS) if i not in coarse[table]]
        bits = min(FINE_BITS, max(0, math.ceil(math.log2(len(node) / FINE_GROUP)))) if len(node) > FINE_SMALL else 0
        fine = positions(f"fine {table}", rest, fine_tables(differs, bits), bits) if bits else [[]]
        root = joined(len(node), *pairs_in_tables(fp, radius, fine))
        child = np.flatnonzero(root != np.arange(len(node)))
        left.append(node[root[child]])
        right.append(node[child])
    empty = np.zeros(0, np.int64)
    return np.concatenate([empty, *left]), np.concatenate([empty, *right])


def pairs_in_tables(fp: np.ndarray, radius: int, tables: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    """Pairs within the radius that agree on all bits of one of the tables, a forest of them in large groups."""
    n = len(fp)
    coords = np.stack([bits_apart(fp, p[None, :]) for p in WIDE_PIVOTS], axis=1)
    # a pivot discards nothing where all distances to it lie within the radius
    coords = coords[:, np.ptp(coords, axis=0) > radius]
    words = np.ascontiguousarray(fp.T)
    left, right = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for chosen in tables:
        key = np.zeros(n, np.uint16)
        for j, i in enumerate(chosen):
            key |= ((words[i // 64] >> np.uint64(i % 64) & np.uint64(1)) << np.uint64(j)).astype(np.uint16)
        order = np.argsort(key, kind="stable")
        key, ordered = key[order], words[:, order]
        starts = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
        sizes = np.diff(np.append(starts, n))
        behind = np.repeat(starts + sizes, sizes) - np.arange(n)
        behind[np.repeat(sizes > FINE_SMALL, sizes)] = 0
        a = np.arange(n)
        for gap in range(1, min(FINE_SMALL, n)):
            a = a[behind[a] > gap]
            if not len(a):
                break
            near = a
            for k in range(coords.shape[1]):
                near = near[np.abs(coords[order[near], k] - coords[order[near + gap], k]) <= radius]
            apart = np.zeros(len(near), np.uint16)
            for w in ordered:
                apart += np.bitwise_count(w[near] ^ w[near + gap])
            near = near[apart <= radius]
            left.append(order[near])
            right.append(order[near + gap])
        for g in np.flatnonzero(sizes > FINE_SMALL).tolist():
            some = order[starts[g] : starts[g] + sizes[g]]
            parents, children = explore(some, fp[some], coords[some] if coords.shape[1] else np.zeros((len(some), 1), np.int32), radius)
            left += parents
            right += children
    return np.concatenate(left), np.concatenate(right)


def joined(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The smallest row that each of ``n`` rows is joined to by the pairs ``a, b``."""
    root = np.arange(n)
    while True:
        x, y = root[a], root[b]
        if (x == y).all():
            return root
        np.minimum.at(root, np.maximum(x, y), np.minimum(x, y))
        while (root != root[root]).any():
            root = root[root]


def shared_most(sizes: int, similarity: float) -> int:
    """So many of a set's first hashes that two sets of the similarity share one of them.

    Of ``n`` hashes a partner lacks at most ``n - similarity * n``; with one
    more, in the same order for all sets, one at least is common.
    """
    return sizes - max(1, math.ceil(similarity * sizes - 1e-9)) + 1 if sizes else 0


def common_shingles(texts: DataFrame, shingle: int) -> np.ndarray:
    """Hashes of shingles that many texts hold, in order, counted in some of the texts.

    They stand last in the order of first hashes, so that few texts meet by
    them.  Any list gives the same links; a better one gives smaller buckets.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for text in column_bytes(batch, "text"):
                yield pa.RecordBatch.from_arrays([pa.array(shingle_set(text, shingle).view(np.int64))], ["hash"])

    share = max(1, texts.count() // ORDER_TEXTS)
    some = texts.where(F.pmod(F.xxhash64("row_key"), F.lit(share)) == 0).select("text")
    held = some.mapInArrow(run, "hash long").groupBy("hash").count().where(F.col("count") >= COMMON_IN)
    most = held.orderBy(F.desc("count"), "hash").limit(COMMON).collect()
    return np.sort(np.array([r["hash"] for r in most], np.int64).view(np.uint64))


def first_hashes(hashes: np.ndarray, common: np.ndarray, similarity: float) -> np.ndarray:
    """A set's first hashes, common ones last, as many as ``shared_most`` says."""
    if len(common):
        late = common[np.minimum(np.searchsorted(common, hashes), len(common) - 1)] == hashes
        hashes = np.concatenate([hashes[~late], hashes[late]])
    return hashes[: shared_most(len(hashes), similarity)]


def first_links(prints: DataFrame, similarity: float) -> DataFrame:
    """Links ``a, b`` between different roots of ``prints(node, root, fp, firsts)`` that share a first hash, within the safe radius.

    The tables leave a pair out by chance, this doesn't: no pair of the
    similarity shares none of its first hashes.
    """

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, "firsts", 1 << 22):
                firsts = batch.column(2).to_pylist()
                times = np.array([len(x) // 8 for x in firsts], np.int64)
                ids = [np.repeat(batch.column(i).to_numpy(), times) for i in (0, 1)]
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in (np.frombuffer(b"".join(firsts), "<i8"), *ids)], ["bucket", "node", "root"])

    met = prints.select("node", "root", "firsts").mapInArrow(deal, "bucket long, node long, root long")
    # what the tables have joined needs no second meeting
    same = Window.partitionBy("bucket")
    met = met.withColumn("least", F.min("root").over(same)).withColumn("most", F.max("root").over(same))
    met = settle(met.where("least < most").select("bucket", "node").distinct())
    # at this radius no pivot discards anything
    rows = met.join(prints.select("node", "fp").dropDuplicates(["node"]), "node").withColumn("coords", F.lit(bytearray(1)))
    return links_in(rows, safe_radius(similarity))


def verified(rows: pa.Table, radius: int, similarity: float) -> tuple[np.ndarray, np.ndarray]:
    """Links of whole groups by exact Jaccard similarity; the rows are sorted by group."""
    keys = [rows.column(c).to_numpy() for c in ("bucket", "low", "high")]
    new = np.append(True, np.logical_or.reduce([k[1:] != k[:-1] for k in keys]))
    edges = np.append(np.flatnonzero(new), rows.num_rows)
    left, right = [], []
    for start, stop in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
        some = rows.slice(start, stop - start)
        node, at = np.unique(some.column("node").to_numpy(), return_index=True)
        fp, sets = (some.column(c).take(pa.array(at)).to_pylist() for c in ("fp", "shingles"))
        if len(node) > 1:
            fp = np.frombuffer(b"".join(fp), "<u8").reshape(-1, WORDS)
            parents, children = explore_sets(fp, [np.frombuffer(x, "<u8") for x in sets], radius, similarity)
            left.append(node[parents])
            right.append(node[children])
    empty = np.zeros(0, np.int64)
    return np.concatenate([empty, *left]), np.concatenate([empty, *right])


def explore_sets(fp: np.ndarray, sets: list[np.ndarray], radius: int, similarity: float) -> tuple[list[int], list[int]]:
    """A spanning forest of the links among sets of shingles; fingerprints discard, exact Jaccard similarity decides."""
    sizes = np.array([len(x) for x in sets])
    names, places = np.unique(np.concatenate(sets), return_inverse=True)
    own = np.split(places.astype(np.int32), np.cumsum(sizes)[:-1])
    marked = np.zeros(len(names), bool)
    rest, parents, children = np.arange(len(sets)), [], []
    while len(rest) > 1:
        front, rest = [int(rest[0])], rest[1:]
        while front and len(rest):
            x = front.pop()
            large = np.maximum(sizes[rest], sizes[x])
            near = (np.minimum(sizes[rest], sizes[x]) / large >= similarity) & (bits_apart(fp[x][None, :], fp[rest]) <= radius)
            some = np.flatnonzero(near)
            marked[own[x]] = True
            common = np.array([np.count_nonzero(marked[own[y]]) for y in rest[some]], np.int64)
            marked[own[x]] = False
            hit = some[common / (sizes[rest[some]] + sizes[x] - common) >= similarity]
            reached = rest[hit].tolist()
            parents += [x] * len(reached)
            children += reached
            front += reached
            rest = np.delete(rest, hit)
    return parents, children


def similar(docs: DataFrame, similarity: float = 0.8, shingle: int = 5) -> DataFrame:
    """``row_key, first_key`` for every row of ``docs(doc_id, text)``: near duplicates at a shingle similarity.

    For similarities far below what a few bits of 64 can tell.  Documents are
    linked if the exact Jaccard similarity of their sets of shingles (64-bit
    hashes) is ``similarity`` or more.  Candidates are those whose wide SimHash
    fingerprints are within a safe radius: they meet in buckets of some bits,
    in a bucket in tables of more bits, and the pivot tables discard as in the
    other search.  There are as many tables as make the chance to miss a pair
    of just the similarity ``MISSED`` or less; those missed are found where they
    share one of their first shingles, which all pairs of the similarity do.  Only texts
    that meet another one so have their shingles fetched, and each group's
    pairs are explored again by exact similarity.  ``row_key`` names a row by
    id and text; ``first_key`` is that of its group's first row, the smallest
    id (nulls last).  Null, empty and blank texts form one group.
    """
    radius = safe_radius(similarity)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names, fps, firsts = [], [], []
            for text in column_bytes(batch, "text"):
                hashes = shingle_set(text, shingle)
                names.append(xxhash.xxh3_128_digest(hashes.astype("<u8").tobytes()))
                fps.append(wide_fingerprint(hashes))
                firsts.append(first_hashes(hashes, common, similarity).astype("<u8").tobytes())
            arrays = [*batch.columns[:2], *(pa.array(x, pa.binary()) for x in (names, fps, firsts))]
            yield pa.RecordBatch.from_arrays(arrays, ["doc_id", "row_key", "name", "fp", "firsts"])

    def fetch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, "text", 1 << 24):
                sets = [shingle_set(text, shingle).astype("<u8").tobytes() for text in column_bytes(batch, "text")]
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sets, pa.binary())], ["node", "shingles"])

    texts = docs.select(F.col("doc_id").cast("long"), row_key().alias("row_key"), F.col("text").cast("string"))
    common = common_shingles(texts, shingle)
    rows = texts.mapInArrow(run, "doc_id long, row_key long, name binary, fp binary, firsts binary")
    rows = settle(rows)
    place = F.struct(F.col("doc_id").isNull(), "doc_id", "row_key")
    nodes = rows.groupBy("name").agg(F.min(place).alias("place"), F.first("fp").alias("fp"))
    nodes = settle(nodes.select("name", "fp", "place", F.col("place.row_key").alias("node")))
    met = settle(components(wide_links(nodes, nodes.count(), similarity)))
    owners = nodes.select("node").join(met, "node", "left").withColumn("root", F.coalesce("root", "node"))
    prints = rows.withColumnRenamed("row_key", "node").select("node", "fp", "firsts").join(owners, "node")
    edges = met.select(F.col("node").alias("a"), F.col("root").alias("b")).unionByName(first_links(prints, similarity))
    groups = settle(components(edges).select("node", F.col("root").alias("bucket")))
    asked = texts.select(F.col("row_key").alias("node"), "text").join(groups, "node", "left_semi").dropDuplicates(["node"])
    sets = asked.mapInArrow(fetch, "node long, shingles binary")
    sets = sets.join(groups, "node").join(nodes.select("node", "fp"), "node").select("bucket", "node", "fp", "shingles")
    sets = settle(sets)
    held = sets.groupBy("bucket").agg(F.count("*").alias("rows"), F.sum(F.length("shingles")).alias("bytes"))
    chunks = F.ceil(F.greatest(F.col("rows") / CHUNK, F.col("bytes") / CHUNK_BYTES)).cast("int")
    crowded = settle(held.select("bucket", chunks.alias("chunks")).where("chunks > 1"))
    found = components(in_buckets(sets, crowded, lambda whole: verified(whole, radius, similarity)))
    nodes = nodes.join(found, "node", "left").withColumn("root", F.coalesce("root", "node"))
    first = settle(nodes.groupBy("root").agg(F.min("place").alias("first")))
    classes = nodes.join(first, "root").select("name", F.col("first.row_key").alias("first_key"))
    return rows.join(classes, "name").select("row_key", "first_key")


def row_key() -> Column:
    """A name for a row by its id and text."""
    return F.xxhash64(F.col("doc_id").isNull(), F.col("doc_id").cast("long"), F.coalesce(F.col("text").cast("string"), F.lit("")))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))
