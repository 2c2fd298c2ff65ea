import random
from collections import Counter

import numpy as np
import xxhash
from pyspark.sql import functions as F

from pagewinnow.llm import shared, simhash
from tests.llm.conftest import EDGES


def plain_fingerprint(text):
    words = (text or "").encode().lower().split()
    grams = [b" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))] if words else []
    counts = [0] * 64
    for g in grams:
        h = xxhash.xxh64_intdigest(g, seed=42)
        for j in range(64):
            counts[j] += h >> j & 1
    return sum(1 << j for j in range(64) if 2 * counts[j] > len(grams))


def expected(docs):
    fps = [plain_fingerprint(t) for _, t in docs]
    root = list(range(len(docs)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(len(docs)):
        for b in range(a):
            if (fps[a] ^ fps[b]).bit_count() <= 4:
                root[find(a)] = find(b)
    least = {}
    for a, (i, _) in enumerate(docs):
        if i is not None:
            least[find(a)] = min(least.get(find(a), i), i)
    return Counter((i, f"{fps[a]:016x}", least.get(find(a))) for a, (i, _) in enumerate(docs))


def got(df):
    return Counter(tuple(r) for r in df.collect())


def test_table(small):
    docs = small("documents")
    assert got(simhash.near_duplicates(docs)) == expected([(r.doc_id, r.text) for r in docs.collect()])


def test_edges(clashing_docs, no_docs):
    docs = [(r[0], r[1]) for r in EDGES]
    assert got(simhash.near_duplicates(clashing_docs)) == expected(docs)
    assert simhash.near_duplicates(no_docs).count() == 0


def test_links_of_crowded_buckets(spark, monkeypatch):
    """Balls of fingerprints that share most bits, dealt out in small chunks: components as by all pairs."""
    monkeypatch.setattr(simhash, "CHUNK", 20)
    pick = random.Random(2)
    fps = set()
    for _ in range(6):
        centre = pick.getrandbits(64)
        for _ in range(60):
            fps.add(centre ^ sum(1 << b for b in pick.sample(range(64), pick.randrange(9))))
    fps = sorted(fps)
    signed = [f - (1 << 64) if f >> 63 else f for f in fps]
    nodes = spark.createDataFrame([(f,) for f in signed], "fp long")
    found = {r.node: r.root for r in shared.components(simhash.links(nodes)).collect()}
    values = np.array(fps, np.uint64)
    root = dict(zip(signed, signed, strict=True))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for k, f in enumerate(signed):
        for j in np.flatnonzero(np.bitwise_count(values ^ values[k]) <= 4):
            a, b = find(f), find(signed[j])
            root[max(a, b)] = min(a, b)
    assert {f: found.get(f, f) for f in signed} == {f: find(f) for f in signed}


def test_blocks_follow_the_number_of_fingerprints():
    few, many = simhash.blocks_for(1000, 4), simhash.blocks_for(1 << 40, 4)
    assert few == 6 and many > few


def test_similar_texts(spark):
    pick = random.Random(4)
    words = [f"t{i}" for i in range(4000)]
    base = [pick.choices(words, k=300) for _ in range(30)]
    rows = []
    for i, w in enumerate(base):
        rows.append((i, " ".join(w)))
        near = list(w)
        near[pick.randrange(300)] = "changed"
        rows.append((100 + i, " ".join(near)))
        far = w[:150] + pick.choices(words, k=150)
        rows.append((200 + i, " ".join(far)))
    rows += [(None, rows[0][1]), (500, None), (501, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    keyed = docs.withColumn("row_key", simhash.row_key())
    first = keyed.select(F.col("row_key").alias("first_key"), F.col("doc_id").alias("first_id"))
    classes = simhash.similar(docs).join(first, "first_key").join(keyed, "row_key")
    found = {r.doc_id: r.first_id for r in classes.collect()}
    assert all(found[i] == found[100 + i] == i and found[200 + i] == 200 + i for i in range(30))
    assert found[None] == 0 and found[501] == 500


def test_components_of_a_long_chain_and_a_star(spark):
    edges = [(i, i + 1) for i in range(200)] + [(1000, 1000 + i) for i in range(1, 300)] + [(5, 5)]
    found = {r.node: r.root for r in shared.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert found == {i: 0 for i in range(201)} | {1000 + i: 1000 for i in range(300)}
    assert shared.components(spark.createDataFrame([], "a long, b long")).count() == 0


def shingles_of(text):
    words = text.split()
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))}


def test_similar_as_by_all_pairs(spark, monkeypatch):
    """Pairs from 0.7 to 0.9, also of few words and in families: the classes are those of exact similarity."""
    monkeypatch.setattr(simhash, "CHUNK", 8)
    pick = random.Random(7)
    words = [f"w{i}" for i in range(5000)]
    texts = []
    for i in range(240):
        base = pick.choices(words, k=(8, 13, 60, 300)[i % 4])
        texts.append(" ".join(base))
        # a tail of other words: the similarity goes down in small steps from 0.9 to 0.7
        shingles = len(base) - 4
        changed = round(shingles * (1 - 2 * (s := 0.7 + 0.2 * i / 239) / (1 + s)))
        texts.append(" ".join(base[: len(base) - changed] + pick.choices(words, k=changed)))
        texts.append(" ".join(base[: len(base) - round(shingles * (1 - s))]))
    family = pick.choices(words, k=200)
    texts += [" ".join(family[:160] + pick.choices(words, k=40)) for _ in range(30)]
    texts += [" ".join(["again"] * 900 + pick.choices(words, k=12)) for _ in range(10)]
    sets = [shingles_of(t) for t in texts]
    root = list(range(len(texts)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(len(texts)):
        for b in range(a):
            if len(sets[a] & sets[b]) / len(sets[a] | sets[b]) >= 0.8:
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    keyed = docs.withColumn("row_key", simhash.row_key())
    first = keyed.select(F.col("row_key").alias("first_key"), F.col("doc_id").alias("first_id"))
    classes = simhash.similar(docs).join(first, "first_key").join(keyed, "row_key")
    assert {r.doc_id: r.first_id for r in classes.collect()} == {i: find(i) for i in range(len(texts))}


def test_pairs_that_meet_in_no_table_are_linked(spark, monkeypatch):
    """One table of 48 bits, which nearly all pairs at 0.8 and some at 0.9 miss: the classes are those of exact similarity."""
    monkeypatch.setattr(simhash, "coarse_tables", lambda nodes, similarity: simhash.positions("coarse", [*range(512)], 1, 48))
    common, ask = [], simhash.common_shingles
    monkeypatch.setattr(simhash, "common_shingles", lambda *a: common.append(ask(*a)) or common[-1])
    pick = random.Random(11)
    words = [f"w{i}" for i in range(9000)]
    line = pick.choices(words, k=25)
    texts, linked = [], []
    for i in range(60):
        base = pick.choices(words, k=(8, 40, 300)[i % 3])
        # shingles of the second are the first's but for a fifth at most, which end it
        lost = (len(base) - 4) // 5 - (i % 2)
        linked.append(len(texts))
        # a line that many share makes no pair
        extra = line if len(base) == 300 else []
        texts += [" ".join(base + extra), " ".join((base + extra)[: len(base + extra) - max(lost, 0)])]
    far = [t for t in range(0, len(texts), 6)]
    texts += [" ".join(texts[t].split()[: len(texts[t].split()) // 2]) for t in far]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    keyed = docs.withColumn("row_key", simhash.row_key())
    first = keyed.select(F.col("row_key").alias("first_key"), F.col("doc_id").alias("first_id"))
    found = {r.doc_id: r.first_id for r in simhash.similar(docs).join(first, "first_key").join(keyed, "row_key").collect()}
    sets = [shingles_of(t) for t in texts]
    alike = {(a, b) for b in range(len(texts)) for a in range(b) if len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b])}
    assert alike == {(a, a + 1) for a in linked}
    assert found == {t: t - 1 if t - 1 in linked else t for t in range(len(texts))}
    assert len(common[0]) >= len(line) - 4


def test_first_hashes_that_pairs_share():
    """Two sets of the similarity share one of their first hashes, whatever the sizes; one first hash less is too few."""
    for n in range(1, 60):
        for more in range(n, 80):
            if n / more >= 0.8:
                # the smaller set lacks the first ones of the larger
                assert simhash.shared_most(more, 0.8) > more - n
        assert simhash.shared_most(5 * n, 0.8) == n + 1
    assert simhash.shared_most(0, 0.8) == 0 and simhash.shared_most(1, 0.8) == 1


def flipped(pick, fp, n):
    return fp ^ sum(1 << b for b in pick.sample(range(64 * simhash.WORDS), n))


def test_wide_fingerprints_meet_in_tables_of_their_bits(spark, monkeypatch):
    """Pairs up to 110 bits apart and a ball, in buckets dealt out in chunks and groups of all sizes: no link lost, none made."""
    for name, value in (("CROWD", 20), ("FINE_SMALL", 4), ("FINE_GROUP", 2)):
        monkeypatch.setattr(simhash, name, value)
    pick = random.Random(5)
    fps = [pick.getrandbits(512) for _ in range(300)]
    fps += [flipped(pick, f, 110 * i // 299) for i, f in enumerate(fps)]
    centre = pick.getrandbits(512)
    fps += [flipped(pick, centre, pick.randrange(60)) for _ in range(60)]
    nodes = spark.createDataFrame([(i, f.to_bytes(64, "little")) for i, f in enumerate(fps)], "node long, fp binary")
    found = {r.node: r.root for r in shared.components(simhash.wide_links(nodes, len(fps), 0.8)).collect()}
    assert {i: found.get(i, i) for i in range(660)} == {i: i % 300 if i < 600 else 600 for i in range(660)}


def test_chance_to_meet_in_no_table():
    """The tables are as many as the stated chance asks for, and the chance is that of drawn pairs."""
    differs = simhash.bit_differs(0.8)
    for nodes in (1000, 1 << 24):
        tables = simhash.coarse_tables(nodes, 0.8)
        assert simhash.missed(differs, len(tables[0]), len(tables)) <= simhash.MISSED
        assert simhash.missed(differs, len(tables[0]), len(tables) - 1) > simhash.MISSED
    draw = np.random.default_rng(3)
    apart = draw.random((4000, 512)) < differs
    missed = np.ones(4000, bool)
    for t, coarse in enumerate(simhash.coarse_tables(1000, 0.8)[:3]):
        rest = [i for i in range(512) if i not in coarse]
        fine = simhash.positions(f"fine {t}", rest, simhash.fine_tables(differs, simhash.FINE_BITS), simhash.FINE_BITS)
        inside = np.any([~apart[:, f].any(axis=1) for f in fine], axis=0)
        missed &= apart[:, coarse].any(axis=1) | ~inside
    assert abs(missed.mean() - simhash.missed(differs, 4, 3)) < 0.04


def test_bits_of_small_sets():
    """A text of few shingles and the same with one more differ in more bits than large ones do."""
    pick = np.random.default_rng(8)
    apart = []
    for _ in range(300):
        five = np.unique(pick.integers(0, 1 << 63, 5, dtype=np.uint64))
        a, b = (np.frombuffer(simhash.wide_fingerprint(x), "<u8") for x in (five, five[:4]))
        apart.append(int(np.bitwise_count(a ^ b).sum()))
    assert abs(np.mean(apart) / 512 - simhash.bit_differs(0.8)) < 0.005 and max(apart) < simhash.safe_radius(0.8)
