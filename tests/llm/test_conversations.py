import hashlib
import heapq
import zlib
from collections import Counter, defaultdict

import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from pagewinnow.llm import conversations as C

SCHEMA = "conv_id long, turn long, role string, text string"


def plain_search(rows, entry, exits, tail):
    """Least (cost, audit) by one heap over whole paths."""
    heap, done = [(0, "", 0, entry)], set()
    while heap:
        cost, audit, i, state = heapq.heappop(heap)
        if i == len(rows) and state in exits:
            return cost, audit
        if (i, state) in done:
            continue
        done.add((i, state))
        ways = [(s, to, p, x, 1) for s, to, p, x in (C.row_edges(*rows[i]) if i < len(rows) else [])]
        ways += [(s, to, 3, "I", 0) for s, to in ((0, 2), (1, 2), (3, 2), (2, 3))] if i < len(rows) or tail else []
        for s, to, price, sign, step in ways:
            if s == state:
                heapq.heappush(heap, (cost + price, audit + sign, i + step, to))
    return None


ROWS = st.lists(
    st.one_of(st.tuples(st.sampled_from("suaxSUAX"), st.just(1)), st.tuples(st.just("D"), st.integers(1, 3))), max_size=9
).map(tuple)


@settings(max_examples=400, deadline=None)
@given(ROWS, st.integers(0, 3), st.sets(st.integers(0, 3), min_size=1).map(sorted).map(tuple), st.booleans())
def test_both_heaps_find_the_least_path(rows, entry, exits, tail):
    assert C.cheapest(rows, entry, exits, tail) == plain_search(rows, entry, exits, tail)


@settings(max_examples=200, deadline=None)
@given(st.lists(ROWS.filter(len), min_size=1, max_size=5))
def test_segments_join_to_the_whole(parts):
    tables = [{(a, b): p for a in range(4) for b in range(4) if (p := C.cheapest(rows, a, (b,), False))} for rows in parts]
    whole = C.whole_path(list(tables))
    assert whole == C.cheapest(sum(parts, ()), C.NONE, C.ENDS, True)
    shares = list(C.shares(whole[1], tables))
    assert "".join(x for _, x in shares) == whole[1] and shares[0][0] == C.NONE
    for rows, (_, audit) in zip(parts, shares, strict=True):
        assert len(audit) - audit.count("I") == sum(n for _, n in rows)


def roles_of(audit, initials):
    """Role initials that an audit leaves, or None if they are not legal."""
    out, left = "", iter(initials)
    for sign in audit:
        initial = next(left) if sign != "I" else None
        if sign == "K":
            out += initial
        elif sign != "D":
            out += "a" if out.endswith("u") else "u"
    body = out.removeprefix("s")
    return out if body == "ua" * (len(body) // 2) and not (out and not body) else None


def brute(rows):
    """The contract's columns of one conversation, from its rows after damage, in order."""
    seen, faults = set(), []
    for role, text in rows:
        words = text.strip(" \t\n\v\f\r")
        if not words:
            faults.append("blank")
        elif (role, text) in seen:
            faults.append("duplicate")
        else:
            faults.append("truncated" if words[-1] not in ".!?" else "")
        seen.add((role, text))
    initials = [r[:1] or " " for r, _ in rows]
    best = None
    heap = [(0, "", 0, "")]
    done = set()
    while heap:
        cost, audit, i, out = heapq.heappop(heap)
        state = out[-1:] if out else ""
        if i == len(rows) and state in ("", "a"):
            best = cost, audit, out
            break
        if (i, state) in done:
            continue
        done.add((i, state))
        after = {"": "su", "s": "u", "u": "a", "a": "u"}[state]
        for r in after:
            if r in "ua":
                heapq.heappush(heap, (cost + 3, audit + "I", i, out + r))
        if i < len(rows):
            heapq.heappush(heap, (cost + 4, audit + "D", i + 1, out))
            if faults[i] in ("", "truncated"):
                extra = 3 * (faults[i] == "truncated")
                for r in after:
                    if initials[i] == r:
                        heapq.heappush(heap, (cost + extra, audit + "K", i + 1, out + r))
                    if r in "ua":
                        heapq.heappush(heap, (cost + 3 + extra, audit + "R", i + 1, out + r))
    cost, audit, _ = best
    out, left = [], iter(rows)
    last = ""
    for sign in audit:
        role, text = next(left) if sign != "I" else ("", "")
        if sign == "D":
            continue
        if sign != "K":
            role = "assistant" if last == "u" else "user"
        last = role[0]
        out.append(f"{role}:{text}")
    pairs = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
    counts = Counter(faults)
    return counts["blank"], counts["duplicate"], counts["truncated"], pairs, cost, audit, hashlib.sha256("\n".join(out).encode()).hexdigest()


def expected(rows, damage):
    convs = defaultdict(list)
    for conv, turn, role, text in rows:
        role, text = (" " if x is None else x for x in (role, text))
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20 if damage else 9
        kept = convs[conv]
        if kind == 0:
            continue
        if kind == 1:
            text = ""
        if kind == 2:
            text = "".join(c for c in text if c not in ".!?")
        if kind == 4:
            role = "user"
        kept += [(turn, role, text)] * (2 if kind == 3 else 1)
    out = {}
    for conv, kept in convs.items():
        kept.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
        turns = [t for t, _, _ in kept if t is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        out[conv] = (gaps, *brute([(r, t) for _, r, t in kept]))
    return out


def results(df):
    return {r.conv_id: tuple(r)[1:] for r in df.select("conv_id", *C.COUNTS, "audit", "repaired_sha256").collect()}


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_query(spark, sf):
    rows = [tuple(r) for r in spark.read.parquet(f"/root/testdata/{sf}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert results(C.query(spark, f"/root/testdata/{sf}")) == expected(rows, damage=True)


EDGES = [
    *((1, t, r, x) for t, r, x in ((0, "system", "Be kind."), (1, "user", "Hi?"), (2, "assistant", "Yes."), (5, "user", "cut off"))),
    *((2, 0, "assistant", "First.") for _ in range(40)),
    (2, None, None, None),
    (2, None, "user", " \t\v\f\r\n"),
    (3, None, "", "no role."),
    (3, None, "tool", "unknown role"),
    (None, 0, "user", "of no conversation."),
    (None, 0, "user", "of no conversation."),
    (None, 7, "assistant", "x" * 300_000 + "!"),
    (4, 1, "user", ""),
    *((5, t, "user" if t % 3 else "assistant", f"say {t % 17}" + "." * (t % 2)) for t in range(300)),
    (-6, 3, "user", "Ü? "),
    (-6, 3, "assistant", "a. "),
]


def test_edges(spark, monkeypatch):
    rows = spark.createDataFrame(EDGES, SCHEMA)
    clashing = rows.select("*", *(F.lit(1).alias(c) for c in ("code", "digest", "run", "segment", "kind", "initial", "place", "cost", "audit")))
    want = expected(EDGES, damage=False)
    for frame, partitions in ((rows, 1), (clashing, 5), (clashing, 40)):
        spark.conf.set("spark.sql.shuffle.partitions", partitions)
        try:
            got = C.repaired(frame.repartition(3))
            whole = {r.conv_id: r for r in got.collect() if r.audit is not None}
            assert set(whole) == set(want)
            for conv, r in whole.items():
                assert (r.gaps, r.blank, r.duplicate, r.truncated, r.illegal, r.cost, r.audit) == want[conv][:-1], conv
            lines = defaultdict(list)
            for r in sorted(got.collect(), key=lambda r: r.segment):
                lines[r.conv_id] += [f"{e.role}:{e.text}" for e in r.edits if e.role is not None]
            for conv, x in want.items():
                assert hashlib.sha256("\n".join(lines[conv]).encode()).hexdigest() == x[-1]
        finally:
            spark.conf.set("spark.sql.shuffle.partitions", 8)


def test_long_conversations_are_cut_and_joined(spark, tmp_path):
    """More rows than a segment holds, in one partition and in many."""
    rows = spark.range(5000).select(
        F.lit(1).cast("long").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") % 7 == 3, "system").when(F.col("id") % 2 == 0, "user").otherwise("assistant").alias("role"),
        F.concat(F.lit("t"), (F.col("id") % 1999).cast("string"), F.when(F.col("id") % 5 > 0, ".").otherwise("")).alias("text"),
    )
    few = spark.createDataFrame([(0, 0, "user", "a."), (2, 0, "user", "b.")], SCHEMA)
    path = f"{tmp_path}/conversations.parquet"
    rows.unionByName(few).write.parquet(path)
    kept = [tuple(r) for r in spark.read.parquet(path).select("conv_id", "turn", "role", "text").collect()]
    assert results(C.query(spark, str(tmp_path))) == expected(kept, damage=True)


def test_no_rows(spark, tmp_path):
    none = spark.createDataFrame([], SCHEMA)
    assert C.repaired(none).count() == 0
    none.write.parquet(f"{tmp_path}/conversations.parquet")
    assert C.query(spark, str(tmp_path)).count() == 0


def test_conversations_without_rows_after_damage(spark, tmp_path):
    gone = [c for c in range(2000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0][:3]
    rows = spark.createDataFrame([*((c, 0, "user", "gone.") for c in gone), (None, 3, "user", "here.")], SCHEMA)
    rows.write.parquet(f"{tmp_path}/conversations.parquet")
    got = results(C.query(spark, str(tmp_path)))
    assert len(got) == 4
    for c in gone:
        assert got[c] == (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())


def test_roles_follow_from_the_audit():
    for rows, initials in (((("u", 1), ("u", 1)), "uu"), ((("A", 1), ("s", 1), ("u", 1)), "asu"), ((("x", 1),), "x")):
        assert roles_of(C.cheapest(rows, C.NONE, C.ENDS, True)[1], initials) is not None
