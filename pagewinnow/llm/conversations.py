"""Repair of conversations by bidirectional search over the edit lattice (operator 11).

A conversation's rows in turn order are the steps of a lattice; a node says how
many rows are done and which role came last, an edge keeps, reroles or deletes
the next row or inserts an empty one.  Two heaps grow from the beginning and
from the end until no cheaper crossing is possible; all crossings of the least
cost are finished, and of their concatenated audits the least is taken.

Rows are dealt out by ranges of (conversation, turn) and cut into segments of
bounded size, so that a conversation that holds a third of all rows is no single
task.  Of a conversation in one segment the lattice is searched at once.  Of
others each segment is searched between every two roles that it could begin and
end with, and the segments' tables are joined in pairs.  Only codes of rows and
audits travel for that, no text.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache
from heapq import heapify, heappop, heappush
from typing import NamedTuple

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from pagewinnow.llm.shared import ship, table, written

ship(__name__)

#: different rows and bytes of text of one segment
SEGMENT_ROWS, SEGMENT_BYTES = 1024, 4 << 20
#: white space of a blank row
SPACE = " \t\n\v\f\r"
RENAME, DELETE, INSERT, OPEN_END = 3, 4, 3, 3
#: last role: none yet, system, user, assistant; and which role leads where
NONE, SYSTEM, USER, ASSISTANT = range(4)
STEPS = {(NONE, "s"): SYSTEM, (NONE, "u"): USER, (SYSTEM, "u"): USER, (USER, "a"): ASSISTANT, (ASSISTANT, "u"): USER}
#: a repaired conversation ends so
ENDS = (NONE, ASSISTANT)
#: what completes a conversation after each last role
COMPLETES = {NONE: 0, SYSTEM: 2, USER: 1, ASSISTANT: 0}
LEGAL = {"su", "ua", "au"}
ROLES = {"u": "user", "a": "assistant"}

Rows = tuple[tuple[str, int], ...]
Path = tuple[int, str]


def row_edges(code: str, run: int) -> list[tuple[int, int, int, str]]:
    """``from, to, cost, audit`` of the ways past a row.

    ``code`` is ``D`` for a run of rows that must go, else the role's initial
    (``x``: none of s, u, a), in upper case if the text is truncated.
    """
    if code == "D":
        return [(s, s, DELETE * run, "D" * run) for s in range(4)]
    extra = OPEN_END if code.isupper() else 0
    edges = [(s, s, DELETE, "D") for s in range(4)]
    for (s, role), to in STEPS.items():
        if role == code.lower():
            edges.append((s, to, extra, "K"))
        if role in ROLES:
            edges.append((s, to, RENAME + extra, "R"))
    return edges


INSERTS = [(s, to, INSERT, "I") for (s, role), to in STEPS.items() if role in ROLES]


@lru_cache(maxsize=1 << 14)
def cheapest(rows: Rows, entry: int, exits: tuple[int, ...], tail: bool) -> Path | None:
    """Least cost from ``entry`` to one of ``exits`` and the least audit of that cost.

    ``tail`` allows inserts after the last row.  At equal cost nodes are settled
    in row order (backwards: against it), and only keeping a row is free, so a
    node's least audit is known when it is settled.
    """
    size = len(rows)
    ways = [row_edges(*r) for r in rows]

    def forward(node: tuple[int, int]) -> Iterator[tuple[tuple[int, int], int, str]]:
        i, state = node
        if i < size or tail:
            yield from (((i, to), cost, sign) for s, to, cost, sign in INSERTS if s == state)
        if i < size:
            yield from (((i + 1, to), cost, sign) for s, to, cost, sign in ways[i] if s == state)

    def backward(node: tuple[int, int]) -> Iterator[tuple[tuple[int, int], int, str]]:
        i, state = node
        if i < size or tail:
            yield from (((i, s), cost, sign) for s, to, cost, sign in INSERTS if to == state)
        if i:
            yield from (((i - 1, s), cost, sign) for s, to, cost, sign in ways[i - 1] if to == state)

    ahead: dict[tuple[int, int], Path] = {(0, entry): (0, "")}
    behind: dict[tuple[int, int], Path] = {(size, x): (0, "") for x in exits}
    front = [(0, 0, (0, entry))]
    back = [(0, -size, node) for node in behind]
    heapify(back)
    reached: set[tuple[int, int]] = set()
    reaching: set[tuple[int, int]] = set()
    best = float("inf")
    # both ends are settled first; then the nearer heap goes on while an equal crossing is possible
    while not reached or len(reaching) < len(exits) or front and back and front[0][0] + back[0][0] <= best:
        onward = not reached or len(reaching) >= len(exits) and front[0][0] < back[0][0]
        heap, known, others, done = (front, ahead, behind, reached) if onward else (back, behind, ahead, reaching)
        cost, _, node = heappop(heap)
        if node in done:
            continue
        done.add(node)
        audit = known[node][1]
        if node in others:
            best = min(best, cost + others[node][0])
        for to, price, sign in forward(node) if onward else backward(node):
            path = (cost + price, audit + sign if onward else sign + audit)
            old = known.get(to)
            if old is None or path < old:
                known[to] = path
                if old is None or path[0] < old[0]:
                    heappush(heap, (path[0], to[0] if onward else -to[0], to))
    if best == float("inf"):
        return None
    crossings = [(ahead[v][0] + behind[v][0], ahead[v][1] + behind[v][1]) for v in reached & reaching]
    for v in reached:
        for w, price, sign in forward(v):
            if w in reaching:
                crossings.append((ahead[v][0] + price + behind[w][0], ahead[v][1] + sign + behind[w][1]))
    return min(crossings)


def joined(one: dict[tuple[int, int], Path], other: dict[tuple[int, int], Path]) -> dict[tuple[int, int], Path]:
    """The table of two neighbouring segments."""
    out: dict[tuple[int, int], Path] = {}
    for (a, b), (cost, audit) in one.items():
        for (c, d), (more, rest) in other.items():
            if b == c:
                path = (cost + more, audit + rest)
                out[a, d] = min(out.get((a, d), path), path)
    return out


def whole_path(tables: list[dict[tuple[int, int], Path]]) -> Path:
    """The cheapest path through all segments; neighbours are joined in pairs, round by round."""
    while len(tables) > 1:
        tables = [joined(*tables[i : i + 2]) if i + 1 < len(tables) else tables[i] for i in range(0, len(tables), 2)]
    return min(
        (cost + INSERT * COMPLETES[to], audit + "I" * COMPLETES[to]) for (a, to), (cost, audit) in tables[0].items() if a == NONE
    )


def lattice_rows(codes: list[str], runs: list[int], later: list[bool]) -> Rows:
    """Rows of a segment; of a run of equal rows only the first may stay, and not if it was seen earlier."""
    out: list[tuple[str, int]] = []
    for code, run, seen in zip(codes, runs, later, strict=True):
        must_go = run if code == "B" or seen else run - 1
        if must_go < run:
            out.append((code, 1))
        if must_go:
            if out and out[-1][0] == "D":
                must_go += out.pop()[1]
            out.append(("D", must_go))
    return tuple(out)


def edited(audit: str, entry: int, roles: list[str], texts: list[str], turns: list[int | None], runs: list[int]) -> Iterator[dict]:
    """Every edit of a segment in order, with the row it leaves (role null: none)."""
    state = entry
    rows = ((role, text, turn) for role, text, turn, run in zip(roles, texts, turns, runs, strict=True) for _ in range(run))
    for sign in audit:
        role, text, turn = next(rows) if sign != "I" else (None, "", None)
        if sign == "D":
            role = text = None
        elif sign == "K":
            state = STEPS[state, role[:1]]
        else:
            state = ASSISTANT if state == USER else USER
            role = ROLES["a" if state == ASSISTANT else "u"]
        yield {"edit": sign, "turn": turn, "role": role, "text": text}


def narrow(rows: DataFrame) -> DataFrame:
    """Rows with a code (``B`` for blank) and a digest of role and text; null roles and texts count as one space."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("role", "text"))
    rows = rows.select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), role.alias("role"), text.alias("text"))
    end = F.rtrim("text", F.lit(SPACE))
    initial = F.substring("role", 1, 1)
    initial = F.when(initial.isin("s", "u", "a"), initial).otherwise("x")
    code = F.when(end == "", "B").when(F.substring(end, -1, 1).isin(".", "!", "?"), initial).otherwise(F.upper(initial))
    digest = F.unhex(F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text"), 256))
    return rows.select("*", initial.alias("initial"), code.alias("code"), digest.alias("digest"), F.lit(1).cast("long").alias("run"))


def collapse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Equal rows of a batch become one with their number, before anything is exchanged."""
    for batch in batches:
        rows = pa.Table.from_batches([batch]).append_column("i", pa.array(range(batch.num_rows)))
        first = rows.group_by(["conv_id", "turn", "digest"]).aggregate([("i", "min"), ("run", "sum")])
        out = batch.take(first["i_min"].combine_chunks())
        yield out.set_column(out.schema.get_field_index("run"), "run", first["run_sum"].combine_chunks().cast(pa.int64()))


SEGMENT = (
    "conv_id long, segment long, closed boolean, turns array<long>, roles array<string>, texts array<string>, "
    "initials array<string>, codes array<string>, digests array<binary>, runs array<long>"
)


def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Segments of sorted rows; ``closed`` means that the whole conversation is in it.

    A partition's first and last conversation may go on in another partition, so
    their segments are never closed.
    """
    names = [x.split()[0] for x in SEGMENT.split(", ")]
    types = [pa.int64(), pa.int64(), pa.bool_(), pa.list_(pa.int64()), *[pa.list_(pa.string())] * 4, pa.list_(pa.binary()), pa.list_(pa.int64())]
    number = TaskContext.get().partitionId() << 40
    ready: list[list] = []
    segment: list | None = None
    pieces = conversations = held = size = 0

    def out() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*ready, strict=True), types, strict=True)], names)

    for batch in batches:
        columns = [batch.column(batch.schema.get_field_index(c)).to_pylist() for c in ("conv_id", "turn", "role", "text", "initial", "code", "digest", "run")]
        for conv, turn, role, text, initial, code, digest, run in zip(*columns, strict=True):
            starts = segment is None or segment[0] != conv
            if not starts and segment[8][-1] == digest and segment[3][-1] == turn:
                segment[9][-1] += run
                continue
            if starts or len(segment[3]) >= SEGMENT_ROWS or held + len(text) > SEGMENT_BYTES:
                if segment is not None:
                    segment[2] = starts and pieces == 1 and conversations > 1
                    ready.append(segment)
                pieces, conversations = (1, conversations + 1) if starts else (pieces + 1, conversations)
                segment, held, number = [conv, number, False, [], [], [], [], [], [], []], 0, number + 1
                if size > SEGMENT_BYTES:
                    yield out()
                    ready, size = [], 0
            for to, value in zip(segment[3:], (turn, role, text, initial, code, digest, run), strict=True):
                to.append(value)
            held += len(text)
            size += len(text) + 200
    if segment is not None:
        ready.append(segment)
        yield out()


def facts(turns: list, initials: list[str], codes: list[str], runs: list[int], later: list[bool]) -> dict:
    """Counts of a segment, and its ends for the counts across segments."""
    known = [t for t in turns if t is not None]
    twice = zip(initials, initials[1:], strict=False)
    seen = [c != "B" and x for c, x in zip(codes, later, strict=True)]
    return {
        "low": min(known, default=None),
        "high": max(known, default=None),
        "turns": len(set(known)),
        "first": initials[0],
        "last": initials[-1],
        "blank": sum(n for c, n in zip(codes, runs, strict=True) if c == "B"),
        "duplicate": sum(n - 1 + x for c, n, x in zip(codes, runs, seen, strict=True) if c != "B"),
        "truncated": sum(c != "B" and c.isupper() and not x for c, x in zip(codes, seen, strict=True)),
        "illegal": sum(a + b not in LEGAL for a, b in twice) + sum(n - 1 for n in runs),
    }


def added(one: dict, other: dict) -> dict:
    """Facts of two neighbouring segments."""
    shared = one["high"] is not None and one["high"] == other["low"]
    out = {k: one[k] + other[k] for k in ("blank", "duplicate", "truncated", "illegal", "turns")}
    out["turns"] -= shared
    out["illegal"] += one["last"] + other["first"] not in LEGAL
    low = one["low"] if one["low"] is not None else other["low"]
    high = other["high"] if other["high"] is not None else one["high"]
    return out | {"low": low, "high": high, "first": one["first"], "last": other["last"]}


def gaps(x: dict) -> int:
    return x["high"] - x["low"] + 1 - x["turns"] if x["turns"] else 0


COUNTS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
EDITS = "edits array<struct<edit string, turn long, role string, text string>>"
REPAIRED = "conv_id long, segment long, whole boolean, " + ", ".join(f"{c} long" for c in COUNTS) + f", audit string, {EDITS}"
EDIT_TYPE = pa.list_(pa.struct([("edit", pa.string()), ("turn", pa.int64()), ("role", pa.string()), ("text", pa.string())]))


def taken(batch: pa.RecordBatch, *names: str) -> Iterator[tuple]:
    return zip(*(batch.column(batch.schema.get_field_index(n)).to_pylist() for n in names), strict=True)


def repair_closed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Search the lattice of each conversation that lies in one segment."""
    for whole in batches:
        for i in range(0, whole.num_rows, 64):
            out = []
            for conv, number, turns, roles, texts, initials, codes, digests, runs in taken(
                whole.slice(i, 64), "conv_id", "segment", "turns", "roles", "texts", "initials", "codes", "digests", "runs"
            ):
                met: set[bytes] = set()
                later = [d in met or met.add(d) is not None for d in digests]
                x = facts(turns, initials, codes, runs, later)
                cost, audit = cheapest(lattice_rows(codes, runs, later), NONE, ENDS, True)
                edits = list(edited(audit, NONE, roles, texts, turns, runs))
                out.append((conv, number, True, gaps(x), x["blank"], x["duplicate"], x["truncated"], x["illegal"], cost, audit, edits))
            types = [pa.int64(), pa.int64(), pa.bool_(), *[pa.int64()] * 6, pa.string(), EDIT_TYPE]
            names = [*("conv_id", "segment", "whole"), *COUNTS, "audit", "edits"]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), types, strict=True)], names)


FACTS = "low long, high long, turns long, first string, last string, blank long, duplicate long, truncated long, illegal long"
PATHS = "paths array<struct<entry int, exit int, cost long, audit string>>"
FACTS_TYPE = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(), *[pa.int64()] * 4]
PATHS_TYPE = pa.list_(pa.struct([("entry", pa.int32()), ("exit", pa.int32()), ("cost", pa.int64()), ("audit", pa.string())]))


def tables_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The cheapest paths of a segment between every two last roles, inserts after its last row left to what follows."""
    for batch in batches:
        out = []
        for conv, number, rows in taken(batch, "conv_id", "segment", "rows"):
            rows = sorted(rows, key=lambda r: r["place"])
            turns, initials, codes, runs, later = ([r[c] for r in rows] for c in ("turn", "initial", "code", "run", "later"))
            steps = lattice_rows(codes, runs, later)
            paths = [
                {"entry": a, "exit": b, "cost": found[0], "audit": found[1]}
                for a in range(4)
                for b in range(4)
                if (found := cheapest(steps, a, (b,), False))
            ]
            out.append((conv, number, *facts(turns, initials, codes, runs, later).values(), paths))
        if out:
            names = ["conv_id", "segment", *(x.split()[0] for x in FACTS.split(", ")), "paths"]
            types = [pa.int64(), pa.int64(), *FACTS_TYPE, PATHS_TYPE]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), types, strict=True)], names)


def shares(audit: str, tables: list[dict[tuple[int, int], Path]]) -> Iterator[tuple[int, str]]:
    """Entry and part of the audit of each segment: up to its last row; what follows the last one is its own."""
    state, at = NONE, 0
    for i, known in enumerate(tables):
        ends = {b: path[1] for (a, b), path in known.items() if a == state and audit.startswith(path[1], at)}
        to, part = max(ends.items(), key=lambda x: len(x[1]))
        yield state, part if i + 1 < len(tables) else audit[at:]
        state, at = to, at + len(part)


def join_segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of each conversation in several segments the counts, on its first one, and each segment's part of the audit."""
    for batch in batches:
        out = []
        for conv, parts in taken(batch, "conv_id", "parts"):
            parts = sorted(parts, key=lambda p: p["segment"])
            x = parts[0]
            for p in parts[1:]:
                x = added(x, p)
            tables = [{(t["entry"], t["exit"]): (t["cost"], t["audit"]) for t in p["paths"]} for p in parts]
            cost, audit = whole_path(list(tables))
            for i, (p, (entry, part)) in enumerate(zip(parts, shares(audit, tables), strict=True)):
                counts = (gaps(x), x["blank"], x["duplicate"], x["truncated"], x["illegal"], cost, audit)
                out.append((p["segment"], entry, part, *(counts if not i else (None,) * 7)))
        if out:
            names = ["segment", "entry", "part", *COUNTS, "audit"]
            types = [pa.int64(), pa.int32(), pa.string(), *[pa.int64()] * 6, pa.string()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), types, strict=True)], names)


def edit_open(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for i in range(whole.num_rows):
            batch = whole.slice(i, 1)
            edits = [list(edited(*x)) for x in taken(batch, "part", "entry", "roles", "texts", "turns", "runs")]
            kept = [batch.column(batch.schema.get_field_index(c)) for c in ("conv_id", "segment", *COUNTS, "audit")]
            yield pa.RecordBatch.from_arrays(
                [*kept[:2], pa.array([False]), *kept[2:], pa.array(edits, EDIT_TYPE)], ["conv_id", "segment", "whole", *COUNTS, "audit", "edits"]
            )


def repaired(rows: DataFrame) -> DataFrame:
    """Segments of repaired conversations: ``conv_id, segment, whole, gaps, blank, duplicate, truncated, illegal, cost, audit, edits``.

    ``edits`` are the segment's edits in order, each with the row that it leaves
    (role null: none; turn null: inserted).  A conversation is one segment
    (``whole``), or several in the order of ``segment``; then the counts and the
    whole audit are on the first one and null on the others.

    Rows are taken by turn (nulls first), those of one turn by role and text.
    Null roles and texts count as one space.  Rows of a null ``conv_id`` are a
    conversation of their own.  An initial other than s, u and a, or none, is no
    legal role.  Repeated rows are each a row.  Very long texts travel whole, a
    segment holds one such text at least; of very long conversations only codes
    and audits meet in one task.  Other columns are ignored.  An empty table
    gives no rows.  Works the segments out at once (writes them to the shared
    folder).
    """
    order = ("conv_id", "turn", "role", "text")
    lean = narrow(rows)
    lean = lean.mapInArrow(collapse, lean.schema)
    segments = written(lean.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(cut, SEGMENT), "conversations")
    closed = segments.where("closed").mapInArrow(repair_closed, REPAIRED)

    parts = segments.where("NOT closed")
    each = F.posexplode(F.arrays_zip("turns", "initials", "codes", "digests", "runs")).alias("place", "x")
    each = parts.select("conv_id", "segment", each).select("conv_id", "segment", "place", "x.*")
    place = F.struct("segment", "place")
    seen = each.where("codes <> 'B'").groupBy("conv_id", "digests").agg(F.min(place).alias("earliest"), F.count("*").alias("n"))
    seen = seen.where("n > 1").select(F.col("conv_id").alias("of"), F.col("digests").alias("same"), "earliest")
    each = each.join(seen, F.col("conv_id").eqNullSafe(F.col("of")) & (F.col("digests") == F.col("same")), "left")
    later = F.coalesce(place > F.col("earliest"), F.lit(False))
    fields = ("place", F.col("turns").alias("turn"), F.col("initials").alias("initial"), F.col("codes").alias("code"), F.col("runs").alias("run"))
    # a segment has a bounded number of rows
    tables = each.groupBy("conv_id", "segment").agg(F.collect_list(F.struct(*fields, later.alias("later"))).alias("rows"))
    tables = tables.mapInArrow(tables_of, f"conv_id long, segment long, {FACTS}, {PATHS}")
    # codes and audits of one conversation, which its result holds as well
    ends = tables.groupBy("conv_id").agg(F.collect_list(F.struct(*[c for c in tables.columns if c != "conv_id"])).alias("parts"))
    ends = ends.mapInArrow(join_segments, "segment long, entry int, part string, " + ", ".join(f"{c} long" for c in COUNTS) + ", audit string")
    opened = parts.select("conv_id", "segment", "turns", "roles", "texts", "runs").join(ends, "segment").mapInArrow(edit_open, REPAIRED)
    literal = [F.col(c) for c in ("conv_id", "segment")]
    rest = [*COUNTS, "audit", "edits"]
    return closed.select(*literal, F.lit(True).alias("whole"), *rest).unionByName(opened.select(*literal, F.lit(False).alias("whole"), *rest))


def lines(edits: str) -> Column:
    """``role:text`` of the rows that edits leave."""
    return F.transform(F.filter(edits, lambda e: e["role"].isNotNull()), lambda e: F.concat(e["role"], F.lit(":"), e["text"]))


def streamed_hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One hash over the lines of each conversation; rows come sorted, and one segment is in memory."""
    conv, state, some = None, None, False
    for batch in batches:
        out = []
        for i in range(batch.num_rows):
            ((of, parts),) = taken(batch.slice(i, 1), "conv_id", "lines")
            if state is None or of != conv:
                if state is not None:
                    out.append((conv, state.hexdigest()))
                conv, state, some = of, hashlib.sha256(), False
            for line in parts:
                state.update(("\n" if some else "").encode() + line.encode())
                some = True
        yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in out], t) for k, t in ((0, pa.int64()), (1, pa.string()))], ["of", "sha"])
    if state is not None:
        yield pa.RecordBatch.from_arrays([pa.array([conv], pa.int64()), pa.array([state.hexdigest()])], ["of", "sha"])


def damaged(rows: DataFrame) -> DataFrame:
    """Conversations damaged by the checksum of ``conv_id:turn`` (nulls: one space)."""
    space = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(space("conv_id"), F.lit(":"), space("turn"))) % 20
    rows = rows.select("conv_id", "turn", space("role").alias("role"), space("text").alias("text"), kind.alias("kind")).where("kind <> 0")
    text = F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    role = F.when(F.col("kind") == 4, "user").otherwise(F.col("role"))
    copies = F.explode(F.when(F.col("kind") == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1))))
    return rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), copies.alias("copy"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations")
    result = repaired(damaged(rows))
    counts = result.where(F.col("audit").isNotNull()).select(F.col("conv_id").alias("of"), *COUNTS, "audit", "whole", "edits")
    counts = counts.withColumn("sha", F.when(F.col("whole"), F.sha2(F.concat_ws("\n", lines("edits")), 256))).drop("edits", "whole")
    # the hash of a text is made front to back: segments of one conversation pass through one task, one at a time
    spread = result.where("NOT whole").select("conv_id", "segment", lines("edits").alias("lines"))
    spread = spread.repartition("conv_id").sortWithinPartitions("conv_id", "segment").mapInArrow(streamed_hashes, "of long, sha string")
    spread = spread.select(F.col("of").alias("of2"), F.col("sha").alias("sha2"))
    counts = counts.join(spread, F.col("of").eqNullSafe(F.col("of2")), "left")
    every = rows.select(F.col("conv_id").cast("long")).distinct()
    every = every.join(counts, F.col("conv_id").eqNullSafe(F.col("of")), "left")
    return every.select(
        "conv_id",
        *(F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in COUNTS),
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("sha", "sha2", F.sha2(F.lit(""), 256)).alias("repaired_sha256"),
    )
