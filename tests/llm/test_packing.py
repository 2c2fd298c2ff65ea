import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
from hypothesis import given, settings, strategies as st
from tokenizers import Tokenizer

from pagewinnow.llm import packing
from tests.llm.conftest import EDGES

PATH = public_tokenizers.path(packing.VOCABULARY)
TOKENIZER = Tokenizer.from_file(PATH)
WORDS = packing.Words(PATH)


def ids_of(text):
    return [*TOKENIZER.encode(text or "", add_special_tokens=False).ids, 0]


def check(rows, docs):
    """Pieces cover each document once, sequences have no gaps, and no padding is needed."""
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in rows:
        pieces[r.doc_id].append(r)
        sequences[r.sequence_id].append((r.offset, r.length))
    wanted = defaultdict(list)
    for i, t in docs:
        wanted[i].append(np.array(ids_of(t), "<u4"))
    assert set(pieces) == set(wanted)
    for i, copies in wanted.items():
        left = sorted((r.start, r.length, r.ids_crc32, r.doc_tokens) for r in pieces[i])
        assert sum(x[1] for x in left) == sum(map(len, copies))
        for start, length, crc, total in left:
            assert any(len(c) == total and zlib.crc32(c[start : start + length].tobytes()) == crc for c in copies)
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at and length > 0
            at += length
        assert at == packing.WINDOW or at & (at - 1) == 0 and at < packing.WINDOW


def test_table(small):
    docs = small("documents")
    check(packing.packed(docs).collect(), [(r.doc_id, r.text) for r in docs.collect()])


def test_edges(clashing_docs, no_docs):
    check(packing.packed(clashing_docs).collect(), [(r[0], r[1]) for r in EDGES])
    assert packing.packed(no_docs).count() == 0


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from([*"ab 's\n\t  \x1c\x85É漢!7<|>\U0001f600", "<|endoftext|>", "  "]), max_size=40).map("".join))
def test_ids_are_those_of_the_tokenizer(text):
    assert np.frombuffer(WORDS.ids([text])[0], "<u4").tolist() == ids_of(text)[:-1]


@settings(max_examples=60, deadline=None)
@given(st.dictionaries(st.integers(1, 1023), st.integers(1, 50), max_size=60))
def test_plans_place_every_remainder_once(histogram):
    counts = np.zeros(packing.WINDOW, np.int64)
    for n, k in histogram.items():
        counts[n] = k
    plan = packing.plan(counts)
    places = packing.Places(plan)
    filled = defaultdict(int)
    for n, k in histogram.items():
        for rank in range(k):
            at = 0
            for begin, length, sequence, offset in sorted(places(n, rank)):
                assert begin == at
                at += length
                assert offset + length <= packing.WINDOW
                filled[sequence] += length
            assert at == n
    short = [v for v in filled.values() if v != packing.WINDOW]
    assert all(v & (v - 1) == 0 for v in short) and sum(short) < packing.WINDOW
    assert sorted(filled) == list(range(plan.sequences()))


def test_least_squares_meets_a_histogram_that_can_be_met():
    counts = np.zeros(packing.WINDOW)
    for a, n in ((100, 500), (924, 500), (300, 1200), (200, 400), (524, 400), (724, 800)):
        counts[a] += n
    combos = packing.combinations_of(np.flatnonzero(counts), packing.WINDOW, 1500)
    used = packing.least_squares(combos, counts)
    met = np.zeros(packing.WINDOW)
    for c, k in zip(combos, used, strict=True):
        np.add.at(met, c[c > 0], k)
    assert (used >= 0).all() and np.abs(met - counts).max() < 5


def test_a_large_histogram_needs_a_small_plan():
    pick = np.random.default_rng(1)
    counts = pick.poisson(10**6, packing.WINDOW)
    counts[0] = 0
    plan = packing.plan(counts)
    assert len(plan.rows) + len(plan.stream) < 10_000
    whole, streamed = (int((x[:, 0] * x[:, 2]).sum()) for x in (plan.rows, plan.stream))
    assert whole + streamed == int((counts * np.arange(packing.WINDOW)).sum())
    assert streamed == plan.total < 0.02 * whole




def test_the_vocabularys_own_encoder_is_loaded_when_needed():
    words = packing.Words(public_tokenizers.path(packing.VOCABULARY))
    words.ids(["plain text"])
    assert words.whole is None
    words.ids([f"a {words.special[0]} b"])
    assert words.whole is not None
