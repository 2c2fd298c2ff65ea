import hashlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from pagewinnow.llm import pair_index
from tests.llm.conftest import DOCS, EDGES

PATH = public_tokenizers.path(pair_index.VOCABULARY)
TOKENIZER = Tokenizer.from_file(PATH)
CODEC = pair_index.Codec(PATH)
TOKENS = pair_index.Tokens(PATH)


def ids_of(text):
    return TOKENIZER.encode(text or "", add_special_tokens=False).ids


def ours(texts):
    return [np.frombuffer(x, "<i4").tolist() for x in CODEC.encode(texts)]


@settings(max_examples=300, deadline=None)
@given(
    st.lists(
        st.sampled_from([*"abnotehi 's\n\t  \x1c\x85É漢!7<|>\U0001f600Σς̈İ", "<|endoftext|>", "<|startoftext|>", "  ", "'re", "the", "aaaa", ""]),
        max_size=40,
    ).map("".join)
)
def test_ids_and_texts_are_those_of_the_library(text):
    assert ours([text]) == [ids_of(text)]
    assert TOKENS.text(np.array(ids_of(text), int)) == TOKENIZER.decode(ids_of(text), skip_special_tokens=False)


def test_every_code_point():
    texts = [f"a{chr(k)}b {chr(k)}" for k in range(0x30000) if not 0xD800 <= k < 0xE000]
    assert ours(texts) == [x.ids for x in TOKENIZER.encode_batch(texts, add_special_tokens=False)]


def plainly(word, ranks):
    """Merge by looking for the least rank again and again."""
    parts = list(word)
    while True:
        known = [(ranks[p], i) for i, p in enumerate(zip(parts, parts[1:], strict=False)) if p in ranks]
        if not known:
            return parts
        _, i = min(known)
        parts[i : i + 2] = [parts[i] + parts[i + 1]]


@settings(max_examples=200, deadline=None)
@given(
    st.lists(st.tuples(st.sampled_from(["a", "b", "c", "aa", "ab", "ba", "aab", "abab"]), st.sampled_from(["a", "b", "c", "aa", "ab", "ba"])), unique=True, max_size=12),
    st.lists(st.text("abc", min_size=1, max_size=12), min_size=1, max_size=6),
)
def test_ranks_in_any_order(pairs, words):
    """Overlaps, merges that make a lower rank possible, and two ways to one token."""
    names = dict.fromkeys([*"abc", *(x for p in pairs for x in (*p, "".join(p)))])
    vocab = {t: i for i, t in enumerate(names)}
    if not pairs:
        return
    merges = pair_index.Merges(vocab, [list(p) for p in pairs], "")
    ranks = {p: i for i, p in enumerate(pairs)}
    got = [[list(vocab)[i] for i in np.frombuffer(ids, "<i4")] for ids in merges.merged(words)]
    assert got == [plainly(w, ranks) for w in words]


def test_small_indexes_and_forgotten_words_change_nothing(monkeypatch):
    texts = [r[1] or "" for r in EDGES]
    want = ours(texts)
    monkeypatch.setattr(pair_index, "INDEX_SYMBOLS", 7)
    monkeypatch.setattr(pair_index, "REMEMBERED", 3)
    own = pair_index.Codec(PATH)
    for _ in range(2):
        assert [np.frombuffer(own.encode([t])[0], "<i4").tolist() for t in texts] == want


def test_other_vocabularies_are_refused():
    with pytest.raises(ValueError):
        pair_index.Codec(public_tokenizers.path("byte_bpe_50k.json"))


def test_table_and_edges(spark, clashing_docs, small, no_docs):
    for docs in (clashing_docs.withColumn("ids", F.lit("x")).withColumn("decoded", F.lit(1)), small("documents")):
        coded = pair_index.encoded(docs)
        assert coded.columns == ["doc_id", "ids"]
        key = lambda r: (r[0] is None, r[0] or 0, r[1])
        want = sorted(((r.doc_id, ids_of(r.text)) for r in docs.collect()), key=key)
        back = pair_index.decoded(coded).collect()
        assert sorted(((r.doc_id, r.ids) for r in back), key=key) == want
        once = pair_index.round_trip(docs).collect()
        assert sorted(map(tuple, once), key=key) == sorted(map(tuple, back), key=key)
        assert all(r.decoded == TOKENIZER.decode(r.ids, skip_special_tokens=False) for r in back)
    assert pair_index.decoded(pair_index.encoded(no_docs)).count() == 0
    assert spark.createDataFrame([], DOCS).schema["text"].dataType == no_docs.schema["text"].dataType


def test_ids_that_nothing_stands_for(spark):
    rows = spark.createDataFrame([(1, None, "x"), (2, [], "x"), (3, [5, 10**6, None, -3, 49407], "x")], "doc_id long, ids array<int>, decoded string")
    got = {r.doc_id: r.decoded for r in pair_index.decoded(rows).collect()}
    assert got[1] == got[2] == ""
    assert got[3] == TOKENIZER.decode([5, 49407], skip_special_tokens=False)


def test_query(spark):
    sf = "/root/testdata/sf0.001"
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    for r in pair_index.query(spark, sf).collect():
        ids = ids_of(texts[r.doc_id])
        decoded = TOKENIZER.decode(ids, skip_special_tokens=False)
        assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) == (len(ids), sha(" ".join(map(str, ids))), sha(decoded))
