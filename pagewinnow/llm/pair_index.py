"""Encoding and decoding with a byte-pair vocabulary by a pair occurrence index (operator 13).

A text's words are cut by the vocabulary's own normalizer and splitter.  The
words of a slice of a partition that are not known yet are laid out in one array
of symbols.  An index maps each pair that the vocabulary can merge to all its
positions there; the ranks that have positions are applied in ascending order,
each to all its positions at once, and the pairs that arise beside a merge are
entered into the lists of their ranks.  A merged word is remembered by its
worker, so that each word is merged once while it stays in use.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from heapq import heappop, heappush

import numpy as np
import pyarrow as pa
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F
from tokenizers import Tokenizer

from pagewinnow.llm.shared import ship, slices, table, worker_value

ship(__name__)

VOCABULARY = "word_bpe_49k.json"
#: bytes of text whose words share one index
SLICE_BYTES = 4 << 20
#: symbols of one index; more words are laid out in several
INDEX_SYMBOLS = 8_000_000
#: chunks, and words, that a worker remembers from one slice to the next
REMEMBERED = 250_000
#: of Python's white space, what the vocabulary's pattern does not count as such
NO_SPACE = "\x1c\x1d\x1e\x1f"
#: letters whose class and lower case are the same in all versions of Unicode; an apostrophe can begin a word
PLAIN = re.compile("([A-Za-zÀ-ÖØ-öø-ÿ]+)([!-&(-/:-@\\[-`{-~]*)").fullmatch
DEAD = -1


class Merges:
    """The merge rules of a vocabulary, and the index that applies them."""

    def __init__(self, vocab: dict[str, int], merges: list, suffix: str):
        self.size = max(vocab.values()) + 1
        #: stands between words and takes part in no pair
        self.stop = self.size
        pairs = [(vocab[a], vocab[b], vocab[a + b]) for a, b in (m if isinstance(m, list) else m.split(" ") for m in merges)]
        self.left, self.right, self.made = (np.array(x, np.int32) for x in zip(*pairs, strict=True))
        self.after, self.before = self._by(self.left, self.right), self._by(self.right, self.left)
        codes = sorted({ord(t) for t in vocab if len(t) == 1})
        self.inner = np.full(max(codes) + 1, DEAD, np.int32)
        self.final = self.inner.copy()
        for c in codes:
            self.inner[c], self.final[c] = vocab[chr(c)], vocab.get(chr(c) + suffix, DEAD)
        self.inner[ord("\n")] = self.stop

    @staticmethod
    def _by(one: np.ndarray, other: np.ndarray) -> dict[int, tuple[np.ndarray, np.ndarray]]:
        """For each symbol of ``one`` its partners in ``other`` and their ranks."""
        order = np.argsort(one, kind="stable")
        cuts = np.flatnonzero(np.diff(one[order])) + 1
        return {int(one[x[0]]): (other[x], x) for x in np.split(order, cuts) if len(x)}

    def merged(self, words: list[str]) -> list[bytes]:
        """Little-endian 32-bit ids of each word; words are in the vocabulary's letters, none is empty."""
        codes = np.frombuffer(("\n" + "\n".join(words) + "\n").encode("utf-32-le"), "<u4")
        symbols = self.inner[codes]
        stops = np.flatnonzero(symbols == self.stop)
        symbols[stops[1:] - 1] = self.final[codes[stops[1:] - 1]]
        self._apply(symbols)
        alive = symbols != DEAD
        kept = symbols[alive]
        ends = (np.flatnonzero(kept == self.stop) * 4).tolist()
        data = kept.astype("<i4").tobytes()
        return [data[a + 4 : b] for a, b in zip(ends, ends[1:], strict=False)]

    def _index(self, symbols: np.ndarray) -> dict[int, list[np.ndarray]]:
        """All positions of each rank's pair, in ascending order."""
        present, name = np.unique(symbols, return_inverse=True)
        known = np.isin(self.left, present) & np.isin(self.right, present)
        rank_of = np.full((len(present), len(present)), DEAD, np.int32)
        ranks = np.flatnonzero(known)
        rank_of[np.searchsorted(present, self.left[ranks]), np.searchsorted(present, self.right[ranks])] = ranks
        found = rank_of[name[:-1], name[1:]]
        spots = np.flatnonzero(found != DEAD)
        order = spots[np.argsort(found[spots], kind="stable")]
        active, begins = np.unique(found[order], return_index=True)
        return {int(r): [x] for r, x in zip(active, np.split(order, begins[1:]), strict=True)} if len(active) else {}

    def _apply(self, symbols: np.ndarray) -> None:
        """Merge all pairs in place; a merged pair's second symbol becomes ``DEAD``."""
        lists = self._index(symbols)
        heap = sorted(lists)
        following = np.arange(1, len(symbols) + 1)
        previous = np.arange(-1, len(symbols) - 1)
        partner_rank = np.full(self.stop + 1, DEAD, np.int32)

        def enter(partners: tuple[np.ndarray, np.ndarray], beside: np.ndarray, spots: np.ndarray) -> None:
            partner_rank[partners[0]] = partners[1]
            found = partner_rank[symbols[beside]]
            partner_rank[partners[0]] = DEAD
            hit = found != DEAD
            if not hit.any():
                return
            found, spots = found[hit], spots[hit]
            order = np.argsort(found, kind="stable")
            found, spots = found[order], spots[order]
            begins = [0, *(np.flatnonzero(found[1:] != found[:-1]) + 1).tolist(), len(found)]
            for a, b in zip(begins, begins[1:], strict=False):
                rank = int(found[a])
                if rank not in lists:
                    lists[rank] = []
                    heappush(heap, rank)
                lists[rank].append(spots[a:b])

        while heap:
            rank = heappop(heap)
            spots = lists.pop(rank)
            # two merges side by side enter the pair between them twice
            first = spots[0] if len(spots) == 1 else np.unique(np.concatenate(spots))
            second = following[first]
            left, right, made = int(self.left[rank]), int(self.right[rank]), int(self.made[rank])
            whole = (symbols[first] == left) & (symbols[second] == right)
            first, second = first[whole], second[whole]
            if left == right and len(first):
                whole = every_other(first, second)
                first, second = first[whole], second[whole]
            if not len(first):
                continue
            beyond = following[second]
            symbols[first], symbols[second] = made, DEAD
            following[first], previous[beyond] = beyond, first
            if made in self.before:
                ahead = previous[first]
                enter(self.before[made], ahead, ahead)
            if made in self.after:
                enter(self.after[made], beyond, first)


def every_other(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    """Which pairs merge where each may overlap the one before it: from the left, every other one of a chain."""
    begins = np.r_[True, first[1:] != second[:-1]]
    place = np.arange(len(first))
    return (place - np.maximum.accumulate(np.where(begins, place, 0))) % 2 == 0


class Codec:
    """Ids of texts and texts of ids, as the vocabulary's library gives them."""

    def __init__(self, path: str):
        whole = Tokenizer.from_file(path)
        rules = json.loads(whole.to_str())
        model = rules["model"]
        plain = model["type"] == "BPE" and not any(
            model.get(x) for x in ("dropout", "unk_token", "continuing_subword_prefix", "byte_fallback", "ignore_merges")
        )
        self.normalizer, self.splitter = whole.normalizer, whole.pre_tokenizer
        if not plain or rules.get("decoder") or [w for w, _ in self.splitter.pre_tokenize_str("a  b")] != ["a", "b"]:
            raise ValueError(f"{path}: only byte-pair vocabularies that drop white space and name no decoder can be used")
        self.merges = Merges(model["vocab"], model["merges"], model["end_of_word_suffix"] or "")
        self.special = {x["content"]: x["id"] for x in rules["added_tokens"]}
        self.chunks: dict[str, bytes] = {}
        self.words: dict[str, bytes] = {}
        #: the splitter's letters for the bytes of letters beyond ASCII that ``PLAIN`` knows
        self.letters = {}
        for c in map(chr, range(0xC0, 0x100)):
            ((shown, _),) = self.splitter.pre_tokenize_str(c)
            self.letters |= dict(zip(c.encode(), shown, strict=True))

    def encode(self, texts: list[str]) -> list[bytes]:
        """Little-endian 32-bit ids of each text."""
        wanted: set[str] = set()
        for t in texts:
            wanted.update(self.cut(t))
        first = new = [c for c in wanted if c not in self.chunks]
        if any(s in t for t in texts for s in self.special):
            for c in new:
                if any(s in c for s in self.special):
                    self.chunks[c] = b"".join(self.parts(c))
            new = [c for c in new if c not in self.chunks]
        self.learn(new)
        get = self.chunks.__getitem__
        out = [b"".join(map(get, self.cut(t))) for t in texts]
        if len(self.chunks) > REMEMBERED:
            # those that have come in several slices stay
            again = wanted.difference(first)
            self.chunks = {c: self.chunks[c] for c in again} if len(again) <= REMEMBERED else {}
        if len(self.words) > REMEMBERED:
            self.words = {}
        return out

    @staticmethod
    def cut(text: str) -> list[str]:
        """Pieces between white space; no word crosses them, and normalizing never joins them."""
        if any(c in text for c in NO_SPACE):
            kept = {ord(c): chr(0xE000 + i) for i, c in enumerate(NO_SPACE)}
            if any(c in text for c in kept.values()):
                return [p for p in text.split(" ") if p]
            back = {ord(v): chr(k) for k, v in kept.items()}
            return [p.translate(back) for p in text.translate(kept).split()]
        return text.split()

    def learn(self, chunks: list[str]) -> None:
        """Remember the ids of chunks."""
        words = self.split(chunks)
        self.merge({w for ws in words for w in ws})
        get = self.words.__getitem__
        for c, ws in zip(chunks, words, strict=True):
            self.chunks[c] = get(ws[0]) if len(ws) == 1 else b"".join(map(get, ws))

    def parts(self, chunk: str) -> Iterator[bytes]:
        """Ids of a chunk that holds strings of special tokens; the earliest goes first, of those the longest."""
        while chunk:
            found = [(chunk.find(s), -len(s), s) for s in self.special if s in chunk]
            at, _, name = min(found, default=(len(chunk), 0, ""))
            for p in self.cut(chunk[:at]):
                words = self.split([p])[0]
                self.merge(set(words))
                yield b"".join(map(self.words.__getitem__, words))
            if name:
                yield np.array([self.special[name]], "<i4").tobytes()
            chunk = chunk[at + len(name) :]

    def split(self, chunks: list[str]) -> list[list[str]]:
        """Words of each chunk, in the vocabulary's letters."""
        out: list[list[str]] = []
        strange = []
        for c in chunks:
            if plain := PLAIN(c):
                word, marks = plain.groups()
                word = word.lower()
                if not word.isascii():
                    word = word.encode().decode("latin-1").translate(self.letters)
                out.append([word, marks] if marks else [word])
            else:
                strange.append(len(out))
                out.append([])
        if not strange:
            return out
        text = self.normalizer.normalize_str(" ".join([chunks[i] for i in strange]))
        ends = np.cumsum([len(c) + 1 for c in text.split(" ")])
        assert len(ends) == len(strange)
        found = self.splitter.pre_tokenize_str(text)
        owner = np.searchsorted(ends, [span[0] for _, span in found], side="right").tolist()
        for i, (word, _) in zip(owner, found, strict=True):
            out[strange[i]].append(word)
        return out

    def merge(self, words: set[str]) -> None:
        new = [w for w in words if w not in self.words]
        begin = size = 0
        for i, w in enumerate([*new, None]):
            if w is None or size > INDEX_SYMBOLS:
                if i > begin:
                    self.words.update(zip(new[begin:i], self.merges.merged(new[begin:i]), strict=True))
                begin, size = i, 0
            size += len(w or "") + 1


class Tokens:
    """Texts of ids."""

    def __init__(self, path: str):
        rules = json.loads(Tokenizer.from_file(path).to_str())
        names = rules["model"]["vocab"] | {x["content"]: x["id"] for x in rules["added_tokens"]}
        self.names = np.full(max(names.values()) + 1, None, object)
        for t, i in names.items():
            self.names[i] = t

    def text(self, ids: np.ndarray) -> str:
        """Tokens joined by spaces; ids that the vocabulary lacks are left out."""
        ids = ids[(ids >= 0) & (ids < len(self.names))]
        found = self.names[ids].tolist()
        return " ".join([t for t in found if t is not None] if None in found else found)


def codec(path: str) -> Codec:
    """The codec of a Python worker."""
    return worker_value(f"pair index {path}", lambda: Codec(path))


def tokens(path: str) -> Tokens:
    """The tokens of a Python worker."""
    return worker_value(f"tokens {path}", lambda: Tokens(path))


def _coded(docs: DataFrame, vocabulary: str | None, back: bool) -> DataFrame:
    path = vocabulary or public_tokenizers.path(VOCABULARY)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(path)
        texts = tokens(path) if back else None
        for whole in batches:
            for batch in slices(whole, "text", SLICE_BYTES):
                data = own.encode([t or "" for t in batch.column(1).to_pylist()])
                ends = np.cumsum([0, *(len(x) // 4 for x in data)])
                ids = pa.array(np.frombuffer(b"".join(data), "<i4"))
                out = {"doc_id": batch.column(0), "ids": pa.ListArray.from_arrays(pa.array(ends, pa.int32()), ids)}
                if texts is not None:
                    out["decoded"] = pa.array([texts.text(np.frombuffer(x, "<i4")) for x in data], pa.string())
                yield pa.RecordBatch.from_pydict(out)

    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return rows.mapInArrow(run, "doc_id long, ids array<int>" + (", decoded string" if back else ""))


def encoded(docs: DataFrame, vocabulary: str | None = None) -> DataFrame:
    """``doc_id, ids``: ids of each whole text, as the vocabulary's library gives them without special tokens added.

    A row for each row, repeated or with a null id as well.  A null text counts
    as empty and has no ids.  Very long texts are encoded whole: their distinct
    words are merged in indexes of bounded size.  Strings of special tokens in a
    text become their ids, as in the library.  Other columns are ignored.
    """
    return _coded(docs, vocabulary, back=False)


def round_trip(docs: DataFrame, vocabulary: str | None = None) -> DataFrame:
    """``doc_id, ids, decoded``: ``decoded(encoded(docs))`` in one pass over the rows, with one Python worker a task."""
    return _coded(docs, vocabulary, back=True)


def decoded(coded: DataFrame, vocabulary: str | None = None) -> DataFrame:
    """``doc_id, ids, decoded``: the text of each row's ids, special tokens included.

    Null ids have an empty text, nulls among ids are left out; ids beyond the vocabulary are
    left out, as the library does.  Other columns are ignored.
    """
    path = vocabulary or public_tokenizers.path(VOCABULARY)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = tokens(path)
        for whole in batches:
            for i in range(0, whole.num_rows, 64):
                batch = whole.slice(i, 64)
                ends = batch.column(1).value_lengths().fill_null(0).to_numpy(zero_copy_only=False).cumsum()
                ids = batch.column(1).flatten().to_numpy()
                texts = [own.text(x) for x in np.split(ids, ends[:-1])]
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], ["doc_id", "ids", "decoded"])

    rows = coded.select(F.col("doc_id").cast("long"), F.filter(F.col("ids").cast("array<int>"), lambda i: i.isNotNull()).alias("ids"))
    return rows.mapInArrow(run, "doc_id long, ids array<int>, decoded string")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = round_trip(table(spark, sf_dir, "documents"))
    return rows.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(" ", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
