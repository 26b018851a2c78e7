"""Byte-level BPE, encoding and decoding, by a contiguous array of ranks.

A text is split at special strings, then into words.  A short word's part
boundaries and the ranks of its neighbouring parts' merges stand in contiguous
arrays; the smallest rank is looked for from the left, its boundary deleted and
the two ranks beside it taken anew, until no merge is left.  The new words of a
slice are merged together by length: each step deletes one boundary of every
word that is not done, so their arrays stay of one width and are the rows of a
matrix.  For words of more than ``SHORT`` bytes, where scanning would be
quadratic, the same merges are taken from a heap over linked parts.  Words met
before are answered by a bounded memo.

Words are split by the usual pattern of byte-level vocabularies.  Tables of
letters differ by Unicode version, so each character beyond ASCII is tried once
per worker against the tokenizer file's own splitter, and texts with a character
on which the two disagree are split by that.

Cases: null and empty texts have no ids and decode to the empty text; texts of
any length are encoded whole; special strings inside a text become their ids;
repeated rows are encoded each; an empty table gives an empty result; further
columns are ignored.  Decoding drops unknown ids and puts U+FFFD for bytes that
are no UTF-8.
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Iterator
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tribuna.llm.common import by_bytes, text_of
from tribuna.llm.tokens import slices, vocabulary_path

VOCABULARY = "byte_bpe_50k.json"
#: Bytes up to which a word is merged by scanning.
SHORT = 96
#: Words that a worker remembers.
MEMO = 300_000
#: Bytes of text that are encoded at once, and bytes of new words that are merged at once.
SLICE_BYTES = 2 << 20
MERGE_BYTES = 1 << 18
#: The rank of two parts that no merge joins.
NONE = np.iinfo(np.int32).max

# The word pattern of byte-level vocabularies, for any text and for ASCII only.
WORDS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
ASCII_WORDS = re.compile(r"'(?:[stmd]|re|ve|ll)| ?[A-Za-z]+| ?[0-9]+| ?[^\sA-Za-z0-9]+|\s+(?!\S)|\s+", re.ASCII)


def byte_letters() -> dict[str, int]:
    """The letter of each byte: printable bytes stand for themselves, the others for the letters from U+0100 on."""
    printable = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    others = [b for b in range(256) if b not in printable]
    return {chr(b): b for b in printable} | {chr(0x100 + i): b for i, b in enumerate(others)}


class Splitter:
    """Words of a text, as the tokenizer's own splitter has them."""

    def __init__(self, own):
        import regex

        self.any = regex.compile(WORDS)
        self.own = own
        self.tried: set[str] = set(map(chr, range(128)))
        self.odd: set[str] = set()

    def by_own(self, text: str) -> list[str]:
        return [text[a:b] for _, (a, b) in self.own.pre_tokenize_str(text)]

    def __call__(self, text: str) -> list[str]:
        if text.isascii():
            return ASCII_WORDS.findall(text)
        letters = set(text)
        for c in letters - self.tried:
            probe = f"a{c}1{c} {c}b{c}{c}!{c}\n {c}"
            if self.by_own(probe) != self.any.findall(probe):
                self.odd.add(c)
            self.tried.add(c)
        return self.any.findall(text) if self.odd.isdisjoint(letters) else self.by_own(text)


class Codec(dict):
    """Tables of a tokenizer file; as a mapping, the ids of a word as 32-bit little-endian integers."""

    def __init__(self, path: str):
        super().__init__()
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model, before = spec["model"], spec["pre_tokenizer"]
        plain = ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "fuse_unk", "byte_fallback", "ignore_merges")
        if (model["type"] != "BPE" or any(model.get(k) for k in plain) or spec["normalizer"] or before["type"] != "ByteLevel"
                or before["add_prefix_space"] or not before["use_regex"] or spec["decoder"]["type"] != "ByteLevel"
                or any(t["lstrip"] or t["rstrip"] or t["single_word"] for t in spec["added_tokens"])):
            raise ValueError("not a plain byte-level BPE vocabulary")
        letters = byte_letters()

        def raw(token: str) -> bytes:
            """Bytes of a token; what is not written in byte letters stands for itself."""
            return bytes(map(letters.__getitem__, token)) if letters.keys() >= set(token) else token.encode()

        merges = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        self.rank = {(raw(a), raw(b)): i for i, (a, b) in enumerate(merges)}
        self.id_of = {raw(t): i for t, i in model["vocab"].items()}
        self.made = np.array([self.id_of[raw(a + b)] for a, b in merges], dtype=np.int64)  # by rank: the id of the merged part
        self.of_byte = np.array([self.id_of[bytes([b])] for b in range(256)], dtype=np.int64)
        self.n_ids = 1 + max(self.id_of.values())
        pairs = np.array([self.id_of[a] * self.n_ids + self.id_of[b] for a, b in self.rank], dtype=np.int64)
        order = np.argsort(pairs)
        self.pairs, self.pair_ranks = pairs[order], np.fromiter(self.rank.values(), dtype=np.int32)[order]
        every = np.arange(256)
        self.byte_ranks = self.ranks(self.of_byte[every[:, None]], self.of_byte[every[None, :]])
        self.fresh: dict[str, bytes] = {}  # words of the slice at hand that the memo has no room for
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.bytes_of = {i: b for b, i in self.id_of.items()} | {i: raw(t) for t, i in self.special.items()}
        longest_first = sorted(self.special, key=len, reverse=True)
        self.cut = re.compile("(" + "|".join(map(re.escape, longest_first)) + ")") if longest_first else None
        self.split = Splitter(Tokenizer.from_file(path).pre_tokenizer)

    def ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of the merge of two parts by their ids."""
        pair = left * self.n_ids + right
        at = np.minimum(np.searchsorted(self.pairs, pair), len(self.pairs) - 1)
        return np.where(self.pairs[at] == pair, self.pair_ranks[at], NONE)

    def scan(self, words: list[bytes]) -> list[tuple[np.ndarray, np.ndarray]]:
        """Part boundaries and ids of short words of one length after all merges."""
        data = np.frombuffer(b"".join(words), dtype=np.uint8).reshape(len(words), -1)
        width = data.shape[1]
        at = np.tile(np.arange(width + 1, dtype=np.uint8), (len(words), 1))
        ids = self.of_byte[data]
        ranks = self.byte_ranks[data[:, :-1], data[:, 1:]]
        out: list = [None] * len(words)
        word = np.arange(len(words))

        def finish(rows: np.ndarray) -> None:
            for w, a, i in zip(word[rows].tolist(), at[rows], ids[rows]):
                out[w] = a, i

        while width > 1 and len(word):
            i = ranks.argmin(1)  # of equal ranks the leftmost
            low = ranks[np.arange(len(word)), i]
            left = low < NONE
            if not left.all():
                finish(~left)
                word, at, ids, ranks, i, low = word[left], at[left], ids[left], ranks[left], i[left], low[left]
            rows = np.arange(len(word))
            ids[rows, i] = self.made[low]
            # Delete boundary i + 1, the part to its right, and the rank of the two parts.
            cols = np.arange(width)[None, :]
            at = np.take_along_axis(at, cols + (cols > i[:, None]), 1)
            width -= 1
            cols = cols[:, :width]
            ids = np.take_along_axis(ids, cols + (cols > i[:, None]), 1)
            ranks = np.take_along_axis(ranks, cols[:, : width - 1] + (cols[:, : width - 1] >= i[:, None]), 1)
            for k in (i, i - 1):
                r = rows[(k >= 0) & (k < width - 1)]
                ranks[r, k[r]] = self.ranks(ids[r, k[r]], ids[r, k[r] + 1])
        finish(np.ones(len(word), dtype=bool))
        return out

    def linked_boundaries(self, word: bytes) -> list[int]:
        """The same for a long word: the next merge is the top of a heap; entries of parts that have changed since are passed over."""
        n, rank = len(word), self.rank.get
        end = list(range(1, n + 1))  # by a part's start: its end, 0 once it is gone
        start = [-1, *range(n - 1), n - 1]  # by a part's start: that of the part before

        def pair(i: int) -> tuple[int, int, int, int] | None:
            j = end[i]
            if j < n and (r := rank((word[i:j], word[j : end[j]]))) is not None:
                return r, i, j, end[j]
            return None

        heap = [p for i in range(n - 1) if (p := pair(i))]
        heapify(heap)
        while heap:
            _, i, j, k = heappop(heap)
            if end[i] != j or end[j] != k:
                continue
            end[i], end[j] = k, 0
            start[k] = i
            for p in (pair(i), pair(start[i]) if i else None):
                if p:
                    heappush(heap, p)
        return [0, *(e for e in end if e)]

    def merge(self, word: bytes) -> list[int]:
        """Ids of a long word."""
        at = self.linked_boundaries(word)
        return [self.id_of[word[a:b]] for a, b in zip(at, at[1:])]

    def learn(self, words: set[str]) -> None:
        """Merges words that are not in the memo; what the memo has no room for is kept until the next slice."""
        self.fresh = {}
        by_length: dict[int, list[tuple[str, bytes]]] = {}
        for w in words:
            raw = w.encode()
            by_length.setdefault(len(raw) if len(raw) <= SHORT else 0, []).append((w, raw))
        for w, raw in by_length.pop(0, []):
            self.fresh[w] = np.array(self.merge(raw), dtype="<u4").tobytes()
        for length, some in by_length.items():
            for part in by_bytes(some, lambda _: length, MERGE_BYTES):
                for (w, _), (_, ids) in zip(part, self.scan([raw for _, raw in part])):
                    (self if len(self) < MEMO else self.fresh)[w] = ids.astype("<u4").tobytes()

    def __missing__(self, word: str) -> bytes:
        return self.fresh[word]

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as 32-bit little-endian integers."""
        cut = [[t] if self.cut is None or not self.cut.search(t) else self.cut.split(t) for t in texts]
        split = [[self.split(part) for part in parts[::2]] for parts in cut]
        self.learn({w for parts in split for words in parts for w in words if w not in self})
        out = []
        for parts, words in zip(cut, split):
            ids = [b"".join(map(self.__getitem__, w)) for w in words]
            for k, special in enumerate(parts[1::2]):
                ids[k] += self.special[special].to_bytes(4, "little")
            out.append(ids[0] if len(ids) == 1 else b"".join(ids))
        return out

    def decode(self, ids: bytes) -> str:
        """Text of such ids."""
        parts = map(self.bytes_of.get, np.frombuffer(ids, dtype="<u4").tolist())
        return b"".join(filter(None, parts)).decode("utf-8", "replace")


_LOADED: dict[str, Codec] = {}


def loaded(path: str) -> Codec:
    """The tables of this worker, kept between tasks."""
    if path not in _LOADED:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        _LOADED[path] = Codec(path)
    return _LOADED[path]


def encode(docs: DataFrame, vocabulary: str | None = None, text: str = "text", doc_id: str = "doc_id", decoded: bool = False) -> DataFrame:
    """``doc_id``, ``n_tokens`` and ``ids`` (binary, 32-bit little-endian) of every whole text.

    ``vocabulary`` is the path of a tokenizer file, the same on every executor.
    ``decoded`` adds the text that the ids decode to, in the same pass.
    """
    path = vocabulary or vocabulary_path(VOCABULARY)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = loaded(path)
        for batch in batches:
            for rows in slices(batch, "text", SLICE_BYTES):
                ids = codec.encode(rows.column("text").to_pylist())
                out = [rows.column("doc_id"), pa.array([len(i) // 4 for i in ids], pa.int64()), pa.array(ids, pa.binary())]
                names = ["doc_id", "n_tokens", "ids"]
                if decoded:
                    out.append(pa.array([codec.decode(i) for i in ids], pa.string()))
                    names.append("decoded")
                yield pa.RecordBatch.from_arrays(out, names=names)

    schema = "doc_id long, n_tokens long, ids binary" + (", decoded string" if decoded else "")
    return docs.select(F.col(doc_id).cast("long").alias("doc_id"), text_of(text).alias("text")).mapInArrow(run, schema)


def decode(encoded: DataFrame, vocabulary: str | None = None) -> DataFrame:
    """``doc_id`` and ``text`` of rows as :func:`encode` returns them; null ids are no ids."""
    path = vocabulary or vocabulary_path(VOCABULARY)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = loaded(path)
        for batch in batches:
            for rows in slices(batch, "ids", 4 * SLICE_BYTES):
                texts = pa.array([codec.decode(i) for i in rows.column("ids").to_pylist()], pa.string())
                yield pa.RecordBatch.from_arrays([rows.column("doc_id"), texts], names=["doc_id", "text"])

    ids = F.coalesce("ids", F.lit(b""))
    return encoded.select("doc_id", ids.alias("ids")).mapInArrow(run, "doc_id long, text string")
