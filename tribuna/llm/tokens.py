"""Token counts: batch encoding inside Arrow functions that return lengths only.

Texts are cut at boundaries that no token and no special string crosses: before
a single space or line feed between two characters that are no white space.
Arrow splits a slice of bounded bytes and finds its distinct pieces; a bounded
memo per Python worker answers those seen before, and the library encodes the
new ones together.  Every piece's tokens come from the library, so counts are
its own.  Texts with other white space go to the library in long parts.

Cases: null and empty texts have no tokens; very long texts are cut like others;
repeated rows count each; an empty table gives an empty result; further columns
are ignored.
"""

from __future__ import annotations

import os
import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tribuna.llm.common import by_bytes, text_of

VOCABULARY = "byte_bpe_50k.json"
LIMIT = 512
#: Bytes of text in a slice that is split at once, characters in one call of the library.
SLICE_BYTES = 16 << 20
CALL_CHARS = 1 << 16
#: Pieces that a worker remembers; the first to come are mostly the frequent ones, so a full memo stays as it is.
MEMO = 600_000

CUT = re.compile(r"(?<=\S)(?=[ \n]\S)")
#: Up to here letters are letters after normalisation too.
PLAIN = "ɏ"


def vocabulary_path(name: str) -> str:
    """Where a public vocabulary file is; on every executor the same package."""
    import public_tokenizers

    return public_tokenizers.path(name)


class Pieces:
    """A tokenizer with a memo of pieces.

    ``spaced``: white space has tokens, as in byte-level vocabularies; a piece
    is a word with the space before it, or a line feed and a word.  Otherwise
    white space has none, and a piece is a word.
    """

    def __init__(self, path: str, spaced: bool):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # one core per task
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.spaced = spaced
        self.memo: dict[str, bytes | bool] = {}  # False: the piece's borders are not safe

    def ids(self, texts: list[str]) -> Iterator[bytes]:
        """The library's ids of each text, as 32-bit integers."""
        for part in by_bytes(texts, len, CALL_CHARS):
            for e in self.tokenizer.encode_batch_fast(part, add_special_tokens=False):
                yield np.asarray(e.ids, dtype="<u4").tobytes()

    def together(self, words: list[str], glue: str, per_word: int) -> Iterator[tuple[str, bytes]]:
        """Words of plain letters, encoded as one text in which each makes ``per_word`` words of the library."""
        for part in by_bytes(words, len, CALL_CHARS):
            e = self.tokenizer.encode(glue + glue.join(part), add_special_tokens=False)
            at = np.asarray(e.word_ids, dtype=np.int64) // per_word
            if int(e.word_ids[-1]) + 1 != per_word * len(part):  # a letter became something else on the way
                yield from zip(part, self.ids([glue + w for w in part]))
                continue
            data = np.asarray(e.ids, dtype="<u4").tobytes()
            ends = (4 * np.cumsum(np.bincount(at, minlength=len(part)))).tolist()
            start = 0
            for w, end in zip(part, ends):
                yield w, data[start:end]
                start = end

    def safe(self, piece: str) -> bool:
        """Whether the piece's borders are safe: white space only as its leading line feed."""
        return piece[1:].split() == [piece[1:]] if piece[:1] == "\n" else piece.split() == [piece]

    def learn(self, new: list[str]) -> dict[str, bytes | bool]:
        """The ids of new pieces; a stop or comma behind a letter is a word of its own."""
        memo, out = self.memo, {}
        plain, lines, odd, stopped = [], [], [], []
        asked = set(new)
        for p in new:
            if p[-1:] in (".", ",") and p[-2:-1].isalpha():
                stopped.append(p)
                p = p[:-1]
                if p in asked or p in memo:
                    continue
                asked.add(p)
            w = p[1:] if self.spaced and p[:1] == "\n" else p
            if w.isalpha() and max(w) <= PLAIN:
                (plain if w is p else lines).append(w)
            elif self.spaced and not self.safe(p):
                out[p] = False
            else:
                odd.append(p)
        out.update(self.together(plain, " ", 1))
        out.update(("\n" + w, ids) for w, ids in self.together(lines, "\n", 2))
        out.update(zip(odd, self.ids([p if p[:1] == "\n" or not self.spaced else " " + p for p in odd])))
        if stopped:
            marks = {m: next(self.ids([m])) for m in ".,"}
            for p in stopped:
                core = memo.get(p[:-1])
                core = out[p[:-1]] if core is None else core
                out[p] = core if core is False else core + marks[p[-1]]
        return out

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, pa.Array]:
        """For a slice of texts without nulls: offsets of each text's first piece, and the ids of all pieces as binary.

        A text that cannot be split this way is one piece.
        """
        texts = texts.cast(pa.large_string())
        if self.spaced:
            lined = pc.replace_substring(texts, "\n", " \n")
            split = pc.split_pattern(pc.binary_join_element_wise(pa.scalar("\n", pa.large_string()), lined, pa.scalar("", pa.large_string())), " ")
        else:
            split = pc.ascii_split_whitespace(texts)
        coded = split.flatten().dictionary_encode()
        names = coded.dictionary.to_pylist()
        values = list(map(self.memo.get, names))
        new = [i for i, v in enumerate(values) if v is None]
        learnt = self.learn([names[i] for i in new])
        for i in new:
            values[i] = learnt[names[i]]
        if len(self.memo) < MEMO:
            self.memo.update(learnt)
        offsets = split.offsets.to_numpy().astype(np.int64)
        offsets = offsets - offsets[0]
        index = coded.indices.to_numpy()
        if not self.spaced:
            return offsets, pa.array(values, pa.large_binary()).take(coded.indices)
        hard = np.array([v is False for v in values], dtype=bool)
        feed = len(next(self.ids(["\n"])))  # before each text stands a line feed that it has not
        data = pa.array([v or b"" for v in values], pa.large_binary()).take(pa.array(index))
        odd = np.flatnonzero(np.add.reduceat(hard[index], offsets[:-1])) if hard.any() else []
        first = {}
        for i in odd:
            first[int(i)] = b"".join(self.ids(list(self.parts(texts[int(i)].as_py()))))
        self.feed, self.first = feed, first
        return offsets, data

    def lengths(self, texts: pa.Array) -> np.ndarray:
        """Tokens of each text."""
        if not len(texts):
            return np.empty(0, dtype=np.int64)
        offsets, data = self.encode(texts)
        ends = np.frombuffer(data.buffers()[1], dtype=np.int64)[data.offset : data.offset + len(data) + 1]
        out = (ends[offsets[1:]] - ends[offsets[:-1]]) // 4
        if self.spaced:
            out = out - self.feed // 4
            for i, ids in self.first.items():
                out[i] = len(ids) // 4
        return out

    def parts(self, text: str, most: int = CALL_CHARS) -> Iterator[str]:
        """A text of any white space in parts of about ``most`` characters, cut at safe places."""
        start = 0
        while len(text) - start > most:
            cut = CUT.search(text, start + most)
            if not cut:
                break
            yield text[start : cut.start()]
            start = cut.start()
        yield text[start:]


_LOADED: dict = {}


def loaded(path: str, spaced: bool) -> Pieces:
    """The tokenizer of this worker, kept between tasks."""
    if (path, spaced) not in _LOADED:
        _LOADED[path, spaced] = Pieces(path, spaced)
    return _LOADED[path, spaced]


def slices(batch: pa.RecordBatch, column: str, most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of a batch of about ``most`` bytes of text each, so that a slice with long texts has few rows."""
    sizes = pc.binary_length(batch.column(column)).to_pylist()
    start, held = 0, 0
    for i, n in enumerate(sizes):
        if i > start and held + n > most:
            yield batch.slice(start, i - start)
            start, held = i, 0
        held += n
    if len(batch) > start:
        yield batch.slice(start)


def count_batches(batches: Iterator[pa.RecordBatch], path: str) -> Iterator[pa.RecordBatch]:
    pieces = loaded(path, True)
    for batch in batches:
        for rows in slices(batch, "text"):
            counts = pa.array(pieces.lengths(rows.column("text")), pa.int64())
            yield pa.RecordBatch.from_arrays([rows.column("doc_id"), rows.column("n_bytes"), counts], names=["doc_id", "n_bytes", "n_tokens"])


def count_tokens(docs: DataFrame, vocabulary: str | None = None, limit: int = LIMIT, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """One row per document: UTF-8 bytes, tokens, and whether these are more than ``limit``.

    ``vocabulary`` is the path of a tokenizer file of the byte-level kind, the
    same on every executor.
    """
    path = vocabulary or vocabulary_path(VOCABULARY)
    slim = docs.select(F.col(doc_id).cast("long").alias("doc_id"), text_of(text).alias("text"))
    slim = slim.withColumn("n_bytes", F.octet_length("text").cast("long"))
    out = slim.mapInArrow(lambda batches: count_batches(batches, path), "doc_id long, n_bytes long, n_tokens long")
    return out.withColumn("over_limit", F.col("n_tokens") > limit)
