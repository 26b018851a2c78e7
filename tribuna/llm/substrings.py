"""Removal of byte strings that an earlier document has, by merging Burrows-Wheeler transforms of shards.

A window is a string of LENGTH bytes.  Every window is known by its anchor, the
least hash of the short grams in it; windows in a row with one anchor make a
segment.  Equal windows have equal anchors, so all that can match lies under one
anchor.

1. Anchors that two documents share are found from packed hashes; the others'
   windows are unique and take no further part.
2. Documents lie in slots by the hash of their id and text.  A slot's task gets its
   texts and, packed, a row per bucket with their shared anchors; it cuts the
   segments out and sends them to buckets of anchors.  Segments that a slot has
   several times go along once, with the smallest document; the later ones are
   known to be removed.
3. A bucket knows the smallest document of every distinct segment.  Where an
   anchor has one segment only, that decides.  The other segments are cut into
   shards; the suffixes of a shard are sorted once, for its Burrows-Wheeler
   transform, and the shards are merged: starting from the ends of the windows
   side by side, each round moves every row to the suffix two bytes longer (the
   last one of an odd length: one), stably by these bytes, so after rounds of h
   bytes the interleaving is right for h bytes, and borders between rows are
   borders between different strings of h bytes.  At LENGTH bytes the rows between
   two borders are one repeated window; those of documents above the smallest one
   are removed.  No suffix is compared or sorted again.
4. Runs of removed windows go back to the slots, packed, a row per bucket, and are
   cut out there.  A document is named in a slot by its place among the slot's
   pairs of id and text, which is the same in every step.

A segment that is the same everywhere costs a slot one segment and a bucket one
row per slot.  What stands around a frequent line differs by document, and so do
its segments: under an anchor of more than HOT_DOCS documents every window goes
its own way, by the hash of its bytes, so that equal windows still meet and no
bucket has to take all that is under the anchor.

Cases: null and empty texts have no bytes; texts below LENGTH bytes keep all; a
row without id keeps all its bytes and takes none from others; rows of equal id
take nothing from each other; an empty table gives an empty result; further
columns are ignored; texts of any length are read whole (a text is held in
memory with some tens of bytes of work space per byte).
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tribuna.llm.common import by_bytes, give_back, one_row, text_of, tidy
from tribuna.llm.jaccard import from_bytes, top_bytes
from tribuna.llm.shingles import mix, powers
from tribuna.llm.tokens import slices
from tribuna.session import cut_lineage

LENGTH = 50
#: Bytes of a gram; a window has LENGTH - GRAM + 1 of them.
GRAM = 24
#: Bytes of text per slot, per slice of it that is hashed at once, and of strings per shard; anchors per bucket of the first step, bytes of segments of the second.
SLOT = 8 << 20
SLICE = 1 << 20
SHARD_BYTES = 256 << 10
BUCKET_ANCHORS = 500_000
BUCKET_BYTES = 6_000_000
#: Above this many documents the windows of an anchor are dealt out one by one.
HOT_DOCS = 1_000
#: ``mix`` keeps zero as it is; this moves it.
_SPREAD = np.uint64(0x9E3779B97F4A7C15)


class Slice:
    """The windows of a slice of texts: the segments (first window, windows, text) and the hash of their anchors."""

    def __init__(self, texts: pa.Array, length: int, gram: int):
        texts = texts.cast(pa.large_string())
        offsets = np.frombuffer(texts.buffers()[1], dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1]
        first, last = int(offsets[0]), int(offsets[-1])
        self.raw = np.frombuffer(texts.buffers()[2], dtype=np.uint8)[first:last] if last > first else np.empty(0, dtype=np.uint8)
        self.offsets = offsets = offsets - first
        n = len(self.raw)
        if n < length:
            self.start = self.count = self.owner = np.empty(0, dtype=np.int64)
            self.anchor = np.empty(0, dtype=np.uint64)
            return
        up, down = powers(n)
        sums = np.concatenate((np.zeros(1, dtype=np.uint64), np.cumsum((self.raw.astype(np.uint64) + np.uint64(1)) * up, dtype=np.uint64)))
        grams = mix((sums[gram:] - sums[:-gram]) * down[: n - gram + 1])
        self.sums, self.down = sums, down
        del sums, up, down
        key = (grams & np.uint64(0xFFFFFFFF00000000)) | np.arange(len(grams), dtype=np.uint64)
        width, have = length - gram + 1, 1
        while have < width:  # the least key of the next ``have`` grams, doubled
            step = min(have, width - have)
            key = np.minimum(key[:-step], key[step:])
            have += step
        at = key.astype(np.uint32).astype(np.int32)
        del key
        windows = np.arange(n - length + 1, dtype=np.int32)
        owner = (np.searchsorted(offsets, windows, side="right") - 1).astype(np.int32)
        inside = windows + length <= offsets[owner + 1]
        begin = inside & np.concatenate(([True], (at[1:] != at[:-1]) | (owner[1:] != owner[:-1]) | ~inside[:-1]))
        self.start = np.flatnonzero(begin)
        stop = np.append(self.start[1:], n - length + 1)
        held = np.concatenate(([0], np.cumsum(inside)))
        self.count = held[stop] - held[self.start]
        self.owner = owner[self.start]
        # A least hash is small; hashed once more, anchors spread over all buckets.
        self.anchor = mix(grams[at[self.start]] ^ _SPREAD)

    def hashes(self, start: np.ndarray, size: np.ndarray) -> np.ndarray:
        """Hashes of strings of the slice; they depend on the bytes only."""
        return mix((self.sums[start + size] - self.sums[start]) * self.down[start] + size.astype(np.uint64))


def ranges(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The numbers start, start + 1, ... of all ranges, one behind the other."""
    ends = np.cumsum(size)
    return np.repeat(start - (ends - size), size) + np.arange(int(ends[-1]) if len(ends) else 0)


def packed(*columns: np.ndarray) -> bytes:
    """Whole numbers of equal length, by their bytes' places, compressed."""
    import zstandard

    planes = np.array(columns, dtype="<i8").view(np.uint8).reshape(len(columns), -1, 8).transpose(0, 2, 1)
    return zstandard.ZstdCompressor(level=1).compress(planes.tobytes())


def unpacked(blob: bytes, columns: int) -> np.ndarray:
    import zstandard

    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(blob), dtype=np.uint8).reshape(columns, 8, -1)
    return np.ascontiguousarray(planes.transpose(0, 2, 1)).view("<i8")[:, :, 0]


def joined(number: np.ndarray, start: np.ndarray, windows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Runs in order, those of a document that meet or overlap as one."""
    order = np.lexsort((start, number))
    number, start, windows = number[order], start[order], windows[order]
    if not len(start):
        return number, start, windows
    wide = int((start + windows).max()) + 2  # ends of later documents are above all before
    ends = np.maximum.accumulate(number * wide + start + windows)
    fresh = np.flatnonzero(np.concatenate(([True], (number * wide + start)[1:] > ends[:-1])))
    last = ends[np.append(fresh[1:], len(ends)) - 1] - number[fresh] * wide
    return number[fresh], start[fresh], last - start[fresh]


def run_blob(number: np.ndarray, start: np.ndarray, windows: np.ndarray) -> bytes:
    number, start, windows = joined(number, start, windows)
    return packed(np.diff(number, prepend=0), start, windows)


def numbers(ids: list, texts: list, length: int) -> np.ndarray:
    """For each row its place among the different pairs of id and text of the slot, in their order; -1 without id or below ``length`` bytes."""
    pairs = [(i, t) if i is not None and len(t) >= length else None for i, t in zip(ids, texts)]
    place = {p: k for k, p in enumerate(sorted({p for p in pairs if p is not None}))}
    return np.array([-1 if p is None else place[p] for p in pairs], dtype=np.int64)


def send_anchors(batches: Iterator[pa.RecordBatch], length: int, gram: int, buckets: int, sig_bytes: int, id_bytes: int) -> Iterator[pa.RecordBatch]:
    """Per bucket the anchors of a slice with their documents; anchors that documents of the slice share are told at once."""
    for batch in batches:
        for rows in slices(batch, "text", SLICE):
            s = Slice(rows.column("text"), length, gram)
            if not len(s.start):
                continue
            keys = np.asarray(rows.column("key")).astype(np.int64).view(np.uint64) >> np.uint64(8 * (8 - id_bytes))
            anchor, who = s.anchor, keys[s.owner]
            order = np.lexsort((who, anchor))
            anchor, who = anchor[order], who[order]
            fresh = np.concatenate(([True], (anchor[1:] != anchor[:-1]) | (who[1:] != who[:-1])))
            anchor, who = anchor[fresh], who[fresh]
            first = np.concatenate(([True], anchor[1:] != anchor[:-1]))
            shared = ~first | ~np.concatenate((first[1:], [True]))
            bucket = ((anchor >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)
            here, begins = np.unique(bucket, return_index=True)
            packed = np.concatenate(
                (top_bytes(anchor << np.uint64(8 * (8 - sig_bytes)), sig_bytes), top_bytes(who << np.uint64(8 * (8 - id_bytes)), id_bytes)), axis=1
            )
            out = [
                (b, packed[x:y][first[x:y]].tobytes(), packed[x:y][shared[x:y]].tobytes())
                for b, x, y in zip(here.tolist(), begins.tolist(), np.append(begins[1:], len(bucket)).tolist())
            ]
            b, new, told = zip(*out)
            yield pa.RecordBatch.from_arrays([pa.array(b, pa.int32()), pa.array(new, pa.binary()), pa.array(told, pa.binary())], names=["bucket", "new", "told"])


def shared_anchors(table: pa.Table, sig_bytes: int, id_bytes: int, hot_docs: int) -> pa.Table:
    """Per document the anchors of this bucket that it shares with another one, and which of these are hot (with the bucket: of one
    bucket and equal low bytes all are or none is)."""
    width = sig_bytes + id_bytes
    new = np.frombuffer(b"".join(table.column("new").to_pylist()), dtype=np.uint8).reshape(-1, width)
    told = np.frombuffer(b"".join(table.column("told").to_pylist()), dtype=np.uint8).reshape(-1, width)
    sig, who = from_bytes(new[:, :sig_bytes]), from_bytes(new[:, sig_bytes:])
    names, back, count = np.unique(sig, return_inverse=True, return_counts=True)
    hit = count[back] > 1
    sig = np.concatenate((sig[hit], from_bytes(told[:, :sig_bytes])))
    who = np.concatenate((who[hit], from_bytes(told[:, sig_bytes:])))
    order = np.lexsort((sig, who))
    sig, who = sig[order], who[order]
    if len(sig):
        fresh = np.concatenate(([True], (sig[1:] != sig[:-1]) | (who[1:] != who[:-1])))
        sig, who = sig[fresh], who[fresh]
    begin = np.flatnonzero(np.concatenate(([True], who[1:] != who[:-1]))) if len(who) else np.empty(0, dtype=np.int64)
    _, back, count = np.unique(sig, return_inverse=True, return_counts=True)
    hot = count[back] > hot_docs if len(sig) else np.empty(0, dtype=bool)
    bucket = table.column("bucket")[0].as_py()
    low = top_bytes(sig.astype(np.uint64) << np.uint64(8 * (8 - sig_bytes)), sig_bytes)
    ends = np.append(begin, len(who))
    held = np.concatenate(([0], np.cumsum(hot)))[ends]
    pairs = np.column_stack((np.full(held[-1], bucket), sig[hot])).astype("<i8")
    out = pa.table({
        "short": pa.array(who[begin], pa.int64()), "anchors": binary(low, ends * sig_bytes), "n": pa.array(np.diff(ends), pa.int64()),
        "hot": binary(pairs, held * 16), "n_hot": pa.array(np.diff(held), pa.int64()),
    })
    del new, told, sig, who, low, pairs
    give_back()
    return out


def binary(values: np.ndarray, offsets: np.ndarray) -> pa.Array:
    """The bytes of an array, cut at the offsets."""
    return pa.Array.from_buffers(pa.binary(), len(offsets) - 1, [None, pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(values.tobytes())])


def to_slots(shared: pa.Table, slots: int, id_bytes: int) -> pa.Table:
    """The rows of ``shared_anchors``, which are in the order of their documents, as one row per slot."""
    short, n, n_hot = (np.asarray(shared.column(c)) for c in ("short", "n", "n_hot"))
    slot = (short >> (8 * (id_bytes - 4))) * slots >> 32
    begin = np.flatnonzero(np.concatenate(([True], slot[1:] != slot[:-1]))) if len(slot) else np.empty(0, dtype=np.int64)
    ends = np.append(begin, len(slot))

    def whole(name: str) -> pa.Array:
        column = shared.column(name).combine_chunks()
        return pa.Array.from_buffers(pa.binary(), len(begin), [None, pa.py_buffer(np.frombuffer(column.buffers()[1], dtype=np.int32)[ends].copy()), column.buffers()[2]])

    return pa.table({
        "slot": pa.array(slot[begin], pa.int64()),
        "docs": pa.array([packed(np.diff(short[x:y], prepend=0), n[x:y]) for x, y in zip(ends.tolist(), ends[1:].tolist())], pa.binary()),
        "anchors": whole("anchors"), "hot": whole("hot"),
        "n": pa.array([int(n[x:y].sum()) for x, y in zip(ends.tolist(), ends[1:].tolist())], pa.int64()),
        "n_hot": pa.array([int(n_hot[x:y].sum()) for x, y in zip(ends.tolist(), ends[1:].tolist())], pa.int64()),
    })


def suffix_order(symbols: np.ndarray, end_of: np.ndarray, limit: int) -> np.ndarray:
    """Order of all suffixes of strings that end in a mark (0), by doubling from seven symbols on; equal ones in the order of their strings."""
    n = len(symbols)
    at = np.arange(n)
    key = np.zeros(n, dtype=np.int64)
    for j in range(7):
        beyond = at + j > end_of
        key = (key << 9) | np.where(beyond, 0, symbols[np.minimum(at + j, n - 1)])
    have = 7
    while True:
        if have >= limit:
            return np.argsort(key * n + at) if have > 7 and n < 2_000_000 else np.argsort(key, kind="stable")
        order = np.argsort(key)
        sorted_key = key[order]
        rank = np.empty(n, dtype=np.int64)
        rank[order] = np.cumsum(np.concatenate(([0], sorted_key[1:] != sorted_key[:-1])))
        key = rank * (n + 2) + np.where(at + have > end_of, 0, rank[np.minimum(at + have, n - 1)] + 1)
        have *= 2


class Shard:
    """Burrows-Wheeler transform of some strings: the symbol before each suffix, in the order of the suffixes (0 before a string)."""

    def __init__(self, strings: list[bytes], length: int):
        sizes = np.array([len(x) for x in strings], dtype=np.int64)
        ends = np.cumsum(sizes + 1) - 1
        symbols = np.zeros(int(ends[-1]) + 1, dtype=np.int64)
        body = np.ones(len(symbols), dtype=bool)
        body[ends] = False
        symbols[body] = np.frombuffer(b"".join(strings), dtype=np.uint8).astype(np.int64) + 1
        order = suffix_order(symbols, np.repeat(ends, sizes + 1), int(sizes.max()) + 1)
        before = np.zeros(len(symbols), dtype=np.int16)
        before[1:] = symbols[:-1]
        before[ends - sizes] = 0
        self.bwt = before[order]
        # The row of the suffix that is one byte longer: rows keep their order below their symbol.
        by_symbol = np.argsort(self.bwt, kind="stable")
        self.step = np.zeros(len(order), dtype=np.int32)
        self.step[by_symbol[len(strings) :]] = np.arange(len(strings), len(order), dtype=np.int32)
        row = np.empty(len(order), dtype=np.int32)
        row[order] = np.arange(len(order), dtype=np.int32)
        windows = sizes - length + 1
        self.owner = np.repeat(np.arange(len(strings)), windows)
        self.place = np.arange(int(windows.sum())) - np.repeat(np.cumsum(windows) - windows, windows)
        self.tails = row[np.repeat(ends - sizes, windows) + self.place + length]


def merge_shards(shards: list[Shard], length: int) -> tuple[np.ndarray, np.ndarray]:
    """The windows of all shards (numbered through) in the order of their bytes, and where a new one begins.

    Rows start at the suffixes behind the windows, the shards side by side.  Each
    round is one step of refinement: a row moves to the suffix that is two bytes
    longer, stably by these bytes (by the first of them before the second).  Suffixes that no window needs are left out.
    """
    base = np.concatenate(([0], np.cumsum([len(x.bwt) for x in shards]))).astype(np.int32)
    symbol = (np.concatenate([x.bwt for x in shards]) - 1).astype(np.uint8)  # no row reads the mark before a string
    step = np.concatenate([x.step + b for x, b in zip(shards, base)])
    rows = np.concatenate([x.tails + b for x, b in zip(shards, base)])
    window = np.arange(len(rows), dtype=np.int32)
    group = np.zeros(len(rows), dtype=np.int32)
    fresh = np.zeros(len(rows), dtype=bool)
    two, over = (symbol[step].astype(np.uint16) << np.uint16(8)) | symbol, step[step]
    for round_ in range((length + 1) // 2):
        value, to = (two, over) if 2 * round_ + 1 < length else (symbol, step)
        byte = value[rows]
        order = np.argsort(byte, kind="stable")
        byte, group = byte[order], group[order]
        rows, window = to[rows[order]], window[order]
        fresh = np.concatenate(([True], (byte[1:] != byte[:-1]) | (group[1:] != group[:-1])))
        group = np.cumsum(fresh, dtype=np.int32)
    return window, fresh


def equal_strings(raw: np.ndarray, one: np.ndarray, other: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Which strings, by their first bytes, are the same."""
    out = np.empty(len(one), dtype=bool)
    for part in by_bytes(range(len(one)), lambda i, s=size.tolist(): s[i], SHARD_BYTES):
        x, y = part[0], part[-1] + 1
        same = raw[ranges(one[x:y], size[x:y])] == raw[ranges(other[x:y], size[x:y])]
        out[x:y] = np.logical_and.reduceat(same, np.cumsum(size[x:y]) - size[x:y])
    return out


def send_segments(batches: Iterator[pa.RecordBatch], length: int, gram: int, buckets: int, sig_bytes: int, anchor_buckets: int) -> Iterator[pa.RecordBatch]:
    """Per bucket the segments under shared anchors of the documents of a batch, and the runs of windows that are known to be removed (bucket null).

    Under a hot anchor every window is a segment, dealt by the hash of its bytes.
    """
    import zstandard

    pack = zstandard.ZstdCompressor(level=1)
    for batch in batches:
        ids = batch.column("doc_id").to_pylist()
        number = numbers(ids, batch.column("text").cast(pa.binary()).to_pylist(), length)
        once = np.zeros(len(ids), dtype=bool)
        once[np.unique(number, return_index=True)[1]] = True  # the others are equal rows
        once &= number >= 0
        blobs = [b"".join(x) for x in batch.column("anchors").to_pylist()]
        have = from_bytes(np.frombuffer(b"".join(blobs), dtype=np.uint8).reshape(-1, sig_bytes))
        wanted = np.sort((np.repeat(np.arange(len(ids)), [len(x) // sig_bytes for x in blobs]) << 40) | have)
        hots = np.frombuffer(b"".join(x for h in batch.column("hot").to_pylist() for x in h), dtype="<i8").reshape(-1, 2)
        hots = np.unique((hots[:, 0] << 40) | hots[:, 1])
        raws, found, base, row = [], [], 0, 0
        for rows in slices(batch, "text", SLICE):
            s = Slice(rows.column("text"), length, gram)
            if len(s.start):
                low = ((s.anchor << np.uint64(8 * (8 - sig_bytes))) >> np.uint64(8 * (8 - sig_bytes))).astype(np.int64)
                mine = wanted[slice(*np.searchsorted(wanted, (row << 40, (row + len(rows)) << 40)))]
                chosen = np.flatnonzero(np.isin((s.owner.astype(np.int64) + row) << 40 | low, mine) & once[s.owner + row])
                anchor, start, count, owner = s.anchor[chosen], s.start[chosen], s.count[chosen], s.owner[chosen].astype(np.int64)
                home = ((anchor >> np.uint64(32)) * np.uint64(anchor_buckets) >> np.uint64(32)).astype(np.int64)
                single = np.isin((home << 40) | low[chosen], hots)
                each = np.where(single, count, 1)
                start = ranges(start, each)
                count, anchor, owner, single = (np.repeat(x, each) for x in (np.where(single, 1, count), anchor, owner, single))
                hashed = s.hashes(start, count + length - 1)
                found.append((owner + row, start - s.offsets[owner], start + base, count, anchor.view(np.int64), hashed.view(np.int64), single))
            raws.append(s.raw)
            base, row = base + len(s.raw), row + len(rows)
            del s
        if not found or not sum(len(x[0]) for x in found):
            continue
        owner, at, start, count, anchor, hashed, single = (np.concatenate(x) for x in zip(*found))
        raw, size, doc = np.concatenate(raws), count + length - 1, number[owner]
        id_of = np.array([i if i is not None else 0 for i in ids], dtype=np.int64)[owner]
        del found, raws
        # Equal strings lie together, that of the smallest document first.
        order = np.lexsort((at, doc, hashed))
        fresh = np.concatenate(([True], hashed[order[1:]] != hashed[order[:-1]]))
        leader = np.empty(len(order), dtype=np.int64)
        leader[order] = order[np.flatnonzero(fresh)[np.cumsum(fresh) - 1]]
        more = np.flatnonzero(leader != np.arange(len(order)))
        more_of = leader[more]
        alike = size[more] == size[more_of]
        alike[alike] = equal_strings(raw, start[more[alike]], start[more_of[alike]], size[more[alike]])
        leader[more[~alike]] = more[~alike]  # equal hashes of different strings
        gone = id_of > id_of[leader]
        out = []
        if gone.any():
            out.append((None, None, None, run_blob(doc[gone], at[gone], count[gone])))
        keep = np.flatnonzero(~gone)
        key = np.where(single, hashed, anchor).view(np.uint64)
        bucket = ((key >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)
        first = leader[keep]
        order = np.lexsort((keep != first, first, doc[first], bucket[keep]))
        keep, first = keep[order], first[order]
        here, begins = np.unique(bucket[keep], return_index=True)
        for b, x, y in zip(here.tolist(), begins.tolist(), np.append(begins[1:], len(keep)).tolist()):
            k, new = keep[x:y], keep[x:y] == first[x:y]
            text = raw[ranges(start[k[new]], size[k[new]])].tobytes()
            # Any bits of the anchor will do: different anchors with these bits in common are merged together.
            places = packed(new, anchor[k] & 0xFFFFFF, np.diff(doc[k], prepend=0), np.diff(id_of[k], prepend=0), at[k], count[k])
            out.append((b, pack.compress(text), places, None))
        types = {"bucket": pa.int32(), "strings": pa.binary(), "places": pa.binary(), "runs": pa.binary()}
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types.values())], names=list(types))


def slot_segments(docs: pa.Table, shared: pa.Table, length: int, gram: int, buckets: int, sig_bytes: int, id_bytes: int, anchor_buckets: int) -> pa.Table:
    """What ``send_segments`` sends from the documents of a slot, which has a row of shared anchors per bucket."""
    schema = pa.schema({"bucket": pa.int32(), "strings": pa.binary(), "places": pa.binary(), "runs": pa.binary(), "slot": pa.int64()})
    if not len(docs) or not len(shared):
        return schema.empty_table()
    short = np.asarray(docs.column("key")).view(np.uint64) >> np.uint64(8 * (8 - id_bytes))
    parts = [unpacked(x, 2) for x in shared.column("docs").to_pylist()]
    who = np.concatenate([np.repeat(np.cumsum(p[0]), p[1]) for p in parts])
    anchors = np.frombuffer(b"".join(shared.column("anchors").to_pylist()), dtype=np.uint8).reshape(-1, sig_bytes)
    order = np.argsort(who, kind="stable")
    who, anchors = who[order], anchors[order].tobytes()
    bounds = (np.searchsorted(who, short.astype(np.int64), side) * sig_bytes for side in ("left", "right"))
    mine = [[anchors[x:y]] for x, y in zip(*(b.tolist() for b in bounds))]
    hot = [[b"".join(shared.column("hot").to_pylist())]] + [[]] * (len(docs) - 1)
    batch = pa.RecordBatch.from_pydict({
        "doc_id": docs.column("doc_id").combine_chunks(), "text": docs.column("text").combine_chunks(),
        "anchors": pa.array(mine, pa.list_(pa.binary())), "hot": pa.array(hot, pa.list_(pa.binary())),
    })
    slot = docs.column("slot")[0].as_py()
    out = [x.append_column("slot", pa.array([slot] * len(x), pa.int64())) for x in send_segments(iter([batch]), length, gram, buckets, sig_bytes, anchor_buckets)]
    del batch, mine, hot, who, anchors, parts
    give_back()
    return pa.Table.from_batches(out, schema)


def removed_runs(table: pa.Table, length: int) -> pa.Table:
    """Runs of windows that are removed, packed by slot, from the segments of one bucket, and those of it that were known before."""
    import zstandard

    unpack = zstandard.ZstdDecompressor()
    known = table.filter(pc.is_null(table.column("strings"))).select(["slot", "runs"])
    table = table.filter(pc.is_valid(table.column("strings")))
    if not len(table):
        return known
    name_of: dict[bytes, int] = {}
    parts = []
    for slot, text, places in zip(table.column("slot"), table.column("strings"), table.column("places")):
        text = unpack.decompress(text.as_py())
        new, anchor, doc, id_, at, count = unpacked(places.as_py(), 6)
        sizes = count[new == 1] + length - 1
        ends = np.cumsum(sizes)
        names = [name_of.setdefault(text[a:z], len(name_of)) for a, z in zip((ends - sizes).tolist(), ends.tolist())]
        parts.append((np.array(names)[np.cumsum(new) - 1], anchor, np.cumsum(id_), np.full(len(new), slot.as_py()), np.cumsum(doc), at, count))
    places = [np.concatenate(x) for x in zip(*parts)]
    del parts
    order = np.argsort(places[0], kind="stable")
    name, anchor, id_, slot, doc, at, count = (x[order] for x in places)
    del places, order
    first = np.flatnonzero(np.concatenate(([True], name[1:] != name[:-1])))
    bounds = np.append(first, len(name))
    least = np.minimum.reduceat(id_, first)  # per distinct string its smallest document
    anchor, windows_of = anchor[first], count[first]
    out = []

    def remove(names: np.ndarray, starts: np.ndarray, windows: np.ndarray, below: np.ndarray) -> None:
        """Runs of strings, for the documents above ``below``."""
        each = bounds[names + 1] - bounds[names]
        k, starts, windows, below = ranges(bounds[names], each), *(np.repeat(x, each) for x in (starts, windows, below))
        above = np.flatnonzero(id_[k] > below)
        k = k[above]
        out.append((slot[k], doc[k], at[k] + starts[above], windows[above]))

    # What is the only string under its anchor has no other windows to meet.
    _, code, strings_of = np.unique(anchor, return_inverse=True, return_counts=True)
    alone = strings_of[code] == 1
    single = np.flatnonzero(alone & (np.diff(bounds) > 1))
    remove(single, np.zeros(len(single), dtype=np.int64), windows_of[single], least[single])
    mixed = np.flatnonzero(~alone)
    if len(mixed):
        texts = list(name_of)
        shards, members = [], []
        for part in by_bytes(mixed.tolist(), lambda i: len(texts[i]), SHARD_BYTES):
            shards.append(Shard([texts[i] for i in part], length))
            members.append(np.array(part)[shards[-1].owner])
        del texts, name_of
        owner, place = np.concatenate(members), np.concatenate([x.place for x in shards])
        window, fresh = merge_shards(shards, length)
        del shards, members
        low = np.minimum.reduceat(least[owner[window]], np.flatnonzero(fresh))
        below = np.empty(len(window), dtype=np.int64)
        below[window] = low[np.cumsum(fresh) - 1]
        # A run: windows in a row of a string with the same smallest document.
        begin = np.flatnonzero(np.concatenate(([True], (owner[1:] != owner[:-1]) | (below[1:] != below[:-1]))))
        remove(owner[begin], place[begin], np.diff(np.append(begin, len(owner))), below[begin])
    to, doc, start, windows = (np.concatenate(x) for x in zip(*out))
    order = np.argsort(to, kind="stable")
    to, doc, start, windows = to[order], doc[order], start[order], windows[order]
    here, begins = np.unique(to, return_index=True)
    runs = [run_blob(doc[x:y], start[x:y], windows[x:y]) for x, y in zip(begins.tolist(), np.append(begins[1:], len(to)).tolist())]
    del out, to, doc, start, windows, order, name, anchor, id_, slot, at, count
    give_back()
    return pa.concat_tables([known, pa.table({"slot": pa.array(here, pa.int64()), "runs": pa.array(runs, pa.binary())})])


def cut_slot(docs: pa.Table, found: pa.Table, length: int) -> pa.Table:
    """The texts of a slot without removed bytes, with what was removed."""
    ids, texts = docs.column("doc_id").to_pylist(), docs.column("text").cast(pa.binary()).to_pylist()
    number = numbers(ids, texts, length)
    parts = [unpacked(x, 3) for x in found.column("runs").to_pylist()]
    # The bytes of the runs; what meets or overlaps is one.
    doc, start, size = (np.concatenate([np.empty(0, dtype=np.int64), *x]) for x in zip(*((np.cumsum(p[0]), p[1], p[2] + length - 1) for p in parts))) if parts else np.empty((3, 0), dtype=np.int64)
    doc, start, size = joined(doc, start, size)
    bounds = (np.searchsorted(doc, number, side).tolist() for side in ("left", "right"))
    stop = start + size
    out = []
    for doc_id, raw, x, y in zip(ids, texts, *bounds):
        a, z = start[x:y].tolist(), stop[x:y].tolist()
        kept = b"".join(raw[i:j] for i, j in zip([0, *z], [*a, len(raw)]))
        out.append((doc_id, len(raw), len(raw) - len(kept), len(a), kept))
    names = {"doc_id": pa.int64(), "n_bytes": pa.int64(), "n_removed": pa.int64(), "n_spans": pa.int64(), "kept": pa.binary()}
    table = pa.table({n: pa.array(c, t) for (n, t), c in zip(names.items(), zip(*out) if out else [()] * 5)})
    del texts, out, parts
    give_back()
    return table


def digest_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sha = pa.array([hashlib.sha256(k).hexdigest() for k in batch.column("kept").to_pylist()], pa.string())
        yield pa.RecordBatch.from_arrays([*batch.columns[:4], sha], names=[*batch.schema.names[:4], "kept_sha256"])


def remove_repeats(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """One row per document: ``doc_id, n_bytes, n_removed, n_spans`` and ``kept`` (the remaining bytes)."""
    slim = docs.select(F.col(doc_id).cast("long").alias("doc_id"), text_of(text).alias("text")).withColumn("key", F.xxhash64("doc_id", "text"))
    is_named = F.col("doc_id").isNotNull() & (F.octet_length("text") >= length)
    size = one_row(slim.where(is_named).agg(F.count(F.lit(1)).alias("n"), F.sum(F.octet_length("text").cast("long")).alias("bytes")))
    n_docs, n_bytes = max(2, size["n"]), size["bytes"] or 0
    n_anchors = max(2, 2 * n_bytes // (length - gram + 2))
    buckets, slots, hot_docs = max(1, math.ceil(n_anchors / BUCKET_ANCHORS)), max(1, math.ceil(n_bytes / SLOT)), HOT_DOCS
    # Enough bits that chance meetings are few: they are looked at and change nothing.
    sig_bytes = min(5, max(4, math.ceil((math.log2(n_anchors) + 6 - math.log2(buckets)) / 8)))
    id_bytes = min(7, max(4, math.ceil((math.log2(n_docs) + 8) / 8)))
    slim = slim.withColumn("slot", F.shiftright(F.shiftrightunsigned("key", 32) * slots, 32))
    named = slim.where(is_named)
    sent = named.select("key", "text").mapInArrow(
        lambda it: tidy(send_anchors(it, length, gram, buckets, sig_bytes, id_bytes)), "bucket int, new binary, told binary"
    )
    shared = cut_lineage(
        sent.groupBy("bucket").applyInArrow(
            lambda t: to_slots(shared_anchors(t, sig_bytes, id_bytes, hot_docs), slots, id_bytes),
            "slot long, docs binary, anchors binary, hot binary, n long, n_hot long",
        )
    )
    # A segment has its anchor's windows around it, some 1.5 times a window.
    n, n_hot = (v or 0 for v in one_row(shared.agg(F.sum("n"), F.sum("n_hot"))))
    rows = n * (length + (length - gram) // 2) + n_hot * length * ((length - gram) // 2)
    parts = max(1, math.ceil(rows / BUCKET_BYTES))
    segments = named.groupBy("slot").cogroup(shared.groupBy("slot")).applyInArrow(
        lambda t, s: slot_segments(t, s, length, gram, parts, sig_bytes, id_bytes, buckets),
        "bucket int, strings binary, places binary, runs binary, slot long",
    )
    # The segments are shuffled once and stored nowhere; what is kept is the runs, numbers only.
    home = F.coalesce("bucket", F.pmod("slot", F.lit(parts)).cast("int"))  # known runs ride along with any bucket
    runs = cut_lineage(
        segments.withColumn("home", home).groupBy("home").applyInArrow(lambda t: removed_runs(t, length), "slot long, runs binary")
    )
    return slim.groupBy("slot").cogroup(runs.groupBy("slot")).applyInArrow(
        lambda t, r: cut_slot(t, r, length), "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary"
    )


def digests(removed: DataFrame) -> DataFrame:
    """The result of ``remove_repeats`` with a checksum in place of the bytes."""
    return removed.mapInArrow(digest_batches, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")
