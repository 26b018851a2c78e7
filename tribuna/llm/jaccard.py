"""N-gram Jaccard join by PartEnum signatures, and the near-duplicate classes it links.

Sets are cut into bands of sizes such that partners lie in one band or in two
neighbouring ones.  In the band numbered j, with largest size r, two sets of
similarity t or more differ in k = 2r(1-t)/(1+t) shingles at most.  The shingle
domain is dealt out to partitions.  For small k all subsets of 2k+2 partitions
that leave out k of them are signatures; for larger k each of k+1+spare
partitions is one.  Sets that are similar enough agree on a signature; every set
has signatures for its own band and the next.

Common shingles, found on a bounded sample, are left out of the signatures of
larger bands (this takes differences away and adds none, whatever the sample
says).  A set whose partitions with content outnumber its possible differences
sends no empty ones; towards larger partners it sends one more than the possible
differences.  In each case one of two similar sets' shared signatures is sent by
both, so no link is lost, and unrelated sets do not meet in what everyone has.

A task that sees many sets under one signature sends only one of them on, tied
to the others, so no signature gathers an unbounded group.  Signatures with the
same sets are one group.  Sets under one signature are first compared with one of
them; what is not joined by that is compared in full: small groups pair by pair,
large ones in tiles of bounded rows, leaving out pairs that are connected already.

Every comparison is made twice.  A sketch of a set has a bit for each of about as
many bins as the set has shingles: whether an odd number of them lies there.  Two
sketches differ in no more bits than the sets differ in shingles, so a pair whose
sketches differ too much has no link.  Only sets of the pairs that are left are
read, and these are compared exactly.

Cases: texts that are null or have no word have empty sets and link with
nothing; rows with equal sets are one class; rows of equal id count as linked;
a row without id links with nothing and is its own component (null); an empty
table gives an empty result; further columns are carried by
``one_of_each`` only.  Sets are known by 128-bit hashes, shingles by 64-bit ones.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tribuna.llm.common import give_back, one_row, text_of, tidy
from tribuna.llm.graph import components
from tribuna.llm.shingles import mix, set_key, shingle_sets
from tribuna.llm.tokens import slices
from tribuna.session import cut_lineage

PERCENT = 80
#: Up to this many differences, subsets of few partitions are enumerated.
SMALL_K = 3
#: The sample that common shingles are looked for in: documents, and how many must share one; the list's length.
SAMPLE_DOCS, SAMPLE_SHARE, MAX_COMMON = 4096, 6, 100_000
#: Signatures per bucket, rows per tile side, largest group that is compared pair by pair, bytes of text per slice.
BUCKET_SIGNATURES = 1_000_000
TILE = 1024
SMALL_GROUP = 16
SLICE = 4 << 20


def band_tops(percent: int = PERCENT) -> np.ndarray:
    """The largest size of each band; the next begins one above."""
    tops, low = [], 1
    while low < 1 << 40:
        tops.append(low * 100 // percent)
        low = tops[-1] + 1
    return np.array(tops, dtype=np.int64)


def differences(top: int, percent: int = PERCENT) -> int:
    return 2 * top * (100 - percent) // (100 + percent)


def spare(k: int) -> int:
    return 2 + k // 24


def set_signatures(s: np.ndarray, band: int, top: int, common: np.ndarray, percent: int, smaller: bool) -> np.ndarray:
    """Signatures of one set for one band; ``smaller``: the set is of the band below, and its partners here are larger."""
    salt = np.uint64((band * 0x9E3779B97F4A7C15 + 1) % (1 << 64))
    k = differences(top, percent)
    if k == 0:
        return np.empty(0, dtype=np.uint64)  # only equal sets are linked, and these are one class
    if k <= SMALL_K:
        n = 2 * k + 2
        sums = np.zeros(n, dtype=np.uint64)
        np.add.at(sums, ((s >> np.uint64(32)) % np.uint64(n)).astype(np.int64), mix(s ^ salt))
        keep = np.array(list(itertools.combinations(range(n), n - k)))
        return mix(sums[keep].sum(axis=1, dtype=np.uint64) + np.arange(len(keep), dtype=np.uint64) * salt)
    # The differences that this very set can have from a partner in this band.
    own = (len(s) + min(top, len(s) * 100 // percent)) * (100 - percent) // (100 + percent)
    n = k + 1 + spare(k)
    if common.size:
        at = np.searchsorted(common, s)
        at[at == common.size] = 0
        s = s[common[at] != s]
    place = ((s >> np.uint64(20)) % np.uint64(n)).astype(np.int64)
    sums = np.zeros(n, dtype=np.uint64)
    np.add.at(sums, place, mix(s ^ salt))
    chosen = np.flatnonzero(np.bincount(place, minlength=n))
    if len(chosen) <= own:
        chosen = np.arange(n)  # too few partitions hold something: empty ones count as well
    elif smaller:
        chosen = chosen[: own + 1]  # one of these agrees with any partner, which sends all of its own
    return mix(sums[chosen] + mix(chosen.astype(np.uint64) + salt))


def signatures(s: np.ndarray, tops: np.ndarray, common: np.ndarray, percent: int) -> np.ndarray:
    band = int(np.searchsorted(tops, len(s)))
    parts = [set_signatures(s, b, int(tops[b]), common, percent, b > band) for b in (band, band + 1)]
    return np.concatenate(parts)


def sketch(s: np.ndarray) -> bytes:
    """A bit per bin: whether the number of the set's shingles in it is odd; bins are a power of two, as many as shingles or up to twice that."""
    if not s.size:
        return b""
    n = 1 << max(6, (len(s) - 1).bit_length())
    odd = np.bincount((s & np.uint64(n - 1)).astype(np.int64), minlength=n) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").tobytes()


def folded(words: np.ndarray, width: int) -> np.ndarray:
    """The sketch, as 64-bit words, over fewer bins."""
    while len(words) > width:
        words = words[: len(words) // 2] ^ words[len(words) // 2 :]
    return words


def least_differences(a: bytes, b: bytes) -> int:
    """What two sets differ in at least, by their sketches."""
    x, y, n, m = int.from_bytes(a, "little"), int.from_bytes(b, "little"), 8 * len(a), 8 * len(b)
    while n > m:
        n >>= 1
        x = (x >> n) ^ (x & ((1 << n) - 1))
    while m > n:
        m >>= 1
        y = (y >> m) ^ (y & ((1 << m) - 1))
    return (x ^ y).bit_count()


def may_link(both, differ, percent: int):
    """Whether sets of ``both`` shingles together can be similar enough if they differ in at least ``differ``."""
    return (100 + percent) * (both - differ) >= 2 * percent * both


def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Number of shingles, key and sketch of the set of each document."""
    for batch in batches:
        for rows in slices(batch, "text", SLICE):
            sets = shingle_sets(rows.column("text"))
            yield pa.RecordBatch.from_arrays(
                [
                    rows.column("doc_id"),
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array([set_key(s) for s in sets], pa.binary()),
                    pa.array([sketch(s) for s in sets], pa.binary()),
                ],
                names=["doc_id", "n", "cls", "sketch"],
            )


def list_shingles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for rows in slices(batch, "text", SLICE):
            for s in shingle_sets(rows.column("text")):
                yield pa.RecordBatch.from_arrays([pa.array(s.view(np.int64))], names=["s"])


def common_shingles(docs: DataFrame, n_docs: int) -> np.ndarray:
    """Sorted hashes of shingles that many documents of a bounded sample share; at most ``MAX_COMMON``."""
    if not n_docs:
        return np.empty(0, dtype=np.uint64)
    part = max(1, round(n_docs / SAMPLE_DOCS))
    sample = docs.where(F.pmod(F.xxhash64(F.lit("sample"), "doc_id"), F.lit(part)) == 0).select("text").limit(4 * SAMPLE_DOCS)
    counts = sample.mapInArrow(list_shingles, "s long").groupBy("s").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= SAMPLE_SHARE)
    rows = counts.orderBy(F.col("n").desc(), "s").limit(MAX_COMMON).collect()
    return np.sort(np.array([r.s for r in rows], dtype=np.int64).view(np.uint64))


def top_bytes(x: np.ndarray, n: int) -> np.ndarray:
    """The upper ``n`` bytes of 64-bit integers, as rows of bytes."""
    return np.ascontiguousarray(x.astype(">u8").view(np.uint8).reshape(-1, 8)[:, :n])


def from_bytes(rows: np.ndarray) -> np.ndarray:
    out = np.zeros((len(rows), 8), dtype=np.uint8)
    out[:, 8 - rows.shape[1] :] = rows
    return out.view(">u8").ravel().astype(np.int64)


def short_id(key: bytes, n: int) -> int:
    return int.from_bytes(key[:n], "big")


def send_signatures(
    batches: Iterator[pa.RecordBatch], common: np.ndarray, buckets: int, sig_bytes: int, id_bytes: int, percent: int
) -> Iterator[pa.RecordBatch]:
    """Per bucket the signatures and set ids of a slice, packed; sets tied here already go along as pairs of ids."""
    tops = band_tops(percent)
    for batch in batches:
        for rows in slices(batch, "text", 4 * SLICE):
            sigs, ids, seen = [], [], set()
            for part in slices(rows, "text", SLICE):
                for s in shingle_sets(part.column("text")):
                    if not s.size:
                        continue
                    key = set_key(s)
                    if key in seen:
                        continue
                    seen.add(key)
                    own = signatures(s, tops, common, percent)
                    sigs.append(own)
                    ids.append(np.full(len(own), short_id(key, id_bytes), dtype=np.int64))
            if not sigs:
                continue
            sig, who = np.concatenate(sigs), np.concatenate(ids)
            order = np.lexsort((who, sig))
            sig, who = sig[order], who[order]
            first = np.concatenate(([True], sig[1:] != sig[:-1]))
            bucket = ((sig >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)
            # The smallest set under a signature speaks for the others of the slice.
            lead = who[np.maximum.accumulate(np.where(first, np.arange(len(sig)), 0))]
            tied = ~first & (lead != who)
            out_bucket, out_sig, out_tie = [], [], []
            here, begins = np.unique(bucket, return_index=True)  # the buckets that the slice has, not all there are
            low = top_bytes(sig << np.uint64(8 * (8 - sig_bytes)), sig_bytes)
            wide = top_bytes(who.astype(np.uint64) << np.uint64(8 * (8 - id_bytes)), id_bytes)
            wide_lead = top_bytes(lead.astype(np.uint64) << np.uint64(8 * (8 - id_bytes)), id_bytes)
            packed = np.concatenate((low, wide), axis=1)
            ties = np.concatenate((low, wide_lead, wide), axis=1)
            for b, x, y in zip(here.tolist(), begins.tolist(), np.append(begins[1:], len(bucket)).tolist()):
                out_bucket.append(b)
                out_sig.append(packed[x:y][first[x:y]].tobytes())
                out_tie.append(ties[x:y][tied[x:y]].tobytes())
            yield pa.RecordBatch.from_arrays(
                [pa.array(out_bucket, pa.int32()), pa.array(out_sig, pa.binary()), pa.array(out_tie, pa.binary())], names=["bucket", "sigs", "ties"]
            )


def meet(table: pa.Table, sig_bytes: int, id_bytes: int) -> pa.Table:
    """All signatures of one bucket: ``g`` (the group), ``lead`` and ``member`` wherever different sets share one."""
    raw = np.frombuffer(b"".join(table.column("sigs").to_pylist()), dtype=np.uint8).reshape(-1, sig_bytes + id_bytes)
    tied = np.frombuffer(b"".join(table.column("ties").to_pylist()), dtype=np.uint8).reshape(-1, sig_bytes + 2 * id_bytes)
    sig, who = from_bytes(raw[:, :sig_bytes]), from_bytes(raw[:, sig_bytes:])
    order = np.lexsort((who, sig))
    sig, who = sig[order], who[order]
    fresh = np.concatenate(([True], (sig[1:] != sig[:-1]) | (who[1:] != who[:-1]))) if len(sig) else np.empty(0, dtype=bool)
    sig, who = sig[fresh], who[fresh]
    first = np.concatenate(([True], sig[1:] != sig[:-1])) if len(sig) else np.empty(0, dtype=bool)
    lead = who[np.maximum.accumulate(np.where(first, np.arange(len(sig)), 0))] if len(sig) else who
    more = ~first
    g = np.concatenate((sig[more], from_bytes(tied[:, :sig_bytes])))
    a = np.concatenate((lead[more], from_bytes(tied[:, sig_bytes : sig_bytes + id_bytes])))
    b = np.concatenate((who[more], from_bytes(tied[:, sig_bytes + id_bytes :])))
    del raw, tied, sig, who, order, lead, more, first, fresh
    keep = np.unique(np.stack((g, a, b), axis=1), axis=0) if len(g) else np.empty((0, 3), dtype=np.int64)
    # Signatures shared by the same sets are one group, in all buckets: it is named by its pairs.
    fresh = np.concatenate(([True], keep[1:, 0] != keep[:-1, 0])) if len(keep) else np.empty(0, dtype=bool)
    begins = np.flatnonzero(fresh)
    pair = mix(mix(keep[:, 1].astype(np.uint64)) + keep[:, 2].astype(np.uint64))
    name = np.add.reduceat(pair, begins) if len(begins) else pair
    once = np.zeros(len(begins), dtype=bool)
    once[np.unique(name, return_index=True)[1]] = True
    of = np.cumsum(fresh) - 1
    keep, g = keep[once[of]], name[of][once[of]].view(np.int64)
    out = pa.table({"g": g, "lead": keep[:, 1], "member": keep[:, 2]})
    del g, a, b, pair, name, keep, of, fresh
    give_back()
    return out


def read_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for rows in slices(batch, "text", SLICE):
            sets = shingle_sets(rows.column("text"))
            own = [k for k, (s, want) in enumerate(zip(sets, rows.column("want").to_pylist())) if set_key(s) == want]
            yield pa.RecordBatch.from_arrays(
                [rows.column("doc_id").take(pa.array(own, pa.int64())), pa.array([sets[k].view(np.int64) for k in own], pa.list_(pa.int64()))], names=["id", "s"]
            )


def pair_candidates(batches: Iterator[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        x = batch.to_pydict()
        near = [may_link(n + m, least_differences(k, l), percent) for n, m, k, l in zip(x["na"], x["nb"], x["ka"], x["kb"])]
        yield batch.filter(pa.array(near, pa.bool_())).select(["a", "b"])


def possible(pairs: DataFrame, known: DataFrame, percent: int) -> DataFrame:
    """The pairs ``a, b`` that sizes and sketches leave possible."""
    ka = known.select(F.col("id").alias("a"), F.col("n").alias("na"), F.col("sketch").alias("ka"))
    kb = known.select(F.col("id").alias("b"), F.col("n").alias("nb"), F.col("sketch").alias("kb"))
    both = pairs.join(ka, "a").join(kb, "b").where(100 * F.least("na", "nb") >= percent * F.greatest("na", "nb"))
    return both.select("a", "b", "na", "nb", "ka", "kb").mapInArrow(lambda it: tidy(pair_candidates(it, percent)), "a long, b long")


def verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs ``a, b`` whose sets are similar enough."""
    left = pairs.join(sets.select(F.col("id").alias("a"), F.col("s").alias("sa")), "a")
    both = left.join(sets.select(F.col("id").alias("b"), F.col("s").alias("sb")), "b")
    same = F.size(F.array_intersect("sa", "sb"))
    return both.where(100 * same >= percent * (F.size("sa") + F.size("sb") - same)).select("a", "b")


TILE_KEY = ["cluster", "band", "i", "next", "j"]


def tile_candidates(table: pa.Table, percent: int) -> pa.Table:
    """The rows of a tile that have a possible partner on the other side."""
    side, roots, n = (table.column(c).to_numpy() for c in ("side", "root", "n"))
    raw = [np.frombuffer(x, dtype="<u8") for x in table.column("sketch").to_pylist()]
    width = min(len(x) for x in raw)
    words = np.stack([folded(x, width) for x in raw])
    i, nxt, j = (table.column(c)[0].as_py() for c in ("i", "next", "j"))
    a = np.flatnonzero(side == 0)
    b = a if nxt == 0 and i == j else np.flatnonzero(side == 1)
    keep = np.zeros(len(side), dtype=bool)
    step = max(1, (1 << 20) // (width * max(1, len(b))))
    for start in range(0, len(a) if len(b) else 0, step):
        rows = a[start : start + step]
        differ = np.bitwise_count(words[rows][:, None, :] ^ words[b][None, :, :]).sum(axis=2, dtype=np.int64)
        x, y = n[rows][:, None], n[b][None, :]
        near = may_link(x + y, differ, percent) & (100 * np.minimum(x, y) >= percent * np.maximum(x, y))
        near &= roots[rows][:, None] != roots[b][None, :]
        keep[rows] |= near.any(axis=1)
        keep[b] |= near.any(axis=0)
    return table.filter(pa.array(keep)).select([*TILE_KEY, "side", "id", "root"])


def tile_links(table: pa.Table, percent: int) -> pa.Table:
    """Links between members of a tile's two sides that connect what was not connected."""
    side = table.column("side").to_numpy()
    ids, roots = table.column("id").to_numpy(), table.column("root").to_numpy()
    sets = [np.asarray(v.values) for v in table.column("s").combine_chunks()]
    rows = np.flatnonzero(side == 0)
    columns = np.flatnonzero(side == 1)
    columns = columns if len(columns) else rows  # a tile on the diagonal has one side
    sizes = np.array([len(s) for s in sets])
    owner = np.repeat(np.arange(len(sets)), sizes)
    _, code, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    keep = count[code] > 1  # what one set alone has is in no intersection
    code, owner = (np.cumsum(count > 1) - 1)[code[keep]], owner[keep]
    width = int(code.max()) + 1 if len(code) else 0
    order = np.argsort(code, kind="stable")
    code, owner = code[order], owner[order]
    shared = np.zeros((len(rows), len(columns)), dtype=np.float32)
    at_row, at_column = np.full(len(sets), -1), np.full(len(sets), -1)
    at_row[rows], at_column[columns] = np.arange(len(rows)), np.arange(len(columns))
    for start in range(0, width, 2048):
        x, y = np.searchsorted(code, (start, start + 2048))
        c, o = code[x:y] - start, owner[x:y]
        left, right = np.zeros((len(rows), 2048), dtype=np.float32), np.zeros((len(columns), 2048), dtype=np.float32)
        left[at_row[o][at_row[o] >= 0], c[at_row[o] >= 0]] = 1
        right[at_column[o][at_column[o] >= 0], c[at_column[o] >= 0]] = 1
        shared += left @ right.T
    together = sizes[rows][:, None] + sizes[columns][None, :] - shared
    near = (100 * shared >= percent * together) & (roots[rows][:, None] != roots[columns][None, :])
    parent: dict[int, int] = {}

    def root(v: int) -> int:
        while parent.setdefault(v, v) != v:
            parent[v] = v = parent[parent[v]]
        return v

    out = []
    for i, j in np.argwhere(near).tolist():
        a, b = root(int(roots[rows[i]])), root(int(roots[columns[j]]))
        if a != b:
            parent[a] = b
            out.append((int(ids[rows[i]]), int(ids[columns[j]])))
    return pa.table({"a": pa.array([a for a, _ in out], pa.int64()), "b": pa.array([b for _, b in out], pa.int64())})


def rest_links(groups: DataFrame, roots: DataFrame, tested: DataFrame, known: DataFrame, read: Callable[[DataFrame], DataFrame], percent: int) -> DataFrame:
    """Links within groups that the comparison with one member has left in several pieces; ``read`` gives the sets of ids."""
    member = groups.select("g", F.col("lead").alias("id")).union(groups.select("g", F.col("member").alias("id"))).distinct()
    member = member.join(roots, F.col("id") == F.col("node"), "left").select("g", "id", F.coalesce("root", "id").alias("root"))
    size = member.groupBy("g").agg(F.count(F.lit(1)).alias("m"), F.min("root").alias("r0"), F.max("root").alias("r1")).where("r0 < r1")
    open_groups = cut_lineage(member.join(size.select("g", "m"), "g"))
    small = open_groups.where(F.col("m") <= SMALL_GROUP)
    left = small.select("g", F.col("id").alias("a"), F.col("root").alias("ra"))
    right = small.select("g", F.col("id").alias("b"), F.col("root").alias("rb"))
    pairs = left.join(right, "g").where("a < b and ra <> rb").select("a", "b").distinct().join(tested, ["a", "b"], "left_anti")
    pairs = cut_lineage(possible(pairs, known, percent))

    large = open_groups.where(F.col("m") > SMALL_GROUP).select("g", "id", "root")
    wanted, tiles = pairs.select(F.col("a").alias("id")).union(pairs.select("b")), None
    if not large.isEmpty():
        first = large.groupBy("g").agg(F.min("id").alias("first"))
        ties = large.join(first, "g").select(F.col("id").alias("a"), F.col("first").alias("b"))
        cluster = components(ties)
        cluster = cluster.select(F.col("node").alias("id"), F.col("root").alias("cluster"))
        held = large.select("id", F.col("root").alias("comp")).distinct().join(cluster, "id").join(known.select("id", "n", "sketch"), "id")
        tiles = cut_lineage(tiled(held, percent).groupBy(*TILE_KEY).applyInArrow(
            lambda t: tile_candidates(t, percent), "cluster long, band int, i int, next int, j int, side int, id long, root long"
        ))
        wanted = wanted.union(tiles.select("id"))
    if wanted.isEmpty():
        return pairs
    sets = read(wanted.distinct())
    links = verified(pairs, sets, percent)
    if tiles is None:
        return links
    found = tiles.join(sets, "id").groupBy(*TILE_KEY).applyInArrow(lambda t: tile_links(t, percent), "a long, b long")
    return links.union(found)


def tiled(held: DataFrame, percent: int) -> DataFrame:
    """Rows of tiles in which all pairs of a cluster meet once, if their sizes lie in one band or in neighbouring ones."""
    tops = ", ".join(f"{t}L" for t in band_tops(percent).tolist())
    held = cut_lineage(held.withColumn("band", F.expr(f"size(filter(array({tops}), t -> t < n))")))
    chunks = held.groupBy("cluster", "band").agg(F.ceil(F.count(F.lit(1)) / TILE).cast("int").alias("c"))
    # To each band its own number of chunks and those of the bands below and above.
    around = chunks.select("cluster", "c", F.explode(F.array(*map(F.lit, (-1, 0, 1)))).alias("to"), "band")
    around = around.select("cluster", (F.col("band") + F.col("to")).alias("band"), *[F.when(F.col("to") == -k, F.col("c")).alias(f"c{k + 1}") for k in (-1, 0, 1)])
    around = around.groupBy("cluster", "band").agg(*[F.coalesce(F.max(c), F.lit(0)).alias(c) for c in ("c0", "c1", "c2")])
    held = held.join(around, ["cluster", "band"]).withColumn("chunk", F.pmod(F.xxhash64("id"), "c1").cast("int"))

    def each(c: str, row: str) -> str:
        return f"transform(filter(sequence(0, greatest({c}, 1) - 1), o -> {c} > 0), o -> struct({row}))"

    # Within a band a chunk meets itself and every other chunk once, as the first side those after it; then those of the next band.
    own = each("c1", "band, least(chunk, o) AS i, 0 AS next, greatest(chunk, o) AS j, int(chunk > o) AS side")
    above = each("c2", "band, chunk AS i, 1 AS next, o AS j, 0 AS side")
    below = each("c0", "band - 1 AS band, o AS i, 1 AS next, chunk AS j, 1 AS side")
    held = held.withColumn("at", F.explode(F.expr(f"concat({own}, {above}, {below})")))
    return held.select("cluster", *[f"at.{c}" for c in (*TILE_KEY[1:], "side")], "id", F.col("comp").alias("root"), "n", "sketch")


def near_duplicates(docs: DataFrame, percent: int = PERCENT, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """One row per document: ``doc_id, n_shingles, component_id``."""
    slim = docs.select(F.col(doc_id).cast("long").alias("doc_id"), text_of(text).alias("text"))
    info = cut_lineage(slim.mapInArrow(lambda it: tidy(describe(it)), "doc_id long, n long, cls binary, sketch binary"))
    links, roots, classes = class_links(slim, info, percent)
    # An id on several rows ties their classes.
    shared = info.where("doc_id is not null and n > 0").select("doc_id", "cls").distinct()
    repeated = shared.groupBy("doc_id").agg(F.count(F.lit(1)).alias("k")).where("k > 1").select("doc_id")
    twice = shared.join(repeated, "doc_id").join(classes.select("cls", "rep"), "cls").select(F.col("doc_id").alias("a"), F.col("rep").alias("b"))
    if not twice.isEmpty():
        roots = components(links.union(twice))
    to_root = classes.join(roots, F.col("rep") == F.col("node"), "left").select("cls", F.coalesce("root", "rep").alias("root"))
    out = info.join(to_root, "cls", "left")
    component = F.when(F.col("doc_id").isNull(), F.lit(None)).when(F.col("n") == 0, F.col("doc_id")).otherwise(F.col("root"))
    return out.select("doc_id", F.col("n").alias("n_shingles"), component.cast("long").alias("component_id"))


def class_links(slim: DataFrame, info: DataFrame, percent: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Verified links ``a, b`` between representatives, enough to connect all that is linked, their components, and the classes of equal sets."""
    known = info.where("doc_id is not null and n > 0")
    classes = cut_lineage(known.groupBy("cls").agg(F.min("doc_id").alias("rep"), F.max("n").alias("n"), F.max("sketch").alias("sketch")))
    total = one_row(classes.agg(F.count(F.lit(1)).alias("classes"), F.sum("n").alias("shingles")))
    n_classes, n_sigs = total["classes"], max(1, int(0.55 * (total["shingles"] or 0)))
    buckets = max(1, math.ceil(n_sigs / BUCKET_SIGNATURES))
    # Enough bits that chance meetings are far fewer than sets: they cost a comparison and change nothing.
    sig_bytes = min(7, max(4, math.ceil((2 * math.log2(n_sigs) - math.log2(max(2, n_classes)) + 6 - math.log2(buckets)) / 8)))
    id_bytes = min(7, max(4, math.ceil((math.log2(max(2, n_classes)) + 10) / 8)))
    common = common_shingles(slim, one_row(info.agg(F.count(F.lit(1))))[0])
    sent = slim.where("doc_id is not null").select("text").mapInArrow(
        lambda it: tidy(send_signatures(it, common, buckets, sig_bytes, id_bytes, percent)), "bucket int, sigs binary, ties binary"
    )
    met = sent.groupBy("bucket").applyInArrow(lambda t: meet(t, sig_bytes, id_bytes), "g long, lead long, member long")
    met = cut_lineage(met.distinct())
    short = classes.select(F.conv(F.hex(F.substring("cls", 1, id_bytes)), 16, 10).cast("long").alias("short"), "rep", "n")
    groups = met.join(short.select(F.col("short").alias("lead"), F.col("rep").alias("a"), F.col("n").alias("na")), "lead").join(
        short.select(F.col("short").alias("member"), F.col("rep").alias("b"), F.col("n").alias("nb")), "member"
    )
    groups = cut_lineage(groups.where("a <> b").select("g", F.col("a").alias("lead"), F.col("b").alias("member"), "na", "nb"))
    ids = groups.select(F.col("lead").alias("id")).union(groups.select("member")).distinct()
    known = cut_lineage(ids.join(classes.select(F.col("rep").alias("id"), F.col("cls").alias("want"), "n", "sketch"), "id"))

    def read(ids: DataFrame) -> DataFrame:
        # A representative's id may stand on other rows too: only its own set counts, and of equal rows one.
        wanted = ids.join(known, "id").select(F.col("id").alias("doc_id"), "want")
        found = slim.join(wanted, "doc_id").withColumn("th", F.xxhash64("text")).dropDuplicates(["doc_id", "want", "th"])
        return cut_lineage(found.select("doc_id", "text", "want").mapInArrow(lambda it: tidy(read_sets(it)), "id long, s array<long>"))

    near = groups.where(100 * F.least("na", "nb") >= percent * F.greatest("na", "nb"))
    near = near.select(F.least("lead", "member").alias("a"), F.greatest("lead", "member").alias("b")).distinct()
    near = cut_lineage(possible(near, known, percent))
    sets = read(near.select(F.col("a").alias("id")).union(near.select("b")).distinct())
    # First every set is compared with the smallest leader, then with those that do not reach it yet.
    links, roots, tested = None, None, None
    for last in (False, True):
        todo = near if roots is None else apart(near, roots).join(tested, ["a", "b"], "left_anti")
        if not last:
            todo = todo.groupBy("b").agg(F.min("a").alias("a")).select("a", "b")
        todo = cut_lineage(todo)
        new = cut_lineage(verified(todo, sets, percent))
        tested = todo if tested is None else tested.union(todo)
        if roots is None or not new.isEmpty():
            links = new if links is None else links.union(new)
            roots = cut_lineage(components(links))
    rest = cut_lineage(rest_links(groups.select("g", "lead", "member"), roots, tested, known, read, percent))
    if not rest.isEmpty():
        links = links.union(rest)
        roots = components(links)
    return links, roots, classes


def apart(pairs: DataFrame, roots: DataFrame) -> DataFrame:
    """The pairs ``a, b`` that are not connected yet."""
    ra = roots.select(F.col("node").alias("a"), F.col("root").alias("ra"))
    rb = roots.select(F.col("node").alias("b"), F.col("root").alias("rb"))
    out = pairs.join(ra, "a", "left").join(rb, "b", "left")
    return out.where(F.coalesce("ra", "a") != F.coalesce("rb", "b")).select("a", "b")


def one_of_each(docs: DataFrame, percent: int = PERCENT, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """The documents without near duplicates: of each component the smallest id stays, with all its columns; of equal ids the row with the smallest text hash."""
    found = cut_lineage(near_duplicates(docs, percent, text, doc_id).select(F.col("doc_id").alias("__id"), "component_id"))
    gone = found.where("component_id <> __id").select("__id").distinct()
    left = docs.join(gone, docs[doc_id] == gone["__id"], "left_anti")
    repeated = found.where("__id is not null").groupBy("__id").agg(F.count(F.lit(1)).alias("k")).where("k > 1").select("__id")
    if repeated.isEmpty():
        return left
    single = left.join(repeated, left[doc_id] == repeated["__id"], "left_anti")
    place = F.row_number().over(Window.partitionBy(doc_id).orderBy(F.xxhash64(text), text))
    several = left.join(repeated, left[doc_id] == repeated["__id"], "left_semi").withColumn("__place", place).where("__place = 1")
    return single.union(several.select(*docs.columns))
