"""Conflict-constrained best-fit packing of documents into fixed-size sequences.

The table is dealt out to shards of bounded size.  In a shard, pieces are placed
from long to short: bins are kept by their residual, a bit per residual marks
where bins are, and the successor search walks up from the piece's length until
a bin is found that has no conflict.  Each bin carries a bitmap of duplicate
clusters (no two members of a cluster share a bin) and bitmaps of sources (no
more than ``per_source`` documents of a source in a bin).

Documents longer than a bin are cut: whole bins first, the rest is packed.

Cases: a document without words (or with a null text) gets one row with no bin;
null ids, sources and repeated rows are packed like others, and equal rows are
spread over the shards; an empty table gives an empty result; further columns
are ignored.
"""

from __future__ import annotations

import math
from collections import Counter, defaultdict

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tribuna.llm.common import n_words, one_row, text_of
from tribuna.session import cut_lineage

CAPACITY = 2048
PER_SOURCE = 2
#: A shard holds about this many bins' worth of words, and rows.
SHARD_BINS = 2048
SHARD_ROWS = 16_384
#: Equal rows are counted and dealt out again in lists of this length.
LIST = 1000

PLACED = "doc_id long, piece int, start_word long, n_words long, bin_id long, bin_start int, bin_pieces int, bin_used int"


def best_fit(pieces: list[tuple[int, int, int]], capacity: int, per_source: int) -> list[int]:
    """The bin of each piece ``(length, source bit, cluster bit)``; a negative cluster never conflicts."""
    at: dict[int, list[int]] = defaultdict(list)
    there = 0  # bit r: some bin has residual r
    sources: list[list[int]] = []
    clusters: list[int] = []
    out = []
    for length, source, cluster in pieces:
        s = 1 << source
        c = 1 << cluster if cluster >= 0 else 0
        found, residual = -1, length
        above = there >> length
        while above:
            residual += (above & -above).bit_length() - 1
            for i, b in enumerate(bins := at[residual]):
                if not clusters[b] & c and not sources[b][-1] & s:
                    found = b
                    bins[i] = bins[-1]
                    bins.pop()
                    break
            if found >= 0:
                break
            residual += 1
            above = there >> residual
        if found < 0:
            found, residual = len(clusters), capacity
            clusters.append(0)
            sources.append([0] * per_source)
        elif not at[residual]:
            there &= ~(1 << residual)
        clusters[found] |= c
        levels = sources[found]
        for k in range(per_source):  # the first level that has not seen the source
            if not levels[k] & s:
                levels[k] |= s
                break
        at[residual - length].append(found)
        there |= 1 << (residual - length)
        out.append(found)
    return out


def pack_shard(df: pd.DataFrame, capacity: int, per_source: int) -> pd.DataFrame:
    """Packs one shard; ``df`` has id, no_id (the id was null), source, cluster, size and shard."""
    df = df.sort_values(["size", "cluster", "no_id", "id", "source"], ascending=[False, True, True, True, True], kind="stable")
    ids, sizes, clusters = [None if no else i for i, no in zip(df["id"], df["no_id"])], df["size"].tolist(), df["cluster"].tolist()
    sources = df["source"].fillna("\x00null").tolist()
    rest = [n % capacity for n in sizes]
    often = Counter(c for c, r in zip(clusters, rest) if r)
    source_bit: dict = {}
    cluster_bit: dict = {}
    todo = sorted((i for i, r in enumerate(rest) if r), key=lambda i: -rest[i])
    pieces = []
    for i in todo:
        s = source_bit.setdefault(sources[i], len(source_bit))
        c = cluster_bit.setdefault(clusters[i], len(cluster_bit)) if often[clusters[i]] > 1 else -1
        pieces.append((rest[i], s, c))
    bins = best_fit(pieces, capacity, per_source)
    used, count = Counter(), Counter()
    rows = []
    base = int(df["shard"].iloc[0]) << 32
    for i, b in zip(todo, bins):
        full = sizes[i] // capacity
        rows.append([ids[i], full, full * capacity, rest[i], base + b, used[b], b])
        used[b] += rest[i]
        count[b] += 1
    rows = [[*r[:6], count[r[6]], used[r[6]]] for r in rows]
    fresh = base + (max(bins) + 1 if bins else 0)
    for i, n in enumerate(sizes):
        for k in range(n // capacity):
            rows.append([ids[i], k, k * capacity, capacity, fresh, 0, 1, capacity])
            fresh += 1
    out = pd.DataFrame(rows, columns=[c.split()[0] for c in PLACED.split(", ")])
    return out.astype({"doc_id": "Int64", "start_word": "int64", "n_words": "int64", "bin_id": "int64"})


def pack(
    docs: DataFrame, capacity: int = CAPACITY, per_source: int = PER_SOURCE, cluster: str | None = None,
    text: str = "text", source: str = "source", doc_id: str = "doc_id",
) -> DataFrame:
    """One row per placed piece: the words of the document it holds, its bin and its place there.

    ``cluster`` names a long column of duplicate clusters; by default documents
    of equal text are a cluster.
    """
    group = F.col(cluster) if cluster else F.xxhash64(text)
    rows = cut_lineage(
        docs.select(
            F.col(doc_id).cast("long").alias("id"), F.col(source).alias("source"), group.alias("cluster"), n_words(text_of(text)).alias("size")
        )
        .groupBy("id", "source", "cluster", "size")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    total = one_row(rows.agg(F.sum("n").alias("n"), F.sum(F.col("n") * F.col("size")).alias("words")))
    shards = max(1, math.ceil((total["n"] or 0) / SHARD_ROWS), math.ceil((total["words"] or 0) / (SHARD_BINS * capacity)))
    lists = rows.withColumn("part", F.explode(F.sequence(F.lit(0), ((F.col("n") - 1) / LIST).cast("long"))))
    ends = F.least(F.col("n"), (F.col("part") + 1) * LIST) - 1
    each = lists.withColumn("copy", F.explode(F.sequence(F.col("part") * LIST, ends)))
    dealt = each.select(
        F.coalesce("id", F.lit(0)).alias("id"), F.col("id").isNull().alias("no_id"), "source", "cluster", "size",
        F.pmod(F.xxhash64("id", "source", "cluster", "size") % F.lit(2**40) + F.col("copy"), F.lit(shards)).cast("int").alias("shard"),
    )
    placed = dealt.where("size > 0").groupBy("shard").applyInPandas(lambda df: pack_shard(df, capacity, per_source), PLACED)
    empty = dealt.where("size = 0").select(
        F.when(~F.col("no_id"), F.col("id")).alias("doc_id"), F.lit(0).alias("piece"), F.lit(0).cast("long").alias("start_word"), F.lit(0).cast("long").alias("n_words"),
        F.lit(None).cast("long").alias("bin_id"), F.lit(None).cast("int").alias("bin_start"),
        F.lit(None).cast("int").alias("bin_pieces"), F.lit(None).cast("int").alias("bin_used"),
    )
    return placed.unionByName(empty)
