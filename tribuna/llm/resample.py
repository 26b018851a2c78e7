"""Target-distribution importance resampling: documents drawn by how much like the target texts they read.

Words and word runs fall into hash buckets.  A bucket's gain is its log ratio of
target to corpus frequency, with one added to every count; a document's weight
is the floored mean of the gains of its features, looked up in an array.  A
Gumbel variate from the id's hash is added, so that the highest scores are a
draw without replacement by weight, the same at every run.

Counts are added up per task before they are shuffled; only one number a bucket
reaches the driver.  Scores are written once.  The key of the last row drawn is
then found without a sort: in each round every partition sends the medians of
its remaining keys, and their median, weighted by how many keys stand behind
each, becomes the pivot.  At least a quarter of the keys is on either side of
it, so each round discards a guaranteed fraction, whatever the distribution.
Only the rows drawn are sorted, to number them.

Cases: null texts, empty texts and texts without words have no features and the
weight 0; very long texts count whole; equal scores go to the smaller id, null
last; repeated rows count, are scored and may be drawn each; a null id is hashed
as the empty string; without target texts all gains come from the corpus alone;
an empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tribuna.operators.budget import with_ordinal
from tribuna.session import cut_lineage, work_path

BUCKETS = 10_000
LONGEST = 1
SEED = 2024
MIN_WORDS = 20
PERCENT = 10
#: Keys whose median is taken at once: a partition with more sends several medians.
GROUP_KEYS = 1 << 20
#: Remaining keys that are no longer halved but ordered.
REST_KEYS = 4096

#: Bytes of words, with A-Z made lower case; anything else is a space.  Bytes from 0x80 on are parts of letters beyond ASCII.
TABLE = bytes(b if b >= 0x80 or chr(b).isdigit() or chr(b).islower() else b + 32 if chr(b).isupper() else 32 for b in range(256))
KEY = ["below", "no_id", "doc_id", "row"]


def features(text: bytes, longest: int, buckets: int) -> tuple[int, np.ndarray]:
    """Number of words, and the bucket of every run of 1 to ``longest`` of them."""
    words = text.translate(TABLE).split()
    run = list(map(crc32, words))
    found = list(run)
    for n in range(2, longest + 1):
        run = [crc32(b" " + w, h) for w, h in zip(words[n - 1 :], run)]
        found += run
    return len(words), np.array(found, dtype=np.int64) % buckets


def texts_of(docs: DataFrame, text: str) -> DataFrame:
    return docs.select(F.coalesce(F.col(text), F.lit("")).cast("binary").alias("text"))


def count_buckets(docs: DataFrame, text: str = "text", longest: int = LONGEST, buckets: int = BUCKETS) -> np.ndarray:
    """Features of all texts by bucket."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = np.zeros(buckets, dtype=np.int64)
        for batch in batches:
            found = [features(t.as_py(), longest, buckets)[1] for t in batch.column("text")]
            n += np.bincount(np.concatenate(found) if found else [], minlength=buckets)
        some = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int32()), pa.array(n[some])], names=["bucket", "n"])

    out = np.zeros(buckets, dtype=np.int64)
    for r in texts_of(docs, text).mapInArrow(count, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        out[r.bucket] = r.n
    return out


def gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Thousandths of the natural log of each bucket's smoothed frequency ratio."""
    n, all_s, all_t = len(corpus), float(corpus.sum()), float(target.sum())
    ratios = [(t + 1.0) * (all_s + n) / ((s + 1.0) * (all_t + n)) for s, t in zip(corpus.tolist(), target.tolist())]
    return np.array([math.floor(1000 * math.log(r)) for r in ratios], dtype=np.int64)


def variate(doc_id: Column, seed: int) -> Column:
    """Gumbel variate of an id in thousandths."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(text, 256), 1, 8), 16, 10).cast("double")
    return F.floor(-1000.0 * F.log(-F.log((h + 0.5) / 4294967296.0))).cast("long")


def score(docs: DataFrame, gain: np.ndarray, seed: int = SEED, text: str = "text", doc_id: str = "doc_id", longest: int = LONGEST) -> DataFrame:
    """``doc_id, n_words, n_features, weight, score`` of every row."""
    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for t in batch.column("text"):
                n_words, at = features(t.as_py(), longest, len(gain))
                rows.append((n_words, len(at), int(gain[at].sum()) // len(at) if len(at) else 0))
            n_words, n_features, weight = (pa.array(c, pa.int64()) for c in zip(*rows)) if rows else [pa.array([], pa.int64())] * 3
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), n_words, n_features, weight], names=["doc_id", "n_words", "n_features", "weight"])

    slim = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).cast("binary").alias("text"))
    rows = slim.mapInArrow(weigh, "doc_id long, n_words long, n_features long, weight long")
    return rows.withColumn("score", F.col("weight") + variate(F.col("doc_id"), seed))


def _key(row: tuple) -> Column:
    types = ("long", "boolean", "long", "long")
    return F.struct(*[F.lit(v).cast(t).alias(c) for v, t, c in zip(row, types, KEY)])


def _upto(row: tuple) -> Column:
    """Whether a row's key is the given one or smaller."""
    return (F.col("below") <= row[0]) & (F.struct(*KEY) <= _key(row))


def medians(keys: DataFrame, pivot: tuple | None) -> list[tuple]:
    """``(side, size, key)`` for each group of at most ``GROUP_KEYS`` keys of a partition: its median key.

    Side 0 are the keys up to the pivot, side 1 those after it; without a pivot all are side 1.
    """
    def middle(below, no_id, doc_id, row):
        """The median by partial sorts: by the first part of the key, then among its equals by the others."""
        k = (len(below) - 1) // 2
        at = np.argpartition(below, k)[k]
        smaller, equal = int((below < below[at]).sum()), np.flatnonzero(below == below[at])
        order = np.lexsort((row[equal], doc_id[equal], no_id[equal]))
        return int(equal[order[k - smaller]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list] = {0: [], 1: []}
        size = {0: 0, 1: 0}

        def flush(side: int) -> pa.RecordBatch:
            cols = [np.concatenate(c) for c in zip(*held[side])]
            m = middle(*cols)
            out = [pa.array([side], pa.int32()), pa.array([len(cols[0])], pa.int64()), *(pa.array([c[m]]) for c in cols)]
            held[side], size[side] = [], 0
            return pa.RecordBatch.from_arrays(out, names=["side", "n", *KEY])

        for batch in batches:
            cols = [batch.column(c).to_numpy(zero_copy_only=False) for c in KEY]
            after = batch.column("after").to_numpy(zero_copy_only=False)
            for side, rows in ((0, ~after), (1, after)):
                if rows.any():
                    held[side].append([c[rows] for c in cols])
                    size[side] += int(rows.sum())
                    if size[side] >= GROUP_KEYS:
                        yield flush(side)
        for side in (0, 1):
            if size[side]:
                yield flush(side)

    after = F.lit(True) if pivot is None else F.struct(*KEY) > _key(pivot)
    out = keys.select(F.col("below"), F.col("no_id"), F.coalesce("doc_id", F.lit(0)).alias("doc_id"), "row", after.alias("after"))
    schema = "side int, n long, below long, no_id boolean, doc_id long, row long"
    return [(r.side, r.n, (r.below, r.no_id, None if r.no_id else r.doc_id, r.row)) for r in out.mapInArrow(run, schema).collect()]


def weighted_median(found: list[tuple]) -> tuple:
    """The key that half of the keys behind the medians are not after."""
    order = sorted(found, key=lambda f: (f[2][0], f[2][1], f[2][2] or 0, f[2][3]))
    half, seen = sum(n for _, n, _ in order) / 2, 0
    for _, n, key in order:
        seen += n
        if seen >= half:
            return key
    raise ValueError("no keys")


def cutoff(keys: DataFrame, m: int) -> tuple | None:
    """The ``m``-th smallest key (from 1) of rows with the columns ``KEY``, which tell all rows apart; None beyond the last.

    Keys that are left are written anew whenever an eighth of those written
    last remains, so all rounds together read little more than the first ones.
    """
    if m < 1:
        return None
    found = medians(keys, None)
    left = written = sum(n for _, n, _ in found)
    if m > left:
        return None
    while left > REST_KEYS:
        pivot = weighted_median(found)
        found = medians(keys, pivot)
        upto = sum(n for side, n, _ in found if side == 0)
        if m == upto:
            return pivot
        side = 0 if m < upto else 1
        left, m = (upto, m) if side == 0 else (left - upto, m - upto)
        found = [f for f in found if f[0] == side]
        keys = keys.where(_upto(pivot) if side == 0 else ~_upto(pivot))
        if 8 * left <= written:
            keys, written = cut_lineage(keys.hint("rebalance")), left
    r = keys.orderBy(*KEY).limit(m).agg(F.max(F.struct(*KEY)).alias("k")).first().k
    return tuple(r)


def resample(docs: DataFrame, target: DataFrame, percent: int = PERCENT, min_words: int = MIN_WORDS, longest: int = LONGEST,
             buckets: int = BUCKETS, seed: int = SEED, text: str = "text", doc_id: str = "doc_id", target_text: str = "text") -> DataFrame:
    """Every document's ``doc_id, n_words, n_features, weight, score`` and ``rank`` (from 1; null where it is not drawn).

    ``percent`` of the documents of at least ``min_words`` words are drawn.
    """
    spark = docs.sparkSession
    gain = gains(count_buckets(docs, text, longest, buckets), count_buckets(target, target_text, longest, buckets))
    path = work_path(spark, "scores")
    scored = score(docs, gain, seed, text, doc_id, longest)
    scored.withColumns({"below": -F.col("score"), "no_id": F.col("doc_id").isNull(), "row": F.monotonically_increasing_id()}).write.parquet(path)
    rows = spark.read.parquet(path)
    able = F.col("n_words") >= min_words
    drawn = percent * rows.where(able).count() // 100
    last = cutoff(rows.where(able).select(*KEY), drawn)
    columns = ["doc_id", "n_words", "n_features", "weight", "score"]
    if last is None:
        return rows.select(*columns, F.lit(None).cast("long").alias("rank"))
    within = able & _upto(last)
    winners = with_ordinal(rows.where(within), KEY, "rank").select(*columns, (F.col("rank") + 1).cast("long").alias("rank"))
    return winners.unionByName(rows.where(~within).select(*columns, F.lit(None).cast("long").alias("rank")))
