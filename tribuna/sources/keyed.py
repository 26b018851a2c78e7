"""Keyed tables without a table format: hash buckets, numbered writes and a log of commits.

A row lives in the bucket of its key's hash, so what concerns one key is in one
bucket, and the number of folders follows from writes and buckets, not from
keys.  A write goes to ``rows/seq=N/bucket=B`` and counts once ``commits/seq=N``
names it; a write that is repeated under its number replaces itself, a write
that died half-way is never read.  A commit either adds rows to a bucket
(``append``) or stands for all of it (``rewrite``, ``compact``): older files of
that bucket are then no longer listed, and the other buckets are untouched.

One writer at a time gives the numbers; a stream gives its batch ids.  The log
of commits has a row per write and touched bucket; the driver reads it reduced
to the files that count, once per table object, and keeps it up to date with
what the object writes.
"""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

BUCKETS = 16
#: Writes of a bucket that are live before ``compact`` folds them into one.
FULL = 8
COMMIT_DDL = "bucket int, base boolean, seq bigint"


class KeyedTable:
    def __init__(self, spark: SparkSession, path: str, schema: str | T.StructType, keys: list[str], buckets: int = BUCKETS):
        self.spark, self.path, self.keys, self.buckets = spark, path.rstrip("/"), keys, buckets
        if not isinstance(schema, str):  # as it is read back: nothing is declared non-null
            schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
        self.schema = T.StructType.fromDDL(schema)
        self._known: list[tuple[int, int, bool]] | None = None

    def bucket(self) -> Column:
        return F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)).cast("int")

    # -- what counts ----------------------------------------------------------

    def _commits(self) -> DataFrame | None:
        try:
            return self.spark.read.schema(COMMIT_DDL).option("basePath", f"{self.path}/commits").parquet(f"{self.path}/commits")
        except AnalysisException as err:
            if err.getCondition() == "PATH_NOT_FOUND":
                return None
            raise

    def _load(self, before: int | None = None) -> list[tuple[int, int, bool]]:
        """``(seq, bucket, base)`` of commits from each bucket's newest base on."""
        log = self._commits()
        if log is None:
            return []
        if before is not None:
            log = log.where(F.col("seq") < before)
        since = log.where("base").groupBy("bucket").agg(F.max("seq").alias("since"))
        rows = log.join(since, "bucket", "left").where(F.col("since").isNull() | (F.col("seq") >= F.col("since")))
        return [(r.seq, r.bucket, r.base) for r in rows.select("seq", "bucket", "base").collect()]

    def _log(self) -> list[tuple[int, int, bool]]:
        if self._known is None:
            self._known = self._load() or None
        return self._known or []

    def live(self, before: int | None = None) -> list[tuple[int, int]]:
        """``(seq, bucket)`` of all that counts: a bucket's newest base and what was added since.

        ``before`` asks for what counted ahead of a write, as its repetition must see it.
        """
        log = self._log()
        if before is not None and any(seq >= before for seq, _, _ in log):
            log = self._load(before)
        since: dict[int, int] = {}
        for seq, bucket, base in log:
            if base:
                since[bucket] = max(seq, since.get(bucket, -1))
        return sorted((seq, bucket) for seq, bucket, _ in log if seq >= since.get(bucket, -1))

    def next_seq(self) -> int:
        return 1 + max((seq for seq, _, _ in self._log()), default=-1)

    # -- reading --------------------------------------------------------------

    def rows(self, buckets: list[int] | None = None, before: int | None = None, live: list[tuple[int, int]] | None = None) -> DataFrame:
        """Live rows with ``seq`` and ``bucket``; only files of the given buckets are listed and read."""
        pairs = self.live(before) if live is None else live
        paths = [f"{self.path}/rows/seq={s}/bucket={b}" for s, b in pairs if buckets is None or b in buckets]
        schema = T.StructType([*self.schema.fields, T.StructField("seq", T.LongType()), T.StructField("bucket", T.IntegerType())])
        if not paths:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).option("basePath", f"{self.path}/rows").parquet(*paths)

    def newest(self, buckets: list[int] | None = None, before: int | None = None) -> DataFrame:
        """The newest row of every key.  A bucket of one write has each key once and is passed through."""
        pairs = self.live(before)
        writes: dict[int, int] = {}
        for _, b in pairs:
            writes[b] = writes.get(b, 0) + 1
        once = [p for p in pairs if writes[p[1]] == 1]
        more = [p for p in pairs if writes[p[1]] > 1]
        w = Window.partitionBy(*self.keys).orderBy(F.col("seq").desc())
        folded = self.rows(buckets, live=more).withColumn("_rn", F.row_number().over(w)).where("_rn = 1")
        columns = [*self.schema.names]
        return self.rows(buckets, live=once).select(columns).unionByName(folded.select(columns))

    def touched(self, delta: DataFrame) -> list[int]:
        """Buckets of a delta: at most as many rows as there are buckets."""
        return sorted(r.b for r in delta.select(self.bucket().alias("b")).distinct().collect())

    # -- writing --------------------------------------------------------------

    def _write(self, df: DataFrame, seq: int, base: bool) -> None:
        folder = f"{self.path}/rows/seq={seq}"
        placed = df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in self.schema.fields]).withColumn("bucket", self.bucket())
        placed.hint("rebalance", F.col("bucket")).write.mode("overwrite").partitionBy("bucket").parquet(folder)
        # The buckets are in the names of the files just written.
        files = self.spark.read.schema(self.schema).parquet(folder).inputFiles()
        buckets = sorted({int(m.group(1)) for f in files if (m := re.search(r"/bucket=(\d+)/", f))})
        commit = self.spark.createDataFrame([(b, base) for b in buckets], "bucket int, base boolean")
        commit.coalesce(1).write.mode("overwrite").parquet(f"{self.path}/commits/seq={seq}")
        self._known = [c for c in self._log() if c[0] != seq] + [(seq, b, base) for b in buckets]

    def append(self, df: DataFrame, seq: int | None = None) -> int:
        """Adds rows, each key once; the newest write of a key counts."""
        seq = self.next_seq() if seq is None else seq
        self._write(df, seq, base=False)
        return seq

    def rewrite(self, df: DataFrame, seq: int | None = None) -> int:
        """``df`` is all that its buckets hold from now on; other buckets stay as they are."""
        seq = self.next_seq() if seq is None else seq
        self._write(df, seq, base=True)
        return seq

    def upsert(self, delta: DataFrame, merge: Callable[[DataFrame, DataFrame], DataFrame], seq: int | None = None) -> list[int]:
        """Copy on write: the buckets that the delta hits are merged and rewritten, no other file is read.

        ``merge(old, delta)`` returns the rows of those buckets and must keep their keys.
        """
        seq = self.next_seq() if seq is None else seq
        hit = self.touched(delta)
        if hit:
            self.rewrite(merge(self.newest(hit, before=seq), delta), seq)
        return hit

    def compact(self, fold: Callable[[DataFrame], DataFrame] | None = None, full: int = FULL, seq: int | None = None) -> list[int]:
        """Folds the buckets of ``full`` live writes or more into one base each; returns them.

        ``fold`` combines the rows of a key; by default the newest counts.
        """
        pairs = self.live(seq)
        writes: dict[int, int] = {}
        for _, b in pairs:
            writes[b] = writes.get(b, 0) + 1
        due = sorted(b for b, n in writes.items() if n >= full)
        if due:
            seq = self.next_seq() if seq is None else seq
            self.rewrite(fold(self.rows(due, live=pairs)) if fold else self.newest(due, before=seq), seq)
        return due
