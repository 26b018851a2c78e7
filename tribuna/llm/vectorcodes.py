"""Vector code compression: product codes, with nearest entries found by an integer Walsh-Hadamard transform.

A vector is scaled to integers and cut into equal consecutive parts; a part is
coded by the nearest entry of its position's codebook.  Parts and entries are
padded with zeros to a power of two and transformed; the transform multiplies
squared distances by the padded length, so sums of squared differences of
coefficients are scaled distances.  Coefficients are taken in sequency order,
where the first ones tell most: a running sum is a lower bound, and an entry
whose sum is above the distance of an entry already known is dropped.  All of it
is in 64-bit integers, hence exact; ties go to the lower index.

Codebooks start from the first rows and follow ``rounds`` of assignment and
floored means.  A task adds up its parts per entry before anything is sent, so a
round shuffles ``parts * entries`` rows a task, whatever the data; only sums and
codebooks, bounded by the parameters, reach the driver.

Cases: rows whose vector is null or holds null, NaN or infinite components are
dropped.  The codebooks' vector length is that of the first usable row, by
``vec_id`` (null last), then by vector, whose length is a multiple of ``parts``;
rows of another length, and rows with a component beyond 2**26 after scaling,
stay with null as code and error.  Repeated rows and ids are rows of their own,
also among those that start the codebooks; with fewer rows than ``entries`` the
codebooks are shorter; an empty table gives an empty result.  Further columns
ride along in one struct, so their names clash with nothing.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tribuna.session import work_path

SCALE = 256
PARTS = 16
ENTRIES = 64
ROUNDS = 2
#: Largest component after scaling for which no sum can leave 64 bits.
LARGEST = 1 << 26
#: Vectors that are compared at once.
SLICE_ROWS = 2048


def sequency(n: int) -> np.ndarray:
    """Rows of the Hadamard matrix of ``n`` (a power of two) by number of sign changes."""
    h = np.ones((1, 1), dtype=np.int8)
    while len(h) < n:
        h = np.block([[h, h], [h, -h]])
    return np.argsort((h[:, 1:] != h[:, :-1]).sum(1), kind="stable")


def walsh(x: np.ndarray) -> np.ndarray:
    """Walsh-Hadamard transform of the last axis, padded to a power of two, in sequency order."""
    n = 1 << max(x.shape[-1] - 1, 0).bit_length()
    y = np.zeros((*x.shape[:-1], n), dtype=np.int64)
    y[..., : x.shape[-1]] = x
    step = 1
    while step < n:
        pair = y.reshape(*x.shape[:-1], n // (2 * step), 2, step)
        a, b = pair[..., 0, :], pair[..., 1, :]
        y = np.stack([a + b, a - b], axis=-2).reshape(*x.shape[:-1], n)
        step *= 2
    return y[..., sequency(n)]


def nearest(x: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index of the nearest transformed entry of each transformed part, and the scaled distance.

    After 1, 2, 4, … coefficients the best entry so far is measured in full; its
    distance bounds the rest.
    """
    rows = np.arange(len(x))
    sums = (x[:, :1] - entries[None, :, 0]) ** 2
    best = sums.argmin(1)
    bound = ((x - entries[best]) ** 2).sum(1)
    r, e = np.nonzero(sums <= bound[:, None])
    held = sums[r, e]
    n = x.shape[1]
    for s in range(1, n):
        held = held + (x[r, s] - entries[e, s]) ** 2
        if s + 1 < n and s & (s + 1) == 0:
            starts = np.searchsorted(r, rows)
            low = np.minimum.reduceat(held, starts)
            first = np.flatnonzero(held == low[r])
            at = e[first[np.searchsorted(r[first], rows)]]
            bound = np.minimum(bound, ((x - entries[at]) ** 2).sum(1))
        left = held <= bound[r]
        r, e, held = r[left], e[left], held[left]
    low = np.minimum.reduceat(held, np.searchsorted(r, rows))
    first = np.flatnonzero(held == low[r])  # of equal entries the first stands first
    return e[first[np.searchsorted(r[first], rows)]], low


class Codebooks:
    """Integer entries by part, entry and position, and how vectors were scaled."""

    def __init__(self, entries: np.ndarray, scale: int):
        self.entries, self.scale = np.asarray(entries, dtype=np.int64), scale
        self.transformed = walsh(self.entries)

    @property
    def dim(self) -> int:
        return self.entries.shape[0] * self.entries.shape[2]

    def sha256(self) -> str:
        return hashlib.sha256(",".join(map(str, self.entries.ravel().tolist())).encode()).hexdigest()

    def integers(self, vectors: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Which vectors can be coded, and their integer parts."""
        fits = (vectors.value_lengths().fill_null(0).to_numpy() == self.dim)
        x = vectors.filter(pa.array(fits)).flatten().to_numpy(zero_copy_only=False).reshape(-1, self.dim)
        x = np.floor(x * float(self.scale))
        small = (np.abs(x) <= LARGEST).all(1)
        fits[np.flatnonzero(fits)] = small
        return fits, x[small].astype(np.int64).reshape(-1, len(self.entries), self.entries.shape[2])

    def assign(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Entry of every part, and each vector's squared distances added up."""
        codes = np.empty(x.shape[:2], dtype=np.uint8)
        error = np.zeros(len(x), dtype=np.int64)
        for start in range(0, len(x), SLICE_ROWS):
            rows = slice(start, start + SLICE_ROWS)
            parts = walsh(x[rows])
            for p, entries in enumerate(self.transformed):
                codes[rows, p], scaled = nearest(parts[:, p], entries)
                error[rows] += scaled // parts.shape[2]
        return codes, error


def usable(embedding: Column) -> Column:
    fine = F.forall(embedding, lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) < float("inf")))
    return embedding.isNotNull() & fine


def whole(vectors: DataFrame, vec_id: str, embedding: str, carry: list[str]) -> DataFrame:
    """Usable rows: id, vector in doubles, and the carried columns in one struct."""
    row = F.struct(*[F.col(c) for c in carry]) if carry else F.struct(F.lit(None).cast("int").alias("none"))
    return vectors.select(
        F.col(vec_id).cast("long").alias("vec_id"), F.col(embedding).cast("array<double>").alias("x"), row.alias("row")
    ).where(usable(F.col("x")))


def first_rows(rows: DataFrame, parts: int, entries: int, scale: int) -> list:
    """Vectors of the first ``entries`` rows that can be coded: all that ever is collected of the data."""
    size = F.size("x")
    can = rows.where((size > 0) & (size % parts == 0) & F.forall("x", lambda e: F.abs(F.floor(e * float(scale))) <= LARGEST))
    order = [F.col("vec_id").asc_nulls_last(), F.col("x")]
    found = [r.x for r in can.select("vec_id", "x").orderBy(*order).limit(entries).collect()]
    if found and any(len(x) != len(found[0]) for x in found):
        same = can.where(size == len(found[0]))
        found = [r.x for r in same.select("vec_id", "x").orderBy(*order).limit(entries).collect()]
    return found


def part_sums(batches: Iterator[pa.RecordBatch], books: Codebooks) -> Iterator[pa.RecordBatch]:
    """One task's number and sum of parts by entry."""
    parts, entries, d = books.entries.shape
    n, sums = np.zeros((parts, entries), dtype=np.int64), np.zeros((parts, entries, d), dtype=np.int64)
    for batch in batches:
        for start in range(0, len(batch), SLICE_ROWS):
            _, x = books.integers(batch.column("x").slice(start, SLICE_ROWS))
            codes, _ = books.assign(x)
            for p in range(parts if len(x) else 0):
                order = np.argsort(codes[:, p], kind="stable")
                used, at = np.unique(codes[order, p], return_index=True)
                sums[p, used] += np.add.reduceat(x[order, p], at, axis=0)
                n[p] += np.bincount(codes[:, p], minlength=entries)
    cell = np.flatnonzero(n.ravel())
    values = pa.ListArray.from_arrays(np.arange(0, d * len(cell) + 1, d, dtype=np.int32), sums.reshape(-1, d)[cell].ravel())
    yield pa.RecordBatch.from_arrays([pa.array(cell, pa.int32()), pa.array(n.ravel()[cell]), values], names=["cell", "n", "sums"])


def train(vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding",
          parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE) -> Codebooks | None:
    """Codebooks of all vectors; None where no row can be coded."""
    if not 0 < entries <= 256:
        raise ValueError("an entry's index has two hex digits")
    rows = whole(vectors, vec_id, embedding, [])
    found = first_rows(rows, parts, entries, scale)
    if not found:
        return None
    x = np.floor(np.array(found, dtype=np.float64) * scale).astype(np.int64)
    books = Codebooks(x.reshape(len(x), parts, -1).transpose(1, 0, 2), scale)
    d = books.entries.shape[2]
    for _ in range(rounds):
        now = books
        sums = rows.select("x").mapInArrow(lambda batches: part_sums(batches, now), "cell int, n long, sums array<long>")
        total = sums.groupBy("cell").agg(F.sum("n").alias("n"), F.array(*[F.sum(F.col("sums")[i]) for i in range(d)]).alias("sums"))
        new = books.entries.reshape(-1, d).copy()
        for r in total.collect():  # parts * entries rows at the most
            new[r.cell] = [s // r.n for s in r.sums]
        books = Codebooks(new.reshape(books.entries.shape), scale)
    return books


def encode(vectors: DataFrame, books: Codebooks | None, vec_id: str = "vec_id", embedding: str = "embedding", carry: list[str] | None = None) -> DataFrame:
    """``vec_id``, ``code`` (an index of two hex digits a part), ``error`` (squared distance) and ``row``, the carried columns."""
    rows = whole(vectors, vec_id, embedding, carry or [])
    schema = f"vec_id long, code string, error long, row {rows.schema['row'].dataType.simpleString()}"

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            codes, errors = [None] * len(batch), [None] * len(batch)
            if books is not None:
                fits, x = books.integers(batch.column("x"))
                found, error = books.assign(x)
                for i, c, e in zip(np.flatnonzero(fits).tolist(), found, error.tolist()):
                    codes[i], errors[i] = c.tobytes().hex(), e
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), pa.array(codes, pa.string()), pa.array(errors, pa.int64()), batch.column("row")],
                names=["vec_id", "code", "error", "row"])

    return rows.mapInArrow(code, schema)


def decode(codes: DataFrame, books: Codebooks) -> DataFrame:
    """``vec_id`` and the coded vector ``x``: the entries' components, scaled back; null where the code is."""
    values = books.entries / float(books.scale)

    def look_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = [None if c is None else values[np.arange(len(values)), list(bytes.fromhex(c))].ravel() for c in batch.column("code").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), pa.array(out, pa.list_(pa.float64()))], names=["vec_id", "x"])

    return codes.select("vec_id", "code").mapInArrow(look_up, "vec_id long, x array<double>")


def with_label_error(coded: DataFrame, label: Column) -> DataFrame:
    """Coded rows with their label's summed error.

    The coded rows are written once.  Errors are added per label before they are
    shuffled and written too, so the join knows by its file's size whether the
    totals can be broadcast; else a hot label's rows are split at run time.
    """
    spark = coded.sparkSession
    path, totals = work_path(spark, "codes"), work_path(spark, "label-errors")
    coded.select("vec_id", "code", "error", label.alias("label")).write.parquet(path)
    rows = spark.read.parquet(path)
    rows.groupBy("label").agg(F.sum("error").alias("label_error")).write.parquet(totals)
    of = spark.read.parquet(totals).withColumnRenamed("label", "of")
    return rows.join(of, F.col("label").eqNullSafe(F.col("of")), "left").drop("of")
