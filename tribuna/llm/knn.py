"""Exact top-k search by inner product: a Voronoi join with bounds per group.

Pivots are a bounded sample, about as many as the root of the rows.  Data go to
their nearest pivot and, by their angle to it, to a ring of its group.  A ring's
summary is its number of ids, its range of angles and its range of norms: a query
at angle t to the pivot scores at most |q| |x| cos(gap) with a vector of the ring,
where gap is the distance of t from the ring's angles, and at least |q| |x| times
the cosine of both angles' sum.

There are two passes.  The first solves for each query the rings that promise the
highest scores, until they hold some times k vectors; the k-th score found is one that the
answer reaches at least.  The second solves the rings whose bound reaches it.

Rings are laid out in packs of bounded rows; a ring with a third of all vectors is
many packs.  A query is sent to a pack once, with the rings it needs there, and
meets only these.  Queries are dealt to teams by their groups, and data are
repeated only for the teams that need them.  Vectors are multiplied by ``scale``
and floored, so scores are integers; products are exact, in floating point while
sums stay below 2**53, else in 64-bit integers.

Cases: vectors that are null or hold null, NaN or infinite components take no
part; a vector meets vectors of its own length only; equal scores go to the
smaller id; repeated ids are rows of their own, but a query never meets a row of
its own id; a query without candidates has no rows; an empty table gives an
empty result; further columns are ignored.  Components beyond 2**53 after
scaling are out of range.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import isqrt
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tribuna.session import cut_lineage

SCALE = 1024
K = 10
#: Pivots at most, and rings by angle of a group.
PIVOTS = 1024
RINGS = 24
#: Vectors, as a multiple of k, that a query meets in the first pass.
FIRST = 32
#: Rows of a pack.
BLOCK_ROWS = 8192
#: Queries of a team: what a pack meets in one task.
TEAM_ROWS = 8192
#: Queries that are solved against a pack at once.
QUERY_ROWS = 512
#: Bounds that are worked out at once.
BOUNDS = 1 << 20
#: What rounding may change: of a product, relative, and of an angle.
ULP = 1e-9
ANGLE = 1e-6
#: No score.
NONE = np.iinfo(np.int64).min


def whole(vectors: DataFrame, vec_id: str, embedding: str, scale: int, k: int) -> DataFrame:
    """Id and integer vector of every row that takes part."""
    v = vectors.select(F.col(vec_id).cast("long").alias("id"), F.col(embedding).cast("array<double>").alias("x")).where("id is not null")
    fine = F.forall("x", lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) < float("inf")))
    v = v.where(F.col("x").isNotNull() & fine).select("id", F.transform("x", lambda e: F.floor(e * float(scale)).cast("long")).alias("x"))
    # Of equal rows no more than k can be in any answer.
    n = v.groupBy("id", "x").agg(F.count(F.lit(1)).alias("n"))
    return n.select("id", "x", F.explode(F.sequence(F.lit(1), F.least("n", F.lit(k)).cast("int"))).alias("copy"))


def sample_pivots(vectors: DataFrame, n: int) -> dict[int, np.ndarray]:
    """At most ``n`` distinct vectors by smallest hash of the content, by vector length."""
    rows = vectors.select("x").distinct().orderBy(F.xxhash64("x"), "x").limit(n).collect()
    by_length: dict[int, list] = {}
    for (x,) in rows:
        by_length.setdefault(len(x), []).append(x)
    return {d: np.array(v, dtype=np.float64).reshape(len(v), d) for d, v in by_length.items()}


def nearest(x: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    """Index of the nearest pivot."""
    return ((pivots * pivots).sum(1)[None, :] - 2 * x @ pivots.T).argmin(1)


def directions(pivots: np.ndarray) -> np.ndarray:
    """Unit vectors towards the pivots; a pivot at the origin stands for the first axis."""
    out = np.array(pivots, dtype=np.float64)
    length = np.sqrt((out * out).sum(1))
    if out.shape[1]:
        out[length == 0, 0] = 1.0
    return out / np.where(length == 0, 1.0, length)[:, None]


def towards(pivots: dict[int, np.ndarray], d: int) -> np.ndarray:
    return directions(pivots.get(d, np.zeros((1, d))))


def angle(along: np.ndarray, norm: np.ndarray) -> np.ndarray:
    """Angle to a direction, of a vector with this product with it and this norm."""
    return np.arctan2(np.sqrt(np.maximum(norm * norm - along * along, 0.0)), along)


def assign(batches: Iterator[pd.DataFrame], pivots: dict[int, np.ndarray]) -> Iterator[pd.DataFrame]:
    """Adds vector length, group, zone (the ring, numbered over all groups), angle and norm to each vector."""
    for df in batches:
        lengths = df["x"].map(len).to_numpy()
        for d in np.unique(lengths):
            part = df[lengths == d]
            x = np.array(part["x"].tolist(), dtype=np.float64).reshape(len(part), d)
            norm = np.sqrt((x * x).sum(1))
            if d in pivots:
                at = nearest(x, pivots[d])
            else:  # a length that the sample has missed is one group around the first axis
                at = np.zeros(len(part), dtype=int)
            turn = angle((x * towards(pivots, d)[at]).sum(1), norm)
            ring = np.minimum((turn * (RINGS / np.pi)).astype(int), RINGS - 1)
            yield pd.DataFrame({
                "id": part["id"], "x": part["x"], "copy": part["copy"], "d": np.int32(d), "cell": at.astype(np.int32),
                "zone": (at * RINGS + ring).astype(np.int32), "angle": turn, "norm": norm,
            })


ASSIGNED = "id long, x array<long>, copy int, d int, cell int, zone int, angle double, norm double"


class Zones(NamedTuple):
    """The rings of one vector length, in the order of their packs."""

    zone: np.ndarray
    ids: np.ndarray
    #: Angles and norms, from and to.
    angles: np.ndarray
    norms: np.ndarray
    #: First pack, and number of packs.
    pack: np.ndarray
    parts: np.ndarray


def lay_out(summaries: list, block_rows: int) -> dict[int, Zones]:
    """Rings (``d, zone, n, ids, a0, a1, n0, n1``) in packs of at most ``block_rows``; a larger ring has packs of its own."""
    pack, held, last = 0, 0, None
    rows: dict[int, list] = {}
    for s in sorted(summaries, key=lambda s: (s.d, s.zone)):
        parts = max(1, -(-s.n // block_rows))
        if held and (s.d != last or held + s.n > block_rows):
            pack, held = pack + 1, 0
        rows.setdefault(s.d, []).append((s.zone, s.ids, (s.a0, s.a1), (s.n0, s.n1), pack, parts))
        held, last = held + s.n, s.d
        if parts > 1:
            pack, held = pack + parts, 0
    return {d: Zones(*(np.array(c) for c in zip(*r))) for d, r in rows.items()}


def bounds(q: np.ndarray, pivot: np.ndarray, zones: Zones) -> np.ndarray:
    """The most that each query (row) can score with a vector of each ring (column)."""
    norm = np.sqrt((q * q).sum(1))
    turn = angle(q @ pivot.T, norm[:, None])[:, zones.zone // RINGS]
    gap = np.maximum(np.maximum(zones.angles[:, 0] - turn, turn - zones.angles[:, 1]) - ANGLE, 0.0)
    most = np.cos(gap)
    return norm[:, None] * (np.maximum(most * zones.norms[:, 0], most * zones.norms[:, 1]) + ULP * zones.norms[:, 1])


def guesses(q: np.ndarray, pivot: np.ndarray, zones: Zones) -> np.ndarray:
    """What each query scores on average with a vector of each ring, were their parts across the pivot at random."""
    middle = zones.norms.mean(1) * np.cos(zones.angles.mean(1))
    return (q @ pivot.T)[:, zones.zone // RINGS] * middle


def first_rings(guess: np.ndarray, ids: np.ndarray, enough: int) -> np.ndarray:
    """Marks for each query the rings with the highest guesses that together hold enough ids."""
    order = np.argsort(-guess, axis=1, kind="stable")
    held = np.cumsum(ids[order], axis=1)
    taken = held - ids[order] < enough
    out = np.empty_like(taken)
    np.put_along_axis(out, order, taken, axis=1)
    return out


def in_steps(batches: Iterator[pd.DataFrame], zones: dict[int, Zones]) -> Iterator[tuple[int, pd.DataFrame, np.ndarray]]:
    """Queries by vector length, so many at once that their bounds fit, with their vectors."""
    for df in batches:
        for d, part in df.groupby("d"):
            if int(d) in zones:
                step = max(1, BOUNDS // len(zones[int(d)].zone))
                for start in range(0, len(part), step):
                    rows = part.iloc[start : start + step]
                    yield int(d), rows, np.array(rows["x"].tolist(), dtype=np.float64).reshape(len(rows), d)


def choose_first(batches: Iterator[pd.DataFrame], pivots: dict[int, np.ndarray], zones: dict[int, Zones], enough: int) -> Iterator[pd.DataFrame]:
    """Each query with the rings of its first pass.

    They are kept, not worked out again by the second pass: bounds that are
    rounded otherwise there could leave a ring to neither.  The query's own id may
    be among those counted, so ``enough`` is more than k.
    """
    for d, rows, q in in_steps(batches, zones):
        z = zones[d]
        taken = first_rings(guesses(q, towards(pivots, d), z), z.ids, enough)
        yield rows.assign(first=[z.zone[t].astype(np.int32) for t in taken])[["id", "x", "d", "team", "first"]]


CHOSEN = "id long, x array<long>, d int, team int, first array<int>"


def plan_queries(batches: Iterator[pd.DataFrame], pivots: dict[int, np.ndarray], zones: dict[int, Zones], second: bool) -> Iterator[pd.DataFrame]:
    """For each query the packs it is sent to and the rings it meets there.

    The second pass asks what the first has not asked and what reaches ``bound``,
    the k-th score so far (null: everything).
    """
    for d, rows, q in in_steps(batches, zones):
        z = zones[d]
        keep = np.array([np.isin(z.zone, f) for f in rows["first"]]).reshape(len(rows), len(z.zone))
        if second:
            keep = ~keep & (bounds(q, towards(pivots, d), z) >= rows["bound"].astype(float).fillna(-np.inf).to_numpy()[:, None])
        yield send(rows, keep, z)


SENT = "q long, qx array<long>, team int, pack int, zones array<int>"


def send(rows: pd.DataFrame, keep: np.ndarray, z: Zones) -> pd.DataFrame:
    """A row per query and pack, with the rings that the query meets there."""
    i, c = np.nonzero(keep)
    cuts = np.flatnonzero((np.diff(i) != 0) | (np.diff(z.pack[c]) != 0)) + 1
    heads = np.concatenate([[0], cuts]).astype(int) if len(i) else np.zeros(0, dtype=int)
    met = np.split(z.zone[c].astype(np.int32), cuts) if len(i) else []
    parts = z.parts[c[heads]]
    which = np.repeat(np.arange(len(heads)), parts)
    pack = z.pack[c[heads]][which] + np.arange(len(which)) - np.repeat(np.cumsum(parts) - parts, parts)
    at = i[heads][which]
    return pd.DataFrame({
        "q": rows["id"].to_numpy()[at], "qx": rows["x"].to_numpy()[at], "team": rows["team"].to_numpy()[at],
        "pack": pack.astype(np.int32), "zones": pd.Series([met[w] for w in which], dtype=object),
    })


def product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact integer products of rows."""
    most = float(np.abs(a).max(initial=0)) * float(np.abs(b).max(initial=0)) * max(a.shape[1], 1)
    if most < 2.0**53:
        return (a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64)
    return a @ b.T


def solve(queries: pd.DataFrame, data: pd.DataFrame, k: int) -> pd.DataFrame:
    """The k best of one pack for every query that was sent to it, among the rings it asks for."""
    empty = pd.DataFrame({"query_id": pd.Series(dtype="int64"), "q_hash": pd.Series(dtype="int64"), "vec_id": pd.Series(dtype="int64"), "score": pd.Series(dtype="int64")})
    if queries.empty or data.empty:
        return empty
    data = data.sort_values(["zone", "id"], kind="stable")
    ids = data["id"].to_numpy()
    d = len(data["x"].iloc[0])
    x = np.array(data["x"].tolist(), dtype=np.int64).reshape(len(data), d)
    zones, starts = np.unique(data["zone"].to_numpy(), return_index=True)
    ends = np.append(starts[1:], len(data))
    out = []
    for start in range(0, len(queries), QUERY_ROWS):
        part = queries.iloc[start : start + QUERY_ROWS]
        q = np.array(part["qx"].tolist(), dtype=np.int64).reshape(len(part), d)
        scores = np.full((len(part), len(data)), NONE)
        asks = np.zeros((len(part), len(zones)), dtype=bool)
        for i, met in enumerate(part["zones"]):
            asks[i] = np.isin(zones, met)
        for j in np.flatnonzero(asks.any(0)):
            who = np.flatnonzero(asks[:, j])
            scores[who, starts[j] : ends[j]] = product(q[who], x[starts[j] : ends[j]])
        for own, q_hash, row in zip(part["q"].to_numpy(), part["q_hash"].to_numpy(), scores):
            # k + the rows of the query's own id suffice; equal scores at the border are all looked at.
            mine = ids == own
            need = k + int(mine.sum())
            at = np.flatnonzero(row > NONE)
            if need < len(at):
                found = row[at]
                at = at[found >= np.partition(found, len(found) - need)[len(found) - need]]
            at = at[~mine[at]]
            at = at[np.lexsort((ids[at], -row[at]))][:k]
            out.append(pd.DataFrame({"query_id": np.int64(own), "q_hash": np.int64(q_hash), "vec_id": ids[at], "score": row[at]}))
    return pd.concat(out, ignore_index=True) if out else empty


def team_up(counts: dict[tuple[int, int], int], most: int) -> dict[tuple[int, int], tuple[int, int]]:
    """Groups' queries dealt to teams of about ``most``: neighbours share one, a large group gets several. First team and number."""
    out, team, held = {}, 0, 0
    for cell, n in sorted(counts.items()):
        if held and held + n > most:
            team, held = team + 1, 0
        parts = max(1, -(-n // most))
        out[cell] = (team, parts)
        team, held = (team + parts, 0) if parts > 1 else (team, held + n)
    return out


def solve_packs(asked: DataFrame, data: DataFrame, k: int) -> DataFrame:
    """The k best per query and pack; a pack's rows go to the teams that ask for it."""
    needed = asked.select(*[F.col(c).alias(c) for c in ("pack", "team")]).distinct()
    sent = data.select("id", "x", "zone", "pack").join(needed, "pack")
    asked = asked.withColumn("q_hash", F.xxhash64("qx"))
    return asked.groupBy("pack", "team").cogroup(sent.groupBy("pack", "team")).applyInPandas(
        lambda q, v: solve(q, v, k), "query_id long, q_hash long, vec_id long, score long"
    )


def best(found: DataFrame, k: int) -> DataFrame:
    w = Window.partitionBy("query_id", "q_hash").orderBy(F.col("score").desc(), "vec_id")
    return found.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def top_k(
    vectors: DataFrame, is_query: Column, k: int = K, scale: int = SCALE, n_pivots: int | None = None, block_rows: int = BLOCK_ROWS, team_rows: int = TEAM_ROWS,
    first: int = FIRST, vec_id: str = "vec_id", embedding: str = "embedding",
) -> DataFrame:
    """``query_id, rank, vec_id, score``: the k best of all rows for every row that ``is_query`` (on ``id``) chooses.

    ``n_pivots``: by default the root of the rows, ``PIVOTS`` at most.
    """
    spark = vectors.sparkSession
    x = cut_lineage(whole(vectors, vec_id, embedding, scale, k))
    pivots = sample_pivots(x, n_pivots or min(PIVOTS, isqrt(x.count()) + 1))
    data = cut_lineage(x.mapInPandas(lambda it: assign(it, pivots), ASSIGNED))
    queries = data.where(is_query).where("copy = 1")
    # One row per ring: at most RINGS times the number of pivots and of vector lengths. So are the two tables that are broadcast.
    summaries = data.groupBy("d", "zone").agg(
        F.count(F.lit(1)).alias("n"), F.count_distinct("id").alias("ids"), F.min("angle").alias("a0"), F.max("angle").alias("a1"), F.min("norm").alias("n0"), F.max("norm").alias("n1")
    )
    zones = lay_out(summaries.collect(), block_rows)
    places = [(int(d), int(n), int(p), int(m)) for d, z in zones.items() for n, p, m in zip(z.zone, z.pack, z.parts)]
    layout = F.broadcast(spark.createDataFrame(places, "d int, zone int, first int, parts int"))
    data = data.join(layout, ["d", "zone"]).withColumn("pack", F.col("first") + F.pmod(F.xxhash64("id", "x", "copy"), F.col("parts")).cast("int"))
    teams = team_up({(r.d, r.cell): r["count"] for r in queries.groupBy("d", "cell").count().collect()}, team_rows)
    dealt = F.broadcast(spark.createDataFrame([(d, c, t, n) for (d, c), (t, n) in teams.items()], "d int, cell int, first int, parts int"))
    team = (F.col("first") + F.pmod(F.xxhash64("id", "x"), F.col("parts"))).cast("int")
    queries = queries.join(dealt, ["d", "cell"]).select("id", "x", "d", team.alias("team"))
    queries = cut_lineage(queries.mapInPandas(lambda it: choose_first(it, pivots, zones, first * k + 1), CHOSEN))
    asked = cut_lineage(queries.mapInPandas(lambda it: plan_queries(it, pivots, zones, False), SENT))
    found = cut_lineage(best(solve_packs(asked, data, k), k))
    bound = found.where(F.col("rank") == k).select(F.col("query_id").alias("id"), "q_hash", F.col("score").cast("double").alias("bound"))
    queries = queries.withColumn("q_hash", F.xxhash64("x")).join(bound, ["id", "q_hash"], "left")
    asked = cut_lineage(queries.mapInPandas(lambda it: plan_queries(it, pivots, zones, True), SENT))
    both = found.drop("rank").unionByName(solve_packs(asked, data, k))
    return best(both, k).select("query_id", "rank", "vec_id", "score")
