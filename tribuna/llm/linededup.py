"""Line dedup: lines that stand on many different sites are boilerplate.

A line is known by a hash of 128 bits of its trimmed text.  One aggregate gives
each line a HyperLogLog sketch of its sites (partial sketches merge before the
shuffle and after it) and the smallest document that has it.  Estimates clear
of the threshold decide by themselves; the few lines near it get exact distinct
counts.  Every boilerplate line is then cut from all documents but the one with
the smallest id, so that nothing vanishes from the corpus.

Cases: a null text stays null; lines without a word are never cut; the null
site is a site; a row without id never is the one that keeps a line, unless no
row has an id, when all keep it; rows with equal id and text are treated alike;
a text of which all lines go becomes empty; an empty table gives an empty
result; further columns are carried unchanged.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tribuna.llm.common import SPACES, WORD, text_of
from tribuna.session import cut_lineage

MIN_SITES = 10
#: log2 of the registers of a sketch, and the standard errors that count as near.
LG_K = 12
SIGMAS = 4


def line_table(docs: DataFrame, text: str, site: str, doc_id: str) -> DataFrame:
    """One row per line with a word: its hash, place, document and site."""
    lines = docs.select(
        F.col(doc_id).alias("id"),
        F.xxhash64(text).alias("th"),
        F.xxhash64(F.lit("site"), F.col(site)).alias("site"),
        F.posexplode(F.split(text_of(text), "\n", -1)).alias("pos", "line"),
    ).where(F.col("line").rlike(WORD))
    line = F.trim("line", F.lit(SPACES))
    return lines.select("id", "th", "site", "pos", F.xxhash64(line).alias("h1"), F.xxhash64(F.lit("line"), line).alias("h2"))


def boilerplate(lines: DataFrame, min_sites: int = MIN_SITES) -> DataFrame:
    """``h1, h2, keeper`` of the lines that stand on ``min_sites`` sites or more."""
    margin = max(1, math.ceil(SIGMAS * 1.04 / math.sqrt(2**LG_K) * min_sites))
    spread = cut_lineage(
        lines.groupBy("h1", "h2")
        .agg(F.hll_sketch_agg("site", F.lit(LG_K)).alias("sketch"), F.min("id").alias("keeper"))
        .select("h1", "h2", "keeper", F.hll_sketch_estimate("sketch").alias("sites"))
        .where(F.col("sites") >= min_sites - margin)
    )
    sure = spread.where(F.col("sites") > min_sites + margin)
    near = spread.where(F.col("sites") <= min_sites + margin)
    exact = (
        lines.select("h1", "h2", "site")
        .join(near.select("h1", "h2"), ["h1", "h2"], "left_semi")
        .distinct()
        .groupBy("h1", "h2")
        .agg(F.count(F.lit(1)).alias("exact"))
        .where(F.col("exact") >= min_sites)
    )
    near = near.join(exact, ["h1", "h2"]).select("h1", "h2", "keeper")
    return sure.select("h1", "h2", "keeper").unionByName(near)


def dedup_lines(
    docs: DataFrame, min_sites: int = MIN_SITES, text: str = "text", site: str = "source", doc_id: str = "doc_id"
) -> DataFrame:
    """The documents with boilerplate lines cut, and ``__n_lines`` and ``__n_removed`` beside all their columns."""
    lines = cut_lineage(line_table(docs, text, site, doc_id))
    cut = (
        lines.join(boilerplate(lines, min_sites), ["h1", "h2"])
        .where(~F.col("id").eqNullSafe(F.col("keeper")))
        .groupBy(F.col("id").alias("__id"), F.col("th").alias("__th"))
        .agg(F.collect_set("pos").alias("__cut"))
    )
    left = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("row"), F.col(doc_id).alias("__own"), F.xxhash64(text).alias("__hash"))
    out = left.join(cut, F.col("__own").eqNullSafe(F.col("__id")) & (F.col("__hash") == F.col("__th")), "left")
    out = out.withColumn("__old", F.split(F.col("row")[text], "\n", -1))
    # Lines and cuts sorted together: a line goes when a cut of its place stands before it.
    out = out.withColumn(
        "__both",
        F.expr(
            "sort_array(concat(transform(__old, (x, i) -> named_struct('i', i, 'k', 1, 'x', x)), "
            "transform(__cut, p -> named_struct('i', p, 'k', 0, 'x', ''))))"
        ),
    )
    rest = F.expr("transform(filter(__both, (e, j) -> e.k = 1 and (j = 0 or get(__both, j - 1).i != e.i)), e -> e.x)")
    kept = F.when(F.col("__cut").isNotNull(), F.concat_ws("\n", rest)).otherwise(F.col("row")[text])
    return out.select(
        *[kept.alias(c) if c == text else F.col("row")[c].alias(c) for c in docs.columns],
        F.coalesce(F.size("__old"), F.lit(0)).cast("long").alias("__n_lines"),
        F.coalesce(F.size("__cut"), F.lit(0)).cast("long").alias("__n_removed"),
    )
