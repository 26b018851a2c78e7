"""Mixing sources to target weights by weighted fair queueing.

Every source is a queue of its shuffled documents, run through up to three
times.  A document's virtual finish time is the tokens its source has sent up
to its end, divided by the source's target; all entries are sorted by it over
the whole table and the mix is cut where the budget of tokens is spent.

Nothing is gathered: running totals come from totals per hash slot within a
source, so a source with a third of all rows is many slots; the cut comes from
totals per range partition.  Only the table of sources, a row each, is sorted
in one piece.

Cases: a null text has no words; the null source comes last; a source without
words gets target 0 and takes nothing; repeated rows count each; an empty table
gives an empty result; further columns are carried by ``mix_documents`` only.
Order and result depend on ids and texts alone, so reruns agree.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tribuna.llm.common import n_words, one_row, text_of
from tribuna.session import cut_lineage

WEIGHTS = (5, 2, 1)
#: No document is taken more often than this.
MAX_EPOCHS = 3
#: Rows that one slot or one range of the sort holds, about.
SLOT_ROWS = 10_000
#: Ranges of the global order at most: beyond, a range has more rows and is numbered by a sort that spills.
MAX_RANGES = 10_000
SOURCE = ["__no_source", "__source"]


def sized(docs: DataFrame, text: str, source: str, doc_id: str) -> DataFrame:
    """One slim row per document: id, source, words, and a hash that shuffles."""
    slim = docs.select(
        F.col(doc_id).alias("__id"),
        F.col(source).isNull().alias("__no_source"),
        F.coalesce(source, F.lit("")).alias("__source"),
        F.xxhash64(F.lit("mix"), doc_id, source, text).alias("__u"),
        n_words(text_of(text)).alias("__size"),
    )
    return cut_lineage(slim)


def targets(sources: DataFrame, budget: int, weights=WEIGHTS, most: int = MAX_EPOCHS) -> DataFrame:
    """Adds ``__target``: shares of the budget by weight, none above ``most`` times its source.

    With sources in the order of cap by weight, the level that the uncapped ones
    reach is the largest of the levels left when all sources before are capped.
    """
    place = Window.orderBy(*SOURCE)
    listed = F.array(*[F.lit(float(w)) for w in weights])
    s = sources.withColumn("__weight", F.get(listed, ((F.row_number().over(place) - 1) % len(weights)).cast("int")))
    s = s.withColumn("__cap", F.col("__total") * F.lit(float(most)))
    before = Window.orderBy(F.col("__cap") / F.col("__weight"), *SOURCE).rowsBetween(Window.unboundedPreceding, -1)
    left = F.lit(float(budget)) - F.coalesce(F.sum("__cap").over(before), F.lit(0.0))
    weight = F.sum("__weight").over(Window.partitionBy()) - F.coalesce(F.sum("__weight").over(before), F.lit(0.0))
    s = s.withColumn("__level", left / weight)
    level = F.max("__level").over(Window.partitionBy())
    return s.withColumn("__target", F.least(F.col("__cap"), level * F.col("__weight"))).select(*SOURCE, "__total", "__target")


def queue(docs: DataFrame, weights, most: int, budget: int | None) -> tuple[DataFrame, int]:
    """Every document and turn with its finish time, and the budget."""
    total = one_row(docs.agg(F.count(F.lit(1)).alias("n"), F.sum("__size").alias("words")))
    budget = (total["words"] or 0) if budget is None else budget
    slots = max(1, math.ceil(total["n"] / SLOT_ROWS))
    # The slot is the high part of the hash, so slots follow the shuffled order.
    docs = docs.withColumn("__slot", F.floor((F.shiftrightunsigned("__u", 33).cast("double") / 2.0**31) * slots).cast("int"))
    per_slot = docs.groupBy(*SOURCE, "__slot").agg(F.sum("__size").alias("__words"))
    so_far = Window.partitionBy(*SOURCE).orderBy("__slot").rowsBetween(Window.unboundedPreceding, -1)
    per_slot = cut_lineage(
        per_slot.withColumns({
            "__before": F.coalesce(F.sum("__words").over(so_far), F.lit(0)),
            "__total": F.sum("__words").over(Window.partitionBy(*SOURCE)),
        })
    )
    sources = per_slot.groupBy(*SOURCE).agg(F.sum("__words").alias("__total"))
    per_slot = per_slot.drop("__words", "__total").join(targets(sources, budget, weights, most), SOURCE)
    within = Window.partitionBy(*SOURCE, "__slot").orderBy(F.shiftrightunsigned("__u", 1), "__u", "__id", "__size")
    q = docs.join(per_slot, [*SOURCE, "__slot"])
    q = q.withColumns({
        "__rn": F.row_number().over(within),
        "__end": F.col("__before") + F.sum("__size").over(within.rowsBetween(Window.unboundedPreceding, 0)),
    })
    q = q.withColumn("__turn", F.explode(F.array(*[F.lit(i) for i in range(most)])))
    finish = (F.col("__turn") * F.col("__total") + F.col("__end")) / F.col("__target")
    return q.withColumn("__finish", F.when(F.col("__target") > 0, finish).otherwise(F.lit(float("inf")))), budget


def truncated(q: DataFrame, budget: int, ranges: int) -> DataFrame:
    """The queue in global order, with ``__in`` where the running total is within the budget."""
    order = ["__finish", *SOURCE, "__u", "__id", "__rn"]
    ranged = cut_lineage(q.repartitionByRange(ranges, *order).withColumn("__range", F.spark_partition_id()))
    size = F.when(F.col("__finish") < float("inf"), F.col("__size")).otherwise(F.lit(0))
    sums = ranged.groupBy("__range").agg(F.sum(size).alias("__sum"))
    before = Window.orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select("__range", F.coalesce(F.sum("__sum").over(before), F.lit(0)).alias("__gone"))
    local = Window.partitionBy("__range").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    out = ranged.join(sums, "__range").withColumn("__spent", F.col("__gone") + F.sum(size).over(local))
    return out.withColumn("__in", (F.col("__finish") < float("inf")) & (F.col("__spent") <= budget))


def mix(
    docs: DataFrame, weights=WEIGHTS, most: int = MAX_EPOCHS, budget: int | None = None,
    text: str = "text", source: str = "source", doc_id: str = "doc_id",
) -> DataFrame:
    """One row per document: size, its source's size and target, and the words the mix takes of it.

    What has no words is taken no times.
    ``budget`` is the words of the mix; by default all words of the table.
    """
    rows = sized(docs, text, source, doc_id)
    q, budget = queue(rows, tuple(weights), most, budget)
    ranges = min(MAX_RANGES, max(1, math.ceil(most * one_row(rows.agg(F.count(F.lit(1))))[0] / SLOT_ROWS)))
    key = ["__id", *SOURCE, "__slot", "__u", "__rn", "__size", "__total", "__target"]
    return truncated(q, budget, ranges).groupBy(*key).agg(F.sum((F.col("__in") & (F.col("__size") > 0)).cast("long")).alias("__times")).select(
        F.col("__id").alias("doc_id"),
        F.col("__size").alias("size"),
        F.col("__total").alias("source_size"),
        F.col("__target").alias("target"),
        (F.col("__times") * F.col("__size")).alias("taken"),
        F.col("__times").alias("times"),
        F.col("__u").alias("shuffle_key"),
    )


def mix_documents(docs: DataFrame, text: str = "text", source: str = "source", doc_id: str = "doc_id", **how) -> DataFrame:
    """The documents of the mix with all their columns, each as often as it is taken.

    Documents that are equal in id, source and text share their turns evenly;
    documents without words are in no mix.
    """
    taken = mix(docs, text=text, source=source, doc_id=doc_id, **how).where("times > 0")
    taken = taken.groupBy(F.col("shuffle_key").alias("__u"), F.col("doc_id").alias("__id")).agg(F.sum("times").alias("__all"))
    left = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("row"), F.col(doc_id).alias("__own"), F.xxhash64(F.lit("mix"), doc_id, source, text).alias("__key"))
    both = left.join(taken, (F.col("__key") == F.col("__u")) & F.col("__own").eqNullSafe(F.col("__id")))
    same = Window.partitionBy("__key")
    both = both.withColumns({
        "__place": F.row_number().over(same.orderBy("__key")),
        "__copies": F.count(F.lit(1)).over(same),
    })
    times = F.floor(F.col("__all") / F.col("__copies")) + F.when(F.col("__place") <= F.col("__all") % F.col("__copies"), 1).otherwise(0)
    return both.where(times > 0).select("row", F.explode(F.sequence(F.lit(1), times.cast("int"))).alias("__turn")).select("row.*")
