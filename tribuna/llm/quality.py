"""Quality rules: per-document rules, and host verdicts from shrunken failure rates.

Every document is measured by column functions.  The failures of each rule are
summed by host, a beta prior is fitted to all hosts by the method of moments,
and the host's shrunken rate of each rule gives its verdict, which is joined
back to its documents.  Above the upper limit a host is rejected with all its
documents; above the lower one it is watched, and its documents that break the
rule themselves go; below it the host is clean, and an odd document of it stays.
Hosts with few documents are pulled to the common rate, so a handful of bad
documents condemns no host.  The symbol and line rules count what the base rule
misses.

Cases: a null text has no words; an empty text fails the base rule; the null
host is a host of its own; repeated rows count each; an empty table gives an
empty result; further columns of the input are carried in one struct by
``filter_documents``, whatever their names, and ignored by ``judge``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tribuna.llm.common import SPACES, WORD, one_row, text_of, without, words
from tribuna.session import cut_lineage, work_path

MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
SYMBOLS = "#*$%&|<>"
#: A document breaks the symbol rule above this share of symbols in its words' characters ...
MAX_SYMBOL_PERCENT = 20
#: ... and the line rule above this share of lines that repeat an earlier one.
MAX_DUP_LINE_PERCENT = 50
#: A host goes when the shrunken failure rate of a rule is above this, and is watched for a rule from this rate on.
MAX_HOST_RATE = 0.6
WATCH_RATE = 0.01
RULES = ("base", "symbols", "lines")
#: Rules that a document of a watched host must not break; the base rule holds on any host.
OWN_RULES = ("symbols", "lines")


def with_words(docs: DataFrame, text: str = "text") -> DataFrame:
    """Adds ``__w`` (words), ``__key`` (a sortable key per 3-word window: its hash, cut so that its place fits below)."""
    w = docs.withColumn("__w", words(text_of(text)))
    # Bits for the place: the hash gives up that many of its own.
    w = w.withColumn("__bits", F.length(F.bin(F.size("__w").cast("long"))))
    key = F.expr(
        "transform(slice(__w, 1, greatest(size(__w) - 2, 0)), (x, i) -> "
        "shiftleft(xxhash64(x, get(__w, i + 1), get(__w, i + 2)), __bits) | cast(i as bigint))"
    )
    return w.withColumn("__key", F.sort_array(key))


def with_repeats(w: DataFrame) -> DataFrame:
    """Adds ``__n_repeat``: words in 3-word windows that stand twice or more in the text.

    Windows whose cut hashes meet are neighbours after the sort; only these are
    compared as words, so the hash decides nothing by itself.
    """
    near = F.expr(
        "transform(filter(__key, (k, i) -> "
        "(i > 0 and shiftright(k, __bits) = shiftright(get(__key, i - 1), __bits)) or "
        "(i + 1 < size(__key) and shiftright(k, __bits) = shiftright(get(__key, i + 1), __bits))), "
        "k -> cast(k & (shiftleft(1L, __bits) - 1) as int))"
    )
    w = w.withColumn("__near", near)
    w = w.withColumn(
        "__win",
        F.expr(
            "sort_array(transform(__near, p -> named_struct("
            "'t', concat_ws(' ', get(__w, p), get(__w, p + 1), get(__w, p + 2)), 'p', p)))"
        ),
    )
    same = F.expr(
        "sort_array(transform(filter(__win, (x, i) -> "
        "x.t = get(__win, i - 1).t or x.t = get(__win, i + 1).t), x -> x.p))"
    )
    w = w.withColumn("__at", same)
    covered = F.expr(
        "cast(aggregate(transform(__at, (p, i) -> if(i = 0, 3, least(3, p - get(__at, i - 1)))), 0L, (a, x) -> a + x) as bigint)"
    )
    return w.withColumn("__n_repeat", covered)


def measured(docs: DataFrame, carried: Column, text: str, host: str) -> DataFrame:
    """``row`` (the carried column), ``__host``, the measures and the broken rules, all named with two underscores."""
    t = text_of("__text")
    lines = F.filter(F.split(t, "\n", -1), lambda x: x.rlike(WORD))
    slim = docs.select(carried.alias("row"), F.col(host).alias("__host"), F.col(text).alias("__text"))
    w = with_repeats(with_words(slim, "__text"))
    w = w.withColumn("__n_words", F.size("__w").cast("long")).withColumn("__split", lines)
    w = w.withColumns({
        "__word_chars": F.length(without(t, SPACES)).cast("long"),
        "__n_symbols": (F.length(t) - F.length(without(t, SYMBOLS))).cast("long"),
        "__n_dup_lines": (F.size("__split") - F.size(F.array_distinct("__split"))).cast("long"),
        "__n_lines": F.size("__split").cast("long"),
    })
    base = (F.col("__n_words") < MIN_WORDS) | (100 * F.col("__n_repeat") > MAX_REPEAT_PERCENT * F.col("__n_words"))
    w = w.withColumn("__base", base).withColumns({
        "__symbols": ~F.col("__base") & (100 * F.col("__n_symbols") > MAX_SYMBOL_PERCENT * F.col("__word_chars")),
        "__lines": ~F.col("__base") & (100 * F.col("__n_dup_lines") > MAX_DUP_LINE_PERCENT * F.col("__n_lines")),
    })
    # A generator is a border that filters do not cross: a filter pushed below would compute arrays anew for each of their elements.
    names = ["__n_words", "__word_chars", "__n_symbols", "__n_dup_lines", "__n_repeat", *[f"__{r}" for r in RULES]]
    w = w.select("row", "__host", F.explode(F.array(F.struct(*names))).alias("__m"))
    return w.select("row", "__host", *[F.col(f"__m.{n}").alias(n) for n in names])


def host_counts(m: DataFrame) -> DataFrame:
    """Documents and failures of each rule by host; combined before the shuffle."""
    fails = [F.sum(F.col(f"__{r}").cast("long")).alias(f"__f_{r}") for r in RULES]
    return m.groupBy("__host").agg(F.count(F.lit(1)).alias("__n"), *fails)


def prior(hosts: DataFrame) -> dict[str, tuple[float, float]]:
    """Alpha and beta of each rule, by the method of moments over all hosts.

    The spread between hosts is what exceeds the binomial noise; without any,
    the prior outweighs every host.
    """
    sums = [F.sum("__n").alias("n"), F.count(F.lit(1)).alias("h"), F.sum(F.col("__n").cast("double") * F.col("__n")).alias("nn")]
    for r in RULES:
        f = F.col(f"__f_{r}").cast("double")
        sums += [F.sum(f).alias(f"f_{r}"), F.sum(f * f / F.col("__n")).alias(f"q_{r}")]
    row = one_row(hosts.agg(*sums))
    out = {}
    for r in RULES:
        n = float(row["n"] or 0)
        if not n:
            out[r] = (1.0, 1.0)
            continue
        m = row[f"f_{r}"] / n
        spread = row[f"q_{r}"] / n - m * m - m * (1 - m) * (row["h"] - 1) / n
        room = 1 - row["nn"] / (n * n)
        between = spread / room if room > 0 else 0.0
        strength = max(m * (1 - m) / between - 1, 1.0) if between > 0 else 1e9
        out[r] = (m * strength, (1 - m) * strength)
    return out


def shrunk(rule: str, beta: dict[str, tuple[float, float]]) -> Column:
    a, b = beta[rule]
    return (F.col(f"__f_{rule}") + F.lit(a)) / (F.col("__n") + F.lit(a + b))


def host_verdicts(m: DataFrame, limit: float = MAX_HOST_RATE, watch: float = WATCH_RATE) -> DataFrame:
    """Hosts that are rejected or watched: ``__of``, the shrunken rates, ``__rejected``, and ``__watch_<rule>``."""
    hosts = cut_lineage(host_counts(m))
    beta = prior(hosts)
    rates = hosts.select(F.col("__host").alias("__of"), *[shrunk(r, beta).alias(f"__rate_{r}") for r in RULES])
    out = rates.withColumn("__rejected", F.greatest(*[F.col(f"__rate_{r}") for r in RULES]) > limit)
    for r in OWN_RULES:
        out = out.withColumn(f"__watch_{r}", F.col(f"__rate_{r}") > watch)
    return out.where(F.col("__rejected") | F.col("__watch_symbols") | F.col("__watch_lines"))


def with_verdict(m: DataFrame) -> DataFrame:
    """Adds ``__kept`` to measured documents: what the base rule and the host's verdict leave."""
    joined = m.join(host_verdicts(m), F.col("__host").eqNullSafe(F.col("__of")), "left")
    bad = F.col("__base") | F.coalesce("__rejected", F.lit(False))
    for r in OWN_RULES:
        bad = bad | (F.col(f"__{r}") & F.coalesce(f"__watch_{r}", F.lit(False)))
    return joined.withColumn("__kept", ~bad)


def judge(docs: DataFrame, text: str = "text", host: str = "source", doc_id: str = "doc_id") -> DataFrame:
    """One row per document: its measures, whether it breaks the base rules, and the verdict."""
    m = cut_lineage(measured(docs, F.col(doc_id), text, host))
    return with_verdict(m).select(
        F.col("row").alias("doc_id"),
        F.col("__n_words").alias("n_words"),
        F.col("__word_chars").alias("word_chars"),
        F.col("__n_symbols").alias("n_symbols"),
        F.col("__n_dup_lines").alias("n_dup_lines"),
        F.col("__n_repeat").alias("n_repeat_words"),
        F.col("__base").alias("base_failed"),
        F.col("__kept").alias("kept"),
    )


def filter_documents(docs: DataFrame, text: str = "text", host: str = "source") -> DataFrame:
    """The documents that pass, with all their columns.

    The texts are measured once: flags are written beside the documents that
    pass the base rule; hosts are counted from the flags alone.
    """
    spark = docs.sparkSession
    path = work_path(spark, "measured")
    m = measured(docs, F.struct(*[docs[c] for c in docs.columns]), text, host)
    passed = F.when(~F.col("__base"), F.col("row"))
    m.select(passed.alias("row"), "__host", *[f"__{r}" for r in RULES]).write.parquet(path)
    return with_verdict(spark.read.schema(_flagged(m)).parquet(path)).where("__kept").select("row.*")


def _flagged(m: DataFrame) -> T.StructType:
    return T.StructType([m.schema[c] for c in ("row", "__host", *[f"__{r}" for r in RULES])])
