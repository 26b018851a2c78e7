"""Registered queries of the operators over the given tables, with SQL where it can express them."""

from __future__ import annotations

from functools import wraps

from pyspark.sql import functions as F

import corpus_pipeline
from tribuna.llm import bpe, html, jaccard, knn, linededup, mixing, packing, quality, resample, substrings, tokenfile, tokens, vectorcodes
from tribuna.llm.common import lean
from tribuna.session import prepare, read_table


def documents(spark, sf_dir):
    return read_table(spark, sf_dir, "documents")


def op1_mixing(spark, sf_dir):
    return mixing.mix(documents(spark, sf_dir)).select("doc_id", "size", "source_size", "target", "taken")


def op2_jaccard(spark, sf_dir):
    return jaccard.near_duplicates(documents(spark, sf_dir))


def op3_token_files(spark, sf_dir):
    return tokenfile.round_trip(documents(spark, sf_dir))


def op4_substrings(spark, sf_dir):
    return substrings.digests(substrings.remove_repeats(documents(spark, sf_dir)))


def op5_html(spark, sf_dir):
    return html.extract(read_table(spark, sf_dir, "pages"))


def op6_line_dedup(spark, sf_dir):
    return linededup.dedup_lines(documents(spark, sf_dir).select("doc_id", "source", "text")).select(
        "doc_id", F.col("__n_lines").alias("n_lines"), F.col("__n_removed").alias("n_removed"), F.sha2("text", 256).alias("kept_sha256")
    )


def op7_quality(spark, sf_dir):
    return quality.judge(documents(spark, sf_dir))


def op8_token_counts(spark, sf_dir):
    return tokens.count_tokens(documents(spark, sf_dir))


def op9_packing(spark, sf_dir):
    return packing.pack(documents(spark, sf_dir))


def op10_top_k(spark, sf_dir):
    return knn.top_k(read_table(spark, sf_dir, "embeddings"), F.col("id") % 100 == 0)


def op11_vector_codes(spark, sf_dir):
    vectors = read_table(spark, sf_dir, "embeddings")
    books = vectorcodes.train(vectors)
    out = vectorcodes.with_label_error(vectorcodes.encode(vectors, books, carry=["label"]), F.col("row.label"))
    sha = F.lit(books.sha256() if books else None).cast("string")
    return out.select("vec_id", "code", "error", "label_error", sha.alias("codebooks_sha256"))


def op12_bpe(spark, sf_dir):
    return bpe.encode(documents(spark, sf_dir), decoded=True).select(
        "doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256")
    )


def op13_resample(spark, sf_dir):
    drawn = resample.resample(documents(spark, sf_dir), read_table(spark, sf_dir, "benchmark"))
    return drawn.select("doc_id", "n_features", "weight", "score", "rank")


JACCARD_SQL = f"""
WITH RECURSIVE t AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS w FROM documents
), s AS (
  SELECT DISTINCT doc_id, md5(array_to_string(w[i:i + 4], ' ')) AS h
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, 2))) AS i FROM t WHERE len(w) > 0)
), n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
link AS (
  SELECT p.a, p.b FROM (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS k FROM s x JOIN s y ON x.h = y.h AND x.doc_id <> y.doc_id GROUP BY ALL) p
  JOIN n na ON na.doc_id = p.a JOIN n nb ON nb.doc_id = p.b
  WHERE 100 * p.k >= {jaccard.PERCENT} * (na.n + nb.n - p.k)
), reach AS (
  SELECT doc_id AS a, doc_id AS b FROM documents
  UNION
  SELECT r.a, l.b FROM reach r JOIN link l ON r.b = l.a
)
SELECT d.doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles, c.component_id
FROM documents d LEFT JOIN n ON n.doc_id = d.doc_id JOIN (SELECT a, min(b) AS component_id FROM reach GROUP BY a) c ON c.a = d.doc_id
"""

SUBSTRING_SQL = f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
w AS (
  SELECT rid, doc_id, i, substr(h, 2 * i + 1, {2 * substrings.LENGTH}) AS s
  FROM (SELECT rid, doc_id, h, unnest(range(0, greatest(CAST(length(h) / 2 AS BIGINT) - {substrings.LENGTH} + 1, 0))) AS i FROM d WHERE doc_id IS NOT NULL)
), gone AS (
  SELECT rid, i FROM (SELECT rid, doc_id, i, min(doc_id) OVER (PARTITION BY s) AS m FROM w) WHERE m < doc_id
), runs AS (
  SELECT rid, min(i) AS a, max(i) + {substrings.LENGTH} AS z
  FROM (SELECT rid, i, sum(CASE WHEN i <= p + {substrings.LENGTH} THEN 0 ELSE 1 END) OVER (PARTITION BY rid ORDER BY i) AS k
        FROM (SELECT rid, i, lag(i) OVER (PARTITION BY rid ORDER BY i) AS p FROM gone))
  GROUP BY rid, k
), kept AS (
  SELECT rid, a, substr(h, 2 * done + 1, 2 * (a - done)) AS part
  FROM (SELECT d.rid, h, a, coalesce(lag(z) OVER (PARTITION BY d.rid ORDER BY a), 0) AS done
        FROM d JOIN (SELECT rid, a, z FROM runs UNION ALL SELECT rid, CAST(length(h) / 2 AS BIGINT), CAST(length(h) / 2 AS BIGINT) + 1 FROM d) r USING (rid))
), texts AS (SELECT rid, string_agg(part, '' ORDER BY a) AS kept FROM kept GROUP BY rid),
sums AS (SELECT rid, sum(z - a) AS n_removed, count(*) AS n_spans FROM runs GROUP BY rid)
SELECT doc_id, CAST(length(h) / 2 AS BIGINT) AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed,
       CAST(coalesce(n_spans, 0) AS BIGINT) AS n_spans, sha256(unhex(coalesce(kept, ''))) AS kept_sha256
FROM d LEFT JOIN texts USING (rid) LEFT JOIN sums USING (rid)
"""

LINE_SQL = f"""
WITH lines AS (
  SELECT doc_id, source, pos, trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS line
  FROM (SELECT doc_id, source, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS pos FROM documents)
  WHERE regexp_matches(line, '[^\\x20\\x09-\\x0D]')
), spread AS (
  SELECT line, min(doc_id) AS keeper FROM lines GROUP BY line
  HAVING count(DISTINCT source) + max(CAST(source IS NULL AS int)) >= {linededup.MIN_SITES}
), cut AS (
  SELECT l.doc_id, l.pos FROM lines l JOIN spread s ON l.line = s.line WHERE l.doc_id IS DISTINCT FROM s.keeper
), cuts AS (SELECT doc_id, list(pos) AS cut FROM cut GROUP BY doc_id),
parts AS (
  SELECT d.doc_id, d.text, string_split(d.text, chr(10)) AS old, coalesce(c.cut, []) AS cut
  FROM documents d LEFT JOIN cuts c ON d.doc_id IS NOT DISTINCT FROM c.doc_id
)
SELECT doc_id, CAST(coalesce(len(old), 0) AS BIGINT) AS n_lines, CAST(len(cut) AS BIGINT) AS n_removed,
       CASE WHEN text IS NOT NULL THEN sha256(coalesce(array_to_string(
         [old[i] FOR i IN range(1, len(old) + 1) IF NOT list_contains(cut, i)], chr(10)), '')) END AS kept_sha256
FROM parts
"""

MEASURE_SQL = """
  SELECT *, len(w) AS n_words, len(regexp_replace(t, '[\\x20\\x09-\\x0D]+', '', 'g')) AS word_chars,
         len(regexp_extract_all(t, '[#*$%&|<>]')) AS n_symbols,
         len(lines) AS n_lines, len(lines) - len(list_distinct(lines)) AS n_dup_lines
  FROM (SELECT *, regexp_extract_all(t, '[^\\x20\\x09-\\x0D]+') AS w,
               [x FOR x IN string_split(t, chr(10)) IF regexp_matches(x, '[^\\x20\\x09-\\x0D]')] AS lines
        FROM (SELECT *, coalesce(text, '') AS t, row_number() OVER () AS rid FROM documents))
"""

WINDOW_SQL = """
  SELECT rid, count(DISTINCT pos + k) AS n_repeat_words
  FROM (SELECT rid, pos, count(*) OVER (PARTITION BY rid, win) AS n
        FROM (SELECT rid, i AS pos, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS win
              FROM (SELECT rid, w, unnest(range(1, len(w) - 1)) AS i FROM m WHERE len(w) > 2))),
       (SELECT unnest([0, 1, 2]) AS k)
  WHERE n > 1 GROUP BY rid
"""


def _shrunk(rule: str) -> str:
    return f"(f_{rule} + a_{rule}) / (n + a_{rule} + b_{rule})"


def _prior(rule: str) -> str:
    return f"""
  , spread_{rule} AS (
    SELECT m, CASE WHEN between_ > 0 THEN greatest(m * (1 - m) / between_ - 1, 1.0) ELSE 1e9 END AS strength
    FROM (SELECT m, CASE WHEN 1 - nn / (n * n) > 0 THEN (q / n - m * m - m * (1 - m) * (h - 1) / n) / (1 - nn / (n * n)) ELSE 0 END AS between_
          FROM (SELECT sum(n)::double AS n, count(*) AS h, sum(n::double * n) AS nn, sum(f_{rule})::double / sum(n) AS m,
                       sum(f_{rule}::double * f_{rule} / n) AS q FROM hosts)))
  , prior_{rule} AS (SELECT m * strength AS a_{rule}, (1 - m) * strength AS b_{rule} FROM spread_{rule})"""


QUALITY_RULES = ("base", "symbols", "lines")
QUALITY_SQL = f"""
WITH m AS ({MEASURE_SQL}), r AS ({WINDOW_SQL}),
f AS (
  SELECT *, NOT base AND 100 * n_symbols > 20 * word_chars AS symbols, NOT base AND 100 * n_dup_lines > 50 * n_lines AS lines_
  FROM (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base
        FROM (SELECT m.* EXCLUDE (lines), coalesce(r.n_repeat_words, 0) AS n_repeat_words FROM m LEFT JOIN r USING (rid)))
), hosts AS (
  SELECT source, count(*) AS n, sum(base::int) AS f_base, sum(symbols::int) AS f_symbols, sum(lines_::int) AS f_lines FROM f GROUP BY source
){"".join(_prior(r) for r in QUALITY_RULES)}
, verdict AS (
  SELECT source, greatest({", ".join(_shrunk(r) for r in QUALITY_RULES)}) > 0.6 AS rejected,
         {_shrunk("symbols")} > 0.01 AS watch_symbols, {_shrunk("lines")} > 0.01 AS watch_lines
  FROM hosts, {", ".join(f"prior_{r}" for r in QUALITY_RULES)}
)
SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(word_chars AS BIGINT) AS word_chars, CAST(n_symbols AS BIGINT) AS n_symbols,
       CAST(n_dup_lines AS BIGINT) AS n_dup_lines, CAST(n_repeat_words AS BIGINT) AS n_repeat_words, base AS base_failed,
       NOT base AND NOT rejected AND NOT (symbols AND watch_symbols) AND NOT (lines_ AND watch_lines) AS kept
FROM f JOIN verdict ON verdict.source IS NOT DISTINCT FROM f.source
"""

KNN_SQL = f"""
WITH v AS (
  SELECT vec_id, [CAST(floor(e::double * {knn.SCALE}) AS BIGINT) FOR e IN embedding] AS x
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len([e FOR e IN embedding IF e IS NULL OR NOT isfinite(e)]) = 0
), s AS (
  SELECT q.vec_id AS query_id, v.vec_id,
         CAST(coalesce(list_sum([p[1] * p[2] FOR p IN list_zip(q.x, v.x)]), 0) AS BIGINT) AS score
  FROM v q, v WHERE q.vec_id % 100 = 0 AND q.vec_id <> v.vec_id AND len(q.x) = len(v.x)
)
SELECT query_id, CAST(rank AS INT) AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s) WHERE rank <= {knn.K}
"""



def _assigned(name: str, books: str) -> str:
    return f"""
{name} AS MATERIALIZED (
  SELECT rid, p, any_value(y) AS y, arg_min(e, k) AS e, min(k[1]) AS dist
  FROM (SELECT rid, p, y, e, [list_sum([(q[1] - q[2]) * (q[1] - q[2]) FOR q IN list_zip(y, c)]), e] AS k FROM parts JOIN {books} USING (p))
  GROUP BY rid, p
)"""


def _moved(name: str, assigned: str, books: str) -> str:
    return f"""
{name} AS MATERIALIZED (
  SELECT p, e, coalesce(m, c) AS c
  FROM {books} LEFT JOIN (
    SELECT p, e, list(CAST((s - ((s % n) + n) % n) // n AS BIGINT) ORDER BY i) AS m
    FROM (SELECT p, e, i, sum(y[i]) AS s, count(*) AS n FROM {assigned}, (SELECT unnest(range(1, d + 1)) AS i FROM width) GROUP BY p, e, i)
    GROUP BY p, e
  ) USING (p, e)
)"""


CODES_SQL = f"""
WITH v AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY vec_id) AS rid, vec_id, label, [CAST(floor(e::double * 256) AS BIGINT) FOR e IN embedding] AS x
  FROM embeddings WHERE embedding IS NOT NULL AND len([e FOR e IN embedding IF e IS NULL OR NOT isfinite(e)]) = 0
), width AS (SELECT CAST(len(x) / 16 AS BIGINT) AS d FROM v WHERE rid = 1),
parts AS MATERIALIZED (
  SELECT rid, p, x[p * d + 1 : (p + 1) * d] AS y FROM (SELECT rid, x, d, unnest(range(0, 16)) AS p FROM v, width)
), b0 AS MATERIALIZED (SELECT p, rid - 1 AS e, y AS c FROM parts WHERE rid <= 64),{_assigned("a0", "b0")},{_moved("b1", "a0", "b0")},{_assigned("a1", "b1")},{_moved("b2", "a1", "b1")},{_assigned("a2", "b2")},
coded AS (SELECT rid, string_agg(printf('%02x', e), '' ORDER BY p) AS code, sum(dist) AS error FROM a2 GROUP BY rid),
sha AS (SELECT sha256(string_agg(array_to_string(c, ','), ',' ORDER BY p, e)) AS h FROM b2)
SELECT vec_id, code, CAST(error AS BIGINT) AS error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, h AS codebooks_sha256
FROM v JOIN coded USING (rid), sha
"""

#: CRC-32 has no function in SQL: the table of its polynomial, then one step a byte over the bytes of each distinct word.
RESAMPLE_SQL = """
WITH RECURSIVE bits AS (
  SELECT CAST(i AS BIGINT) AS i, CAST(i AS BIGINT) AS c, 0 AS k FROM range(0, 256) t(i)
  UNION ALL SELECT i, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, k + 1 FROM bits WHERE k < 8
), crc AS MATERIALIZED (SELECT list(c ORDER BY i) AS t FROM bits WHERE k = 8),
d AS MATERIALIZED (
  SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
), q AS MATERIALIZED (
  SELECT unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS w FROM benchmark
), f AS MATERIALIZED (SELECT rid, unnest(w) AS w FROM d),
words AS (SELECT DISTINCT w FROM (SELECT w FROM f UNION ALL SELECT w FROM q)),
bucket AS MATERIALIZED (
  SELECT w, xor(list_reduce(list_prepend(4294967295, [CAST('0x' || substr(h, 2 * i - 1, 2) AS BIGINT) FOR i IN range(1, CAST(length(h) / 2 AS BIGINT) + 1)]),
           lambda c, b: xor(c >> 8, t[CAST(xor(c, b) & 255 AS BIGINT) + 1])), 4294967295) % 10000 AS b
  FROM (SELECT w, hex(encode(w)) AS h FROM words), crc
), s AS (SELECT b, count(*) AS s FROM f JOIN bucket USING (w) GROUP BY b),
t AS (SELECT b, count(*) AS t FROM q JOIN bucket USING (w) GROUP BY b),
gain AS (
  SELECT b, CAST(floor(1000 * ln((coalesce(t, 0) + 1)::double * ((SELECT count(*) FROM f) + 10000) / ((s + 1)::double * ((SELECT count(*) FROM q) + 10000)))) AS BIGINT) AS g
  FROM s LEFT JOIN t USING (b)
), weighed AS (
  SELECT rid, count(*) AS n, CAST(sum(g) AS BIGINT) AS g FROM f JOIN bucket USING (w) JOIN gain USING (b) GROUP BY rid
), scored AS (
  SELECT doc_id, coalesce(n, 0) AS n, CASE WHEN n IS NULL THEN 0 ELSE (g - ((g % n) + n) % n) // n END AS weight,
         CAST('0x' || substr(sha256('2024:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 8) AS BIGINT) AS h
  FROM d LEFT JOIN weighed USING (rid)
), keyed AS (SELECT doc_id, n, weight, weight + CAST(floor(-1000 * ln(-ln((h + 0.5::double) / 4294967296))) AS BIGINT) AS score FROM scored),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY n >= 20 ORDER BY score DESC, doc_id NULLS LAST) AS r, count(*) FILTER (n >= 20) OVER () AS able FROM keyed
)
SELECT doc_id, CAST(n AS BIGINT) AS n_features, CAST(weight AS BIGINT) AS weight, CAST(score AS BIGINT) AS score,
       CASE WHEN n >= 20 AND r <= 10 * able // 100 THEN CAST(r AS BIGINT) END AS rank
FROM ranked
"""

QUERIES = {
    "op1_mixing": (op1_mixing, None),
    "op2_jaccard": (op2_jaccard, JACCARD_SQL),
    "op3_token_files": (op3_token_files, None),
    "op4_substrings": (op4_substrings, SUBSTRING_SQL),
    "op5_html": (op5_html, None),
    "op6_line_dedup": (op6_line_dedup, LINE_SQL),
    "op7_quality": (op7_quality, QUALITY_SQL),
    "op8_token_counts": (op8_token_counts, None),
    "op9_packing": (op9_packing, None),
    "op10_top_k": (op10_top_k, KNN_SQL),
    "op11_vector_codes": (op11_vector_codes, CODES_SQL),
    "op12_bpe": (op12_bpe, None),
    "op13_resample": (op13_resample, RESAMPLE_SQL),
    "pipeline": (corpus_pipeline.run, corpus_pipeline.ORACLE_SQL),
}


def prepared(fn):
    @wraps(fn)
    def run(spark, sf_dir):
        prepare(spark)
        lean(spark)
        return fn(spark, sf_dir)

    return run


def llm_queries() -> dict:
    """Name -> (callable, SQL or None)."""
    return {name: (prepared(fn), sql) for name, (fn, sql) in QUERIES.items()}
