"""Registered queries of the training-data operators: each applies its operator with
production parameters to the whole of its table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from aerolytics.llm import (decontaminate, html_extract, importance, line_dedup, ngram_join, packing, quality, secrets, sharding,
                            token_counts, toxicity, url_filter, vector_codes)
from aerolytics.llm.common import table


def vocabulary(name: str) -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


def split_pattern() -> str:
    import public_tokenizers
    return public_tokenizers.PATTERN


def op1_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.find_secrets(table(spark, sf_dir, "documents"),
                                 vocabulary("byte_bpe_50k.tiktoken"), split_pattern())

    def joined(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(
            ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")

    def count(kind):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    base = F.filter("spans", lambda s: s["kind"] != "random")
    return found.select("doc_id", count("assign"), count("access"), count("hex"),
                        F.sha2(joined(base), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans"),
                        count("random"))


def op2_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).select(
        "doc_id", "item_id", F.round("similarity", 9).alias("similarity"), "start_word", "n_words")


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    lengths = token_counts.token_lengths(table(spark, sf_dir, "documents"),
                                         vocabulary("byte_bpe_50k.tiktoken"), split_pattern())
    return token_counts.length_histogram(lengths)


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = line_dedup.row_keys(table(spark, sf_dir, "documents"), "doc_id")
    # which of several earlier lines is named as the match may depend on the partitioning
    return line_dedup.find_duplicate_lines(docs).select("doc_id", "line_no", "n_words")


def op5_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    return (html_extract.extract_main_text(pages, weights=html_extract.fit_weights(pages))
            .withColumn("n_chars", F.length("text").cast("long")))


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    return toxicity.score_documents(docs, model).select(
        "doc_id", F.coalesce(toxicity.fold(F.col("doc_id")) == 0, F.lit(False)).alias("held_out"),
        "score", "predicted",
        F.array_join(F.transform("spans", lambda s: F.concat_ws(
            ":", s["start"].cast("string"), s["end"].cast("string"))), ",").alias("spans"))


def op7_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = url_filter.train(url_filter.LABELLED_URLS)
    return url_filter.judge_urls(table(spark, sf_dir, "pages"), model, url_filter.RULES).select(
        "page_id", "host", "path", "rule", "verdict", F.round("score", 9).alias("score"))


def op8_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.link_components(table(spark, sf_dir, "documents"))


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"), vocabulary("word_bpe_49k.json"))


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_filter(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept")


def op11_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return importance.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op12_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.coalesce("text", F.lit(""))
    return sharding.shard_documents(table(spark, sf_dir, "documents")).select(
        "doc_id", (F.octet_length(text) + 8).cast("long").alias("size"), F.crc32(text).alias("text_crc32"),
        F.lit(sharding.LAW).alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_codes.compress_vectors(table(spark, sf_dir, "embeddings"))


QUERIES = {f.__name__: f for f in (op1_secrets, op2_decontaminate, op3_token_counts, op4_line_dedup, op5_main_text, op6_toxicity,
                                   op7_url_filter, op8_ngram_join, op9_packing, op10_quality, op11_importance, op12_sharding, op13_vector_codes)}
#: the same rules in DuckDB: measures, bucket counts, merged quartiles, fences
OP10_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, lang, source, coalesce(text, '') AS text FROM documents),
w AS (SELECT r, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS w,
             list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l FROM d),
pos AS (SELECT r, w, unnest(range(len(w) - 2)) AS i FROM w WHERE len(w) >= 3),
tri AS (SELECT r, i, w[i + 1] AS a, w[i + 2] AS b, w[i + 3] AS c FROM pos),
again AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, a, b, c) AS n FROM tri) WHERE n > 1),
covered AS (SELECT r, count(DISTINCT j) AS n FROM (SELECT r, i + unnest([0, 1, 2]) AS j FROM again) GROUP BY r),
m AS (SELECT d.r, d.doc_id, d.lang, d.source, len(w.w)::BIGINT AS n_words,
             coalesce(list_sum(list_transform(w.w, lambda x: length(x))), 0)::BIGINT AS word_chars,
             (length(d.text) - length(regexp_replace(d.text, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
             len(w.l)::BIGINT AS n_lines, (len(w.l) - len(list_distinct(w.l)))::BIGINT AS n_dup_lines,
             coalesce(covered.n, 0)::BIGINT AS n_repeat_words
      FROM d JOIN w USING (r) LEFT JOIN covered USING (r)),
f AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
             coalesce(n_symbols * 1000 // n_words, 0) AS v1, coalesce(word_chars * 100 // n_words, 0) AS v2,
             coalesce(n_dup_lines * 1000 // n_lines, 0) AS v3, coalesce(n_repeat_words * 1000 // n_words, 0) AS v4,
             coalesce((n_symbols + 1) * 1000 // n_words, 0) AS e1, coalesce((n_dup_lines + 1) * 1000 // n_lines, 0) AS e3,
             coalesce((n_repeat_words + 6) * 1000 // n_words, 0) AS e4 FROM m),
x AS (SELECT lang, source, k, v // p * p AS v
      FROM (SELECT *, (10 ** greatest(length(v::VARCHAR) - 3, 0))::BIGINT AS p
            FROM (SELECT lang, source, unnest([1, 2, 3, 4]) AS k, unnest([e1, v2, e3, e4]) AS v FROM f WHERE NOT base_failed))),
lv AS (SELECT 3 AS level, lang, source, k, v FROM x UNION ALL SELECT 2, lang, NULL, k, v FROM x
       UNION ALL SELECT 1, NULL, NULL, k, v FROM x),
rk AS (SELECT *, row_number() OVER (PARTITION BY level, lang, source, k ORDER BY v) AS n,
              count(*) OVER (PARTITION BY level, lang, source, k) AS al FROM lv),
qt AS (SELECT level, lang, source, k, max(al) AS docs, min(CASE WHEN 4 * n >= al THEN v END) AS q1,
              min(CASE WHEN 4 * n >= 3 * al THEN v END) AS q3 FROM rk GROUP BY ALL),
fe AS (SELECT level, lang, source, k, docs, q3 + 8 * greatest(q3 - q1, 1) AS high,
              CASE WHEN k = 2 THEN q1 - 8 * greatest(q3 - q1, 1) ELSE -1 END AS low FROM qt),
th AS (SELECT a.lang, a.source, a.k,
              CASE WHEN a.docs >= 200 THEN a.low WHEN b.docs >= 200 THEN b.low ELSE c.low END AS low,
              CASE WHEN a.docs >= 200 THEN a.high WHEN b.docs >= 200 THEN b.high ELSE c.high END AS high
       FROM (SELECT * FROM fe WHERE level = 3) a
       JOIN (SELECT * FROM fe WHERE level = 2) b ON a.lang IS NOT DISTINCT FROM b.lang AND a.k = b.k
       JOIN (SELECT * FROM fe WHERE level = 1) c ON a.k = c.k),
bad AS (SELECT DISTINCT f.r FROM f JOIN th ON f.lang IS NOT DISTINCT FROM th.lang AND f.source IS NOT DISTINCT FROM th.source
        WHERE NOT CASE th.k WHEN 1 THEN f.v1 WHEN 2 THEN f.v2 WHEN 3 THEN f.v3 ELSE f.v4 END BETWEEN th.low AND th.high)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND bad.r IS NULL AS kept
FROM f LEFT JOIN bad USING (r)
"""

#: item-sized windows on every alignment of a shared shingle, compared as multisets
OP2_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(lower(text), '[^\x20\x09-\x0D]+') AS w
           FROM documents),
b AS (SELECT item_id, regexp_extract_all(lower(text), '[^\x20\x09-\x0D]+') AS w FROM benchmark),
g AS (SELECT r, p, array_to_string(w[p + 1:p + 5], ' ') AS s
      FROM (SELECT r, w, unnest(range(len(w) - 4)) AS p FROM d WHERE len(w) >= 5)),
i AS (SELECT item_id, l, q, array_to_string(w[q + 1:q + 5], ' ') AS s
      FROM (SELECT item_id, w, len(w) AS l, unnest(range(len(w) - 4)) AS q FROM b WHERE len(w) >= 5)),
x AS (SELECT DISTINCT r, item_id, l, p - q AS off0 FROM g JOIN i USING (s)),
win AS (SELECT DISTINCT x.r, item_id, l, greatest(off0, 0) AS a, least(off0 + l, len(w)) AS z FROM x JOIN d USING (r)),
ws AS (SELECT win.r, win.item_id, l, a, z, g.s, count(*) AS c FROM win JOIN g ON g.r = win.r AND g.p >= a AND g.p <= z - 5
       GROUP BY ALL),
ic AS (SELECT item_id, s, count(*) AS c FROM i GROUP BY ALL),
o AS (SELECT r, item_id, l, a, z, sum(least(ws.c, ic.c)) AS o FROM ws JOIN ic USING (item_id, s) GROUP BY ALL),
sim AS (SELECT r, item_id, a, z - a AS n, o / (z - a - 4 + l - 4 - o) AS j FROM o),
best AS (SELECT doc_id, item_id, j, a, n, row_number() OVER (PARTITION BY doc_id, item_id ORDER BY j DESC, a, n) AS k
         FROM sim JOIN d USING (r) WHERE j >= 0.8)
SELECT doc_id, item_id, round(j, 9)::DOUBLE AS similarity, a::INTEGER AS start_word, n::INTEGER AS n_words
FROM best WHERE k = 1
"""

#: all pairs of distinct line sets of compatible sizes
OP4_SQL = r"""
WITH d AS (SELECT doc_id, string_split(lower(text), chr(10)) AS l FROM documents),
ln AS (SELECT doc_id, i - 1 AS line_no, list_sort(list_distinct(regexp_extract_all(l[i], '[^\x20\x09-\x0D]+'))) AS s
       FROM (SELECT doc_id, l, unnest(range(1, len(l) + 1)) AS i FROM d)),
t AS (SELECT doc_id, line_no, s, len(s) AS n,
             row_number() OVER (PARTITION BY s ORDER BY doc_id, line_no) AS k FROM ln WHERE len(s) > 0),
c AS (SELECT * FROM t WHERE k = 1),
near AS (SELECT DISTINCT b.doc_id, b.line_no FROM c a JOIN c b
         ON (a.doc_id, a.line_no) < (b.doc_id, b.line_no) AND 100 * least(a.n, b.n) >= 80 * greatest(a.n, b.n)
         AND 180 * len(list_intersect(a.s, b.s)) >= 80 * (a.n + b.n))
SELECT doc_id, line_no::INTEGER AS line_no, n::INTEGER AS n_words FROM t
WHERE k > 1 OR (doc_id, line_no) IN (SELECT (doc_id, line_no) FROM near)
"""

#: shared shingles of all pairs, then the reachable documents
OP8_SQL = r"""
WITH RECURSIVE d AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
g AS (SELECT DISTINCT r, CASE WHEN len(w) >= 5 THEN array_to_string(w[p:p + 4], ' ') ELSE array_to_string(w, ' ') END AS s
      FROM (SELECT r, w, unnest(range(1, greatest(len(w) - 3, 2))) AS p FROM d WHERE len(w) > 0)),
n AS (SELECT r, count(*) AS n FROM g GROUP BY r),
o AS (SELECT a.r AS a, b.r AS b, count(*) AS o FROM g a JOIN g b ON a.s = b.s AND a.r <> b.r GROUP BY ALL),
e AS (SELECT a, b FROM o JOIN n x ON x.r = a JOIN n y ON y.r = b WHERE 100 * o >= 80 * (x.n + y.n - o)),
reach AS (SELECT r, r AS m FROM d UNION SELECT reach.r, e.b FROM reach JOIN e ON e.a = reach.m),
low AS (SELECT reach.r, min(d.doc_id) AS component_id FROM reach JOIN d ON d.r = reach.m GROUP BY reach.r)
SELECT doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, component_id FROM d JOIN low USING (r) LEFT JOIN n USING (r)
"""

def _op13_sql(rounds: int = 4, parts: int = 4, entries: int = 256) -> str:
    """The rounds written out: distances of all parts to all entries, floored means."""
    def nearest(name: str, book: str) -> str:
        return f"""{name} AS MATERIALIZED (SELECT r, part, arg_min(entry, (d, entry)) AS entry, min(d) AS d FROM (
  SELECT p.r, part, b.entry, list_sum(list_transform(range(1, len(p.v) + 1), lambda i: (p.v[i] - b.v[i]) * (p.v[i] - b.v[i])))::BIGINT AS d
  FROM p JOIN {book} b USING (part)) GROUP BY r, part)"""

    steps = []
    for k in range(rounds):
        steps.append(nearest(f"a{k}", f"b{k}"))
        steps.append(f"""b{k + 1} AS MATERIALIZED (SELECT b.part, b.entry, coalesce(m.v, b.v) AS v FROM b{k} b LEFT JOIN (
  SELECT part, entry, list(v ORDER BY i) AS v FROM (
    SELECT a.part, a.entry, i, floor(sum(p.v[i])::DOUBLE / count(*))::BIGINT AS v
    FROM a{k} a JOIN p USING (r, part), (SELECT unnest(range(1, len(p.v) + 1)) AS i) u GROUP BY ALL) GROUP BY ALL) m USING (part, entry))""")
    steps.append(nearest("z", f"b{rounds}"))
    return f"""
WITH e AS (SELECT vec_id, label, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)::BIGINT) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
n AS (SELECT *, row_number() OVER (ORDER BY vec_id NULLS LAST, v) AS r FROM e),
p AS MATERIALIZED (SELECT r, part, v[part * len(v) // {parts} + 1:(part + 1) * len(v) // {parts}] AS v
  FROM (SELECT r, v, unnest(range({parts})) AS part FROM n)),
b0 AS MATERIALIZED (SELECT part, r - 1 AS entry, v FROM p WHERE r <= {entries}),
{", ".join(steps)},
c AS (SELECT r, string_agg(printf('%02x', entry), '' ORDER BY part) AS code, sum(d)::BIGINT AS error FROM z GROUP BY r),
s AS (SELECT sha256(string_agg(array_to_string(v, ','), ',' ORDER BY part, entry)) AS h FROM b{rounds})
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error, h AS codebooks_sha256
FROM c JOIN n USING (r), s
"""


ORACLES: dict[str, str] = {"op13_vector_codes": _op13_sql(), "op2_decontaminate": OP2_SQL, "op4_line_dedup": OP4_SQL, "op8_ngram_join": OP8_SQL,
                           "op10_quality": OP10_SQL}
