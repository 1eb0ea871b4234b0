"""One query per operator over its whole table, with SQL checks where SQL can say it."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from factgraph.llm import (
    byte_cnn_language,
    compression_quality,
    decontaminate,
    fill_in_middle,
    host_rules,
    near_dedup,
    pu_toxicity,
    rank_bpe,
    sampled_encoding,
    substring_dedup,
    token_alignment,
    token_counts,
    token_store,
)
from factgraph.llm.common import fold, table
from factgraph.llm.registry import CHECKS, QUERIES
from factgraph.session import shared_dir


def query(name: str, sql: str | None = None):
    def register(fn):
        QUERIES[name] = fn
        if sql is not None:
            CHECKS[name] = sql
        return fn

    return register


@query(
    "op1_benchmark_decontamination",
    """
WITH d AS (
  SELECT doc_id, coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), []) AS ws FROM documents),
b AS (
  SELECT item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS ws FROM benchmark),
p AS (SELECT item_id, ws, least(len(ws), 10) AS k, unnest(range(1, greatest(len(ws) - 8, 2))) AS i FROM b WHERE len(ws) > 0),
w AS (SELECT DISTINCT item_id, k, array_to_string(ws[i:i + k - 1], ' ') AS win FROM p),
k AS (SELECT DISTINCT k FROM w),
s AS (SELECT doc_id, ws, k, unnest(range(1, len(ws) - k + 2)) AS i FROM d, k WHERE len(ws) >= k),
g AS (SELECT doc_id, k, i, array_to_string(ws[i:i + k - 1], ' ') AS win FROM s),
h AS (SELECT doc_id, k, i, item_id FROM g JOIN w USING (k, win)),
c AS (SELECT doc_id, count(DISTINCT pos) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + k)) AS pos FROM h) GROUP BY doc_id),
i AS (
  SELECT doc_id, count(*) AS n_items, sha256(string_agg(item, ',' ORDER BY item)) AS items_sha256
  FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM h) GROUP BY doc_id)
SELECT d.doc_id, len(ws) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  coalesce(items_sha256, sha256('')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN c USING (doc_id) LEFT JOIN i USING (doc_id)
""",
)
def op1_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return rows.drop("text_hash")


@query(
    "op2_near_dedup",
    """
WITH RECURSIVE d AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[ \\t\\n\\x0B\\f\\r]+'), lambda x: x <> '') AS ws FROM documents),
g AS (SELECT doc_id, least(len(ws), 5) AS k, ws, unnest(range(1, greatest(len(ws) - 3, 2))) AS i FROM d WHERE len(ws) > 0),
s AS (SELECT DISTINCT doc_id, array_to_string(ws[i:i + k - 1], ' ') AS sh FROM g),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.sh = b.sh AND a.doc_id < b.doc_id GROUP BY 1, 2),
l AS (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 85 * (x.n + y.n - c)),
e AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
r(a, b) AS (SELECT a, b FROM e UNION SELECT r.a, e.b FROM r JOIN e ON r.b = e.a),
c AS (SELECT a AS doc_id, min(b) AS m FROM r GROUP BY a)
SELECT d.doc_id, coalesce(n, 0) AS n_shingles, least(d.doc_id, coalesce(m, d.doc_id)) AS component_id,
  d.doc_id = least(d.doc_id, coalesce(m, d.doc_id)) AS kept
FROM d LEFT JOIN n USING (doc_id) LEFT JOIN c USING (doc_id)
""",
)
def op2_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(table(spark, sf_dir, "documents"), percent=85)


@query(
    "op3_substring_dedup",
    """
WITH d AS (
  SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[ \\t\\n\\x0B\\f\\r]+'), lambda x: x <> '') AS ws FROM documents),
w AS (SELECT doc_id, ws, unnest(range(1, len(ws) - 48)) AS i FROM d WHERE len(ws) >= 50),
h AS (SELECT doc_id, i, md5(array_to_string(ws[i:i + 49], ' ')) AS h FROM w),
f AS (SELECT h, min(doc_id) AS a FROM h GROUP BY h HAVING min(doc_id) < max(doc_id)),
g AS (SELECT doc_id, i FROM h JOIN f USING (h) WHERE a < doc_id),
x AS (SELECT doc_id, list(DISTINCT pos) AS gone FROM (SELECT doc_id, unnest(range(i, i + 50)) AS pos FROM g) GROUP BY doc_id),
v AS (SELECT d.doc_id, unnest(ws) AS word, generate_subscripts(ws, 1) AS pos FROM d JOIN x USING (doc_id)),
q AS (SELECT doc_id, unnest(gone) AS pos FROM x),
k AS (
  SELECT doc_id, string_agg(word, ' ' ORDER BY pos) AS kept, count(*) AS n_kept
  FROM v ANTI JOIN q USING (doc_id, pos) GROUP BY doc_id)
SELECT d.doc_id, len(ws) AS n_words, CASE WHEN x.doc_id IS NULL THEN 0 ELSE len(ws) - coalesce(n_kept, 0) END AS n_removed,
  sha256(CASE WHEN x.doc_id IS NULL THEN array_to_string(ws, ' ') ELSE coalesce(kept, '') END) AS kept_sha256
FROM d LEFT JOIN x USING (doc_id) LEFT JOIN k USING (doc_id)
""",
)
def op3_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.report(table(spark, sf_dir, "documents"))


@query("op4_sampled_encoding")
def op4_sampled_encoding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sampled_encoding.segmentations(table(spark, sf_dir, "documents"))


@query(
    "op5_host_rules",
    """
WITH d AS (SELECT doc_id, source, coalesce(text, '') AS t FROM documents),
w AS (SELECT *, list_filter(regexp_split_to_array(t, '[ \\t\\n\\x0B\\f\\r]+'), lambda x: x <> '') AS ws FROM d),
g AS (SELECT doc_id, unnest(range(1, len(ws) - 1)) AS i, ws FROM w WHERE len(ws) > 2),
h AS (SELECT doc_id, i, [ws[i], ws[i + 1], ws[i + 2]] AS gram FROM g),
r AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, gram) AS n FROM h),
p AS (SELECT doc_id, count(DISTINCT i + o) AS n_repeat_words FROM r, (SELECT unnest([0, 1, 2]) AS o) WHERE n > 1 GROUP BY doc_id),
m AS (
  SELECT doc_id, source, len(ws) AS n_words, length(regexp_replace(t, '[ \\t\\n\\x0B\\f\\r]', '', 'g')) AS word_chars,
    length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS n_symbols,
    len(list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^ \\t\\n\\x0B\\f\\r]')))
      - len(list_distinct(list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^ \\t\\n\\x0B\\f\\r]')))) AS n_dup_lines
  FROM w),
j AS (
  SELECT m.*, coalesce(n_repeat_words, 0) AS n_repeat_words,
    n_words < 50 OR 100 * coalesce(n_repeat_words, 0) > 50 * n_words AS base_failed
  FROM m LEFT JOIN p USING (doc_id)),
s AS (SELECT source, count(*) AS n, sum(base_failed::INT) AS f FROM j GROUP BY source),
q AS (SELECT sum(f) / sum(n) AS p, sum(f * (f / n)) / sum(n) AS q FROM s),
b AS (SELECT p, greatest(q - p * p, 0.0) AS v FROM q),
z AS (SELECT p, CASE WHEN v <= 1e-12 THEN 1e6 ELSE least(greatest(p * (1 - p) / v - 1, 1.0), 1e6) END AS s FROM b)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND (s.f + z.p * z.s) / (s.n + z.s) <= 0.5 AS kept
FROM j JOIN s ON j.source IS NOT DISTINCT FROM s.source CROSS JOIN z
""",
)
def op5_host_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = host_rules.host_rules(table(spark, sf_dir, "documents"))
    return rows.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


@query("op6_compression_quality")
def op6_compression_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = compression_quality.fit(docs, labels, fold("doc_id", 4) != 2)
    rows = compression_quality.scores(docs, model)
    return rows.select("doc_id", (fold("doc_id", 4) == 2).alias("held_out"), "score", "predicted")


@query("op7_language_id")
def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    network = byte_cnn_language.fit(docs, fold("doc_id", 5) != 0)
    rows = byte_cnn_language.languages(docs, network)
    return rows.select("doc_id", (fold("doc_id", 5) == 0).alias("held_out"), "lang_pred", "score")


@query("op9_toxicity")
def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = pu_toxicity.fit(docs, labels, fold("doc_id", 5) != 0)
    rows = pu_toxicity.scores(docs, model)
    return rows.select("doc_id", (fold("doc_id", 5) == 0).alias("held_out"), "score", "predicted")


@query("op8_token_files")
def op8_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = f"{shared_dir(spark).rstrip('/')}/factgraph-llm/store-{uuid.uuid4().hex}"
    token_store.write_store(table(spark, sf_dir, "documents"), folder)
    return token_store.read_store(spark, folder, with_ids=False).select("doc_id", "start", "n_tokens", "ids_crc32")


@query("op10_token_counts")
def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(table(spark, sf_dir, "documents"))


@query("op11_token_alignment")
def op11_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_alignment.link_report(table(spark, sf_dir, "documents"))


@query(
    "op12_fill_in_middle",
    """
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\\n]*\\n|[^\\n]+') AS ls,
    sha256('7:' || coalesce(doc_id::VARCHAR, '')) AS h FROM documents),
h AS (
  SELECT doc_id, t, ls, len(ls) AS n, ('0x' || h[1:8])::BIGINT % (len(ls) + 1) AS c1, ('0x' || h[9:16])::BIGINT % (len(ls) + 1) AS c2,
    ('0x' || h[17:24])::BIGINT % 100 AS r, ('0x' || h[25:32])::BIGINT % 100 AS s FROM d),
f AS (
  SELECT doc_id, t, n, CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR r >= 100 THEN 'plain'
    WHEN s < 50 THEN 'spm' ELSE 'psm' END AS form,
    array_to_string(ls[1:least(c1, c2)], '') AS p, array_to_string(ls[least(c1, c2) + 1:greatest(c1, c2)], '') AS m,
    array_to_string(ls[greatest(c1, c2) + 1:n], '') AS s FROM h)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(p) END AS prefix_chars, CASE WHEN form <> 'plain' THEN length(m) END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
  sha256(t) AS restored_sha256
FROM f
""",
)
def op12_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = fill_in_middle.filled(table(spark, sf_dir, "documents"))
    return rows.select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"),
        F.sha2(fill_in_middle.restored("output", "form"), 256).alias("restored_sha256"),
    )


@query("op13_rank_bpe")
def op13_rank_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = rank_bpe.round_trip(table(spark, sf_dir, "documents"))
    return rows.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))
