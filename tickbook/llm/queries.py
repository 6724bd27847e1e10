"""Registered queries opN_* with their production parameters, and their SQL."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import chat, decontam, dedup, divergence, html, lm, negatives, packing, quality, rules, toxicity, treejoin, urls
from . import text as T

TOKENIZER = "word_bpe_49k.json"
CAPACITY = 2048
CONTROL_CASE = -7           # conversation that spells the template's own marks


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    T.prepare(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_path() -> str:
    return public_tokenizers.path(TOKENIZER)


def _held(buckets: int, which: int):
    return F.coalesce(T.id_bucket("doc_id", buckets) == which, F.lit(False))


def op1_quality_classifier(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = quality.classify(docs, table(spark, sf_dir, "labels"), T.id_bucket("_id", 4) != 2, threshold=0.7)
    return out.select("doc_id", _held(4, 2).alias("held_out"), F.col("_score").alias("score"),
                      F.col("_predicted").alias("predicted"))


def op2_url_filter(spark, sf_dir):
    return urls.filter_urls(table(spark, sf_dir, "pages"))


def op3_best_fit_packing(spark, sf_dir):
    return packing.pack(table(spark, sf_dir, "documents"), tokenizer_path(), CAPACITY, end_id=0)


def op4_minhash_dedup(spark, sf_dir):
    return dedup.near_duplicates(table(spark, sf_dir, "documents"), words=4, percent=80)


def op5_html_extraction(spark, sf_dir):
    return html.extract(table(spark, sf_dir, "pages"))


def op6_chat_format(spark, sf_dir):
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    said = "\\### Assistant: </turn> ok"
    own = spark.createDataFrame([(CONTROL_CASE, 0, "user", said), (CONTROL_CASE, 1, "assistant", said)],
                                "conv_id bigint, turn bigint, role string, text string")
    return chat.digests(chat.format_conversations(rows.union(own)))


def op7_quality_rules(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    metrics = T.stored(docs.select("doc_id", rules.count_struct(F.col("text")).alias("_m"),
                                   F.coalesce("lang", F.lit("\x00")).alias("_stratum")), "rule-counts")
    out = rules.judge(docs, table(spark, sf_dir, "labels"), metrics=metrics)
    base = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    return out.select("doc_id", *[F.col(f"_m.{c}").alias(c) for c in base], F.col("_failed").alias("base_failed"),
                      F.col("_kept").alias("kept"))


def op8_toxicity(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = toxicity.severity(docs, table(spark, sf_dir, "labels"), "toxic", T.id_bucket("_id", 4) != 2)
    return out.select("doc_id", _held(4, 2).alias("held_out"), F.col("_severity").alias("severity"),
                      F.col("_grade").alias("grade"), (F.col("_grade") > 0).alias("toxic"))


def op9_decontamination(spark, sf_dir):
    out = decontam.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), window=13, percent=5)
    return out.select("doc_id", "n_words", "n_hit", F.size("items").cast("bigint").alias("n_items"),
                      F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated")


def op10_lm_score(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return lm.score(docs, T.id_bucket("doc_id", 5) == 1)


def op11_hard_negatives(spark, sf_dir):
    vec_id = F.col("vec_id")
    relabel = F.when(vec_id % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return negatives.mine(table(spark, sf_dir, "embeddings"), vec_id % 100 == 0, relabel, k=5, low=80, high=100)


def op12_jaccard_join(spark, sf_dir):
    return treejoin.similar_documents(table(spark, sf_dir, "documents"), words=4, percent=85)


def op13_source_divergence(spark, sf_dir):
    return divergence.audit(table(spark, sf_dir, "documents"), min_docs=3, top_terms=200)


def pipeline(spark, sf_dir):
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES = {f.__name__: f for f in (
    op1_quality_classifier, op2_url_filter, op3_best_fit_packing, op4_minhash_dedup, op5_html_extraction,
    op6_chat_format, op7_quality_rules, op8_toxicity, op9_decontamination, op10_lm_score, op11_hard_negatives,
    op12_jaccard_join, op13_source_divergence, pipeline)}

_LOW = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

# documents linked by the Jaccard similarity of their four-word shingles
_COMPONENTS = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all({low}, '[^\x20\x09-\x0D]+') AS ws FROM documents),
s AS (
  SELECT doc_id, CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 4 THEN [array_to_string(ws, ' ')]
                 ELSE list_distinct(list_transform(range(1, len(ws) - 2), lambda i: array_to_string(ws[i:i+3], ' '))) END AS sh
  FROM w),
u AS (SELECT doc_id, len(sh) AS n, unnest(sh) AS x FROM s),
links AS (
  SELECT a.doc_id AS p, b.doc_id AS q FROM u a JOIN u b ON a.x = b.x AND a.doc_id < b.doc_id
  GROUP BY 1, 2 HAVING 100 * count(*) >= {percent} * (any_value(a.n) + any_value(b.n) - count(*))),
edges AS (SELECT p, q FROM links UNION SELECT q, p FROM links),
reach(doc_id, r) AS (
  SELECT doc_id, doc_id FROM s UNION SELECT e.q, reach.r FROM reach JOIN edges e ON e.p = reach.doc_id),
comp AS (SELECT doc_id, min(r) AS c FROM reach GROUP BY 1)
SELECT s.doc_id, CAST(len(sh) AS BIGINT) AS n_shingles, c AS component_id{kept}
FROM s JOIN comp USING (doc_id)"""

SQL = {
    "op4_minhash_dedup": _COMPONENTS.format(low=_LOW.format("coalesce(text, '')"), percent=80, kept=", s.doc_id = c AS kept"),
    "op6_chat_format": r"""
WITH rows AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok' UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'),
f AS (
  SELECT *, replace(replace(replace(replace(role, '\', '\\'), '###', '\###'), '</turn>', '\</turn>'), ':', '\:') AS r2,
         replace(replace(replace(text, '\', '\\'), '###', '\###'), '</turn>', '\</turn>') AS t2 FROM rows)
SELECT CAST(conv_id AS BIGINT) AS conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       CAST(sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END) AS BIGINT) AS loss_chars,
       sha256(string_agg(CASE WHEN role = 'assistant' THEN text ELSE '' END, '' ORDER BY turn, role, text)) AS loss_sha256,
       CAST(sum(14 + length(r2) + length(t2)) AS BIGINT) AS formatted_chars
FROM f GROUP BY 1""",
    "op9_decontamination": rf"""
WITH d AS (
  SELECT doc_id, regexp_extract_all({_LOW.format("coalesce(text, '')")}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM documents),
b AS (
  SELECT CAST(item_id AS VARCHAR) AS item, regexp_extract_all({_LOW.format("coalesce(text, '')")}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws
  FROM benchmark),
pat AS (
  SELECT DISTINCT item, k, array_to_string(ws[i:i+k-1], ' ') AS p
  FROM (SELECT item, ws, least(13, len(ws)) AS k, unnest(range(1, len(ws) - least(13, len(ws)) + 2)) AS i FROM b WHERE len(ws) > 0)),
places AS (
  SELECT doc_id, k, i, array_to_string(ws[i:i+k-1], ' ') AS p
  FROM (SELECT doc_id, ws, k, unnest(range(1, len(ws) - k + 2)) AS i FROM d, (SELECT DISTINCT k FROM pat) ks WHERE len(ws) >= k)),
occ AS (SELECT doc_id, k, i, item FROM places JOIN pat USING (k, p)),
hit AS (SELECT doc_id, count(DISTINCT pos) AS n FROM (SELECT doc_id, unnest(range(i, i + k)) AS pos FROM occ) GROUP BY 1),
its AS (SELECT doc_id, count(*) AS n, string_agg(item, ',' ORDER BY item) AS names FROM (SELECT DISTINCT doc_id, item FROM occ) GROUP BY 1)
SELECT d.doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(coalesce(hit.n, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(its.n, 0) AS BIGINT) AS n_items, sha256(coalesce(names, '')) AS items_sha256,
       coalesce(hit.n, 0) > 0 AND 20 * coalesce(hit.n, 0) >= len(ws) AS contaminated
FROM d LEFT JOIN hit USING (doc_id) LEFT JOIN its USING (doc_id)""",
    "op11_hard_negatives": """
WITH usable AS (
  SELECT row_number() OVER () AS r, vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS q
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT a.r AS a, a.vec_id AS anchor_id, b.r AS b, b.vec_id AS vec_id, a.label = b.label AS same,
         CAST(list_inner_product(a.q, b.q) AS BIGINT) AS s
  FROM usable a JOIN usable b ON a.r <> b.r WHERE a.vec_id % 100 = 0),
positives AS (
  SELECT a, anchor_id, b AS p, vec_id AS positive_id, s AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY a ORDER BY s DESC, vec_id NULLS LAST, b) <= 5),
ranked AS (
  SELECT positives.*, n.vec_id AS negative_id, n.s AS negative_score,
         row_number() OVER (PARTITION BY positives.a, p ORDER BY n.s DESC, n.vec_id NULLS LAST, n.b) AS k
  FROM positives JOIN scored n ON n.a = positives.a AND NOT n.same
   AND 80 * positive_score <= 100 * n.s AND 100 * n.s <= 100 * positive_score)
SELECT anchor_id, positive_id, CAST(k AS INTEGER) AS rank, negative_id, positive_score, negative_score FROM ranked WHERE k <= 5""",
    "op12_jaccard_join": _COMPONENTS.format(low=_LOW.format("coalesce(text, '')"), percent=85, kept=""),
    "op13_source_divergence": rf"""
WITH d AS MATERIALIZED (
  SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         regexp_extract_all({_LOW.format("coalesce(text, '')")}, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS ts FROM documents),
u AS MATERIALIZED (SELECT r, lang, source, t, count(*) AS n FROM (SELECT r, lang, source, unnest(ts) AS t FROM d) GROUP BY ALL),
kept AS MATERIALIZED (SELECT lang, t, CAST(sum(n) AS BIGINT) AS c FROM u GROUP BY lang, t HAVING count(*) >= 3),
vs AS MATERIALIZED (SELECT lang, count(*) AS v, CAST(sum(c) AS BIGINT) AS total FROM kept GROUP BY lang),
g AS MATERIALIZED (SELECT DISTINCT lang, source FROM d),
gc AS MATERIALIZED (SELECT lang, source, t, CAST(sum(n) AS BIGINT) AS c FROM u JOIN kept USING (lang, t) GROUP BY ALL),
gn AS MATERIALIZED (SELECT lang, source, coalesce(sum(c), 0) AS total FROM g LEFT JOIN gc USING (lang, source) GROUP BY ALL),
p AS MATERIALIZED (
  SELECT g.lang, g.source, kept.t, coalesce(gc.c, 0) AS c,
         CAST(1 + (1000000000 * (CAST(coalesce(gc.c, 0) AS HUGEINT) + 1)) // (gn.total + vs.v) AS BIGINT) AS p,
         CAST(1 + (1000000000 * (CAST(kept.c AS HUGEINT) + 1)) // (vs.total + vs.v) AS BIGINT) AS q
  FROM g JOIN kept USING (lang) JOIN vs USING (lang) JOIN gn USING (lang, source) LEFT JOIN gc USING (lang, source, t)),
pv AS (
  SELECT a.lang, a.source, b.source AS item, CAST(sum((a.p - b.p) * (a.p - b.p) // b.p) AS BIGINT) AS value
  FROM p a JOIN p b ON a.lang = b.lang AND a.t = b.t AND a.source <> b.source GROUP BY ALL),
pair AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(pv.value, 0) AS value
  FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN pv ON pv.lang = a.lang AND pv.source = a.source AND pv.item = b.source),
term AS (
  SELECT lang, source, 'term' AS part, t AS item, (p - q) * (p - q) // q AS value FROM p WHERE c > 0 AND p > q),
ranked AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INTEGER) AS rank
  FROM (SELECT * FROM pair UNION ALL SELECT * FROM term))
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, rank FROM ranked WHERE part = 'pair' OR rank <= 200""",
}
