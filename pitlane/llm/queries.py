"""One query per operator, over its whole table with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pitlane.llm import chat, decontam, lexical, lm, maintext, packing, pstable, quality, simhash, topk, toxicity, warc, whitening
from pitlane.llm.common import in_training_fold, land, table
from pitlane.session import scratch_path

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql:
            ORACLE[name] = sql.strip()
        return fn
    return deco


@query("op1_warc_salvage", """
WITH p AS (
  SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages),
f AS (SELECT payload_digest, min(page_id) AS first_id FROM p WHERE payload_bytes >= 100 GROUP BY payload_digest)
SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes, payload_digest,
       CASE WHEN first_id IS NULL OR first_id = page_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN first_id <> page_id THEN first_id END AS refers_to
FROM p LEFT JOIN f USING (payload_digest)
""")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write ``pages`` as archives, salvage-read them, digest what was read; fails if any of it was quarantined."""
    path = scratch_path(spark, "archives")
    warc.write_archives(warc.plan_records(table(spark, sf_dir, "pages")), path)
    log = land(warc.digest_log(warc.read_archives(spark, path)), "records")
    return warc.resolve_revisits(warc.require_whole(log))


@query("op2_decontaminate")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document and benchmark item with a verified overlap, and the best window of it."""
    found = decontam.overlaps(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "item_id", F.round("similarity", 6).alias("similarity"), "start", "words")


@query("op3_best_fit")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in sequences of at most 2048 tokens."""
    return packing.pack_documents(table(spark, sf_dir, "documents"), packing.public_vocabulary())


@query("op4_pseudo_likelihood")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Summed conditional log-probability of every document."""
    found = lm.train_and_score(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_tokens", *[F.round(c, 6).alias(c) for c in ("log_prob", "mean_log_prob")])


@query("op5_simhash")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SimHash of every document over 4-word shingles, linked at 4 or fewer bits."""
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"), words=4, max_bits=4)
    return found.select("doc_id", simhash.hex_fingerprint("fingerprint").alias("fingerprint"), "component_id")


def _scored(docs: DataFrame, threshold: float) -> DataFrame:
    held_out = ~F.coalesce(in_training_fold("doc_id"), F.lit(False))  # the labels of a null id are never learnt
    return docs.select("doc_id", held_out.alias("held_out"), F.round("score", 6).alias("score")).withColumn(
        "predicted", (F.col("score") >= threshold).cast("int"))


@query("op6_toxicity")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document by non-negative PU learning."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.train(docs, table(spark, sf_dir, "labels"))
    return _scored(toxicity.score(docs, model), 0.5)


@query("op7_chat_format", r"""
WITH t AS (SELECT DISTINCT conv_id, turn, role, text FROM conversations WHERE conv_id IS NOT NULL),
o AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role NULLS FIRST, text NULLS FIRST) AS pos,
         concat(CASE WHEN role IS NULL THEN '0' ELSE '1' || role END, chr(31),
                CASE WHEN text IS NULL THEN '0' ELSE '1' || text END, chr(30)) AS turn_key FROM t),
p AS (
  SELECT conv_id, pos, role, text, string_agg(turn_key, '') OVER (
    PARTITION BY conv_id ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS prefix FROM o),
e AS (SELECT conv_id, max(pos) AS n_turns, arg_max(prefix, pos) AS whole FROM p GROUP BY conv_id),
k AS (SELECT whole, n_turns, min(conv_id) AS conv_id, count(*) AS copies FROM e GROUP BY whole, n_turns),
q AS (SELECT p.conv_id, p.prefix FROM p JOIN k USING (conv_id) WHERE p.pos < k.n_turns),
s AS (SELECT q.conv_id, sum(k.copies) AS snapshots FROM q JOIN k ON k.whole = q.prefix GROUP BY q.conv_id),
m AS (SELECT k.* FROM k WHERE whole NOT IN (SELECT prefix FROM q))
SELECT m.conv_id, CAST(m.n_turns AS BIGINT) AS n_turns, CAST(m.copies AS BIGINT) AS copies,
       CAST(coalesce(s.snapshots, 0) AS BIGINT) AS snapshots, CAST((p.pos - 1) // 1000 AS BIGINT) AS segment,
       string_agg('<|' || coalesce(p.role, '') || '|>' || chr(10) || coalesce(p.text, '') || chr(10) || '<|end|>' || chr(10),
                  '' ORDER BY p.pos) AS text
FROM m JOIN p ON p.conv_id = m.conv_id LEFT JOIN s ON s.conv_id = m.conv_id
GROUP BY m.conv_id, m.n_turns, m.copies, s.snapshots, (p.pos - 1) // 1000
""")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Maximal conversations, rendered."""
    return chat.format_chats(table(spark, sf_dir, "conversations"))


@query("op8_quality")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of every document by naive Bayes support vectors."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = quality.train(docs, table(spark, sf_dir, "labels"))
    return _scored(quality.score(docs, model), 0.3)


@query("op9_html_min_cut")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of every page."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return maintext.with_main_text(pages).select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


@query("op10_exact_top_k", """
WITH v AS (
  SELECT DISTINCT vec_id, [CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT) FOR x IN embedding] AS w
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
s AS (
  SELECT q.vec_id AS query_id, v.vec_id,
         CAST(coalesce(list_sum([q.w[i] * v.w[i] FOR i IN generate_series(1, least(len(q.w), len(v.w)))]), 0) AS BIGINT) AS score
  FROM v AS q JOIN v ON q.vec_id <> v.vec_id WHERE q.vec_id % 50 = 0),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM r WHERE rank <= 5
""")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 5 best inner products for each vector whose id is divisible by 50."""
    rows = land(topk.sparse_rows(table(spark, sf_dir, "embeddings"), "vec_id", "embedding"), "vectors")
    return topk.exact_top_k(rows, rows.where("vec_id % 50 = 0"), 5)


@query("op11_qdwh_whitening")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 16 leading whitened components of every vector."""
    return whitening.whiten(table(spark, sf_dir, "embeddings"), "vec_id", "embedding", 16, 64.0)


@query("op12_pstable_near_dedup", """
WITH RECURSIVE v AS (
  SELECT row_number() OVER () AS r, vec_id, [CAST(x AS DOUBLE) FOR x IN embedding] AS x,
         embedding IS NOT NULL AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
           AND len([x FOR x IN embedding IF x <> 0]) > 0 AS good
  FROM embeddings),
l AS (SELECT a.r AS a, b.r AS b FROM v AS a JOIN v AS b ON a.r <> b.r AND a.good AND b.good
      AND list_cosine_similarity(a.x, b.x) >= 0.95),
t AS (SELECT a, b FROM l UNION SELECT t.a, l.b FROM t JOIN l ON l.a = t.b),
c AS (SELECT t.a AS r, min(v.vec_id) AS low FROM t JOIN v ON v.r = t.b GROUP BY t.a),
n AS (SELECT a AS r, count(*) AS n_links FROM l GROUP BY a)
SELECT vec_id, CAST(coalesce(n_links, 0) AS BIGINT) AS n_links,
       least(vec_id, coalesce(low, vec_id)) AS component_id, vec_id = least(vec_id, coalesce(low, vec_id)) AS kept
FROM v LEFT JOIN c USING (r) LEFT JOIN n USING (r)
""")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and components of every vector at a cosine of 0.95 or more."""
    return pstable.near_duplicates(table(spark, sf_dir, "embeddings"), "vec_id", "embedding")


@query("op13_pipelined_search", r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms FROM documents),
s AS (SELECT CAST(count(*) AS BIGINT) AS n_docs, CAST(sum(len(terms)) AS BIGINT) AS n_terms FROM d WHERE len(terms) > 0),
i AS (
  SELECT item_id, term, count(*) AS times FROM (
    SELECT item_id, unnest(regexp_extract_all(
      translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark) GROUP BY item_id, term),
p AS (
  SELECT r, doc_id, len, term, count(*) AS tf FROM (SELECT r, doc_id, len(terms) AS len, unnest(terms) AS term FROM d)
  WHERE term IN (SELECT term FROM i) GROUP BY r, doc_id, len, term),
w AS (
  SELECT term, CAST(floor(1000 * ln((2 * CAST(n_docs AS DOUBLE) + 2) / (2 * count(*) + 1))) AS BIGINT) AS w
  FROM p, s GROUP BY term, n_docs),
x AS (
  SELECT item_id, r, doc_id, sum(times * w * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 75 + (75 * len * n_docs) // n_terms)))) AS score
  FROM i JOIN p USING (term) JOIN w USING (term), s GROUP BY item_id, r, doc_id),
k AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM x WHERE score > 0)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, CAST(score AS BIGINT) AS score FROM k WHERE rank <= 10
""")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 10 best documents of each benchmark item."""
    return lexical.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
