"""The registered query of each operator, and SQL where it can say the same."""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

import corpus_pipeline
from topicflow.llm import ann, bpe, divergence, exact, filters, licenses, lm, mixing, sharding, simhash, topk, toxicity, warc
from topicflow.llm.common import table
from topicflow.session import work_dir

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}

TOKENIZER = corpus_pipeline.TOKENIZER


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def register(run: Query) -> Query:
        QUERIES[run.__name__] = run
        if sql is not None:
            SQL[run.__name__] = sql
        return run

    return register


def remainder(divisor: int) -> F.Column:
    """crc32 of the id as text, modulo ``divisor``."""
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % divisor


@query()
def op1_collision_counting(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.nearest_neighbours(table(spark, sf_dir, "embeddings", "vec_id", "embedding"), F.col("vec_id") % 20 == 0)


@query(
    """
    WITH whole AS (
        SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
        FROM embeddings WHERE embedding IS NOT NULL AND vec_id IS NOT NULL
    ), cells AS (
        SELECT vec_id, unnest(v) AS x, generate_subscripts(v, 1) AS d FROM whole
    ), scored AS (
        SELECT q.vec_id AS query_id, c.vec_id, CAST(sum(q.x * c.x) AS BIGINT) AS score
        FROM cells q JOIN cells c ON q.d = c.d AND q.vec_id <> c.vec_id
        WHERE q.vec_id % 50 = 0 GROUP BY q.vec_id, c.vec_id
    ), ranked AS (
        SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score FROM scored
    )
    SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5
    """
)
def op2_threshold_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_products(table(spark, sf_dir, "embeddings", "vec_id", "embedding"), F.col("vec_id") % 50 == 0)


@query()
def op3_license_inheritance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as a tree of files: folders by thousands and hundreds of ids, each with a licence file, and by source."""
    docs = table(spark, sf_dir, "documents", "doc_id", "text", "source")
    id = F.col("doc_id")
    thousand = F.floor(id / 1000).cast("string")
    hundred = F.concat_ws("/", thousand, F.floor(id / 100).cast("string"))
    path = (
        F.when(id % 1000 == 0, F.concat_ws("/", thousand, F.lit("LICENSE")))
        .when(id % 100 == 0, F.concat_ws("/", hundred, F.lit("LICENSE")))
        .otherwise(F.concat_ws("/", hundred, F.coalesce("source", F.lit("none")), F.concat(id.cast("string"), F.lit(".txt"))))
    )
    return licenses.scan_licenses(docs.withColumn("path", path))


@query()
def op4_simhash_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents", "doc_id", "text"))


@query()
def op5_hashed_maxent(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.score_texts(table(spark, sf_dir, "documents", "doc_id", "text"), remainder(7) != 2)


@query()
def op6_bpe_speculative(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.with_digests(table(spark, sf_dir, "documents", "doc_id", "text"), TOKENIZER)


@query()
def op7_warc_chains(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Archives of a few splits each, so that chains run on from split to split."""
    path = work_dir(spark, "archives")
    pages = table(spark, sf_dir, "pages", "page_id", "url", "html")
    size = pages.agg(F.sum(F.coalesce(F.octet_length("html"), F.lit(0)) + warc.HEADER_BYTES)).first()[0] or 0
    splits = math.ceil(size / warc.split_bytes(spark))
    warc.write_archives(warc.records(pages), path, archives=max(1, splits // 2))
    found = warc.read_archives(spark, path, content=False)
    revisit = F.col("record_type") == "revisit"
    declared = F.regexp_extract("http_headers", r"(?i)content-length: *(\d+)", 1).cast("long")
    header = F.col("headers")
    return found.select(
        header["x-page-id"].cast("long").alias("page_id"),
        F.when(revisit, declared).otherwise(F.col("payload_bytes")).alias("payload_bytes"),
        F.when(revisit, F.substring_index(header["warc-payload-digest"], ":", -1)).otherwise(F.col("payload_digest")).alias("payload_digest"),
        "record_type",
        header["x-refers-to-page-id"].cast("long").alias("refers_to"),
    )


@query()
def op8_karmarkar_karp(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_documents(table(spark, sf_dir, "documents", "doc_id", "text"))


@query(
    """
    WITH sources AS (
        SELECT source, count(*) AS n, sqrt(CAST(count(*) AS DOUBLE)) AS weight FROM documents GROUP BY source
    ), rates AS (
        SELECT source, weight / sum(weight) OVER () * sum(n) OVER () / n AS rate FROM sources
    ), terms AS (
        SELECT source, k, exp(k * ln(rate) - rate - coalesce(list_sum(list_transform(range(1, k + 1), lambda i: ln(CAST(i AS DOUBLE)))), 0.0)) AS p
        FROM (SELECT source, rate, unnest(range(0, CAST(ceil(rate + 10 * sqrt(rate) + 25) AS BIGINT) + 1)) AS k FROM rates)
    ), cdfs AS (
        SELECT source, list(c) AS cdf FROM (
            SELECT source, sum(p) OVER (PARTITION BY source ORDER BY k ROWS UNBOUNDED PRECEDING) AS c FROM terms)
        GROUP BY source
    ), draws AS (
        SELECT *, (CAST('0x' || substr(md5(name), 1, 13) AS BIGINT) + 0.5) / 4503599627370496.0 AS u
        FROM (SELECT *, 'mix|' || coalesce(CAST(doc_id AS VARCHAR), 'null') || '|' || md5(coalesce(text, '')) AS name FROM documents)
    ), counted AS (
        SELECT d.*, len(list_filter(c.cdf, lambda x: x < d.u)) AS times
        FROM draws d JOIN cdfs c ON d.source IS NOT DISTINCT FROM c.source
    ), copies AS (
        SELECT doc_id, text, lang, source, n_chars, name, CAST(unnest(range(1, times + 1)) AS INTEGER) AS copy FROM counted
    )
    SELECT * EXCLUDE (name), md5(name || '|' || CAST(copy AS VARCHAR)) AS shuffle_key FROM copies
    """
)
def op9_poisson_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text", "lang", "source", "n_chars")
    return mixing.mix_sources(docs, copy="copy", order="shuffle_key")


@query()
def op10_toxicity_lexicon(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    labels = table(spark, sf_dir, "labels", "doc_id", "toxic").where(remainder(5) != 0)
    scored = toxicity.with_scores(docs, toxicity.learn(docs, labels))
    return scored.select(
        "doc_id", (remainder(5) == 0).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted")
    )


@query(
    r"""
    SELECT doc_id, min(doc_id) OVER same AS keep_id, CAST(count(*) OVER same AS BIGINT) AS group_size,
           doc_id = min(doc_id) OVER same AS kept, sha256(norm) AS text_sha256
    FROM (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS norm FROM documents)
    WINDOW same AS (PARTITION BY norm)
    """
)
def op11_content_sort(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact.exact_duplicates(table(spark, sf_dir, "documents", "doc_id", "text"))


@query(
    r"""
    WITH docs AS (
        SELECT row_number() OVER () AS d, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
               translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text FROM documents
    ), words AS (
        SELECT lang, source, d, unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM docs
    ), terms AS (
        SELECT lang, term, count(*) AS total FROM words GROUP BY lang, term HAVING count(DISTINCT d) >= 30
    ), counts AS (
        SELECT lang, source, term, count(*) AS n FROM words SEMI JOIN terms USING (lang, term) GROUP BY lang, source, term
    ), sources AS (
        SELECT DISTINCT lang, source FROM docs
    ), cells AS (
        SELECT lang, source, term, total, coalesce(n, 0) AS n
        FROM sources JOIN terms USING (lang) LEFT JOIN counts USING (lang, source, term)
    ), shares AS (
        SELECT lang, source, term, n,
               1 + (CAST(1000000000 AS HUGEINT) * (n + 5)) // (sum(n) OVER own + 5 * count(*) OVER own) AS p,
               1 + (CAST(1000000000 AS HUGEINT) * (total + 5)) // (sum(total) OVER own + 5 * count(*) OVER own) AS q
        FROM cells WINDOW own AS (PARTITION BY lang, source)
    ), items AS (
        SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(sum(abs(s.p - t.p)), 0) AS value
        FROM sources a JOIN sources b ON a.lang = b.lang AND a.source <> b.source
        LEFT JOIN shares s ON s.lang = a.lang AND s.source = a.source
        LEFT JOIN shares t ON t.lang = b.lang AND t.source = b.source AND t.term = s.term
        WHERE s.term IS NULL OR t.term IS NOT NULL
        GROUP BY ALL
        UNION ALL
        SELECT lang, source, 'term', term, p - q FROM shares WHERE n > 0 AND p > q
    ), ranked AS (
        SELECT lang, source, part, item, CAST(value AS BIGINT) AS value,
               CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INTEGER) AS rank FROM items
    )
    SELECT * FROM ranked WHERE part = 'pair' OR rank <= 50
    """
)
def op12_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.divergence(table(spark, sf_dir, "documents", "text", "lang", "source"))


@query(
    r"""
    WITH words AS (
        SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text,
               regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents
    ), flags AS (
        SELECT doc_id, part,
               CASE WHEN len(words) < 200 THEN 1 ELSE 0 END
               + CASE WHEN 100 * len(list_distinct(words)) < 50 * len(words) THEN 2 ELSE 0 END
               + CASE WHEN 100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 3 * length(text) THEN 4 ELSE 0 END
               + CASE WHEN regexp_matches(text, '[#$%&*|]') THEN 8 ELSE 0 END
               + CASE WHEN doc_id > min(doc_id) OVER (PARTITION BY text) THEN 16 ELSE 0 END AS failed FROM words
    ), cells AS (
        SELECT part, failed, count(*) AS n, count(*) FILTER (quality = 1) AS good, count(*) FILTER (toxic = 1) AS toxic
        FROM flags LEFT JOIN labels USING (doc_id) GROUP BY part, failed
    ), filters AS (
        SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS name, unnest([1, 2, 4, 8, 16]) AS bit
    ), orders AS (
        SELECT a.name || b.name || c.name || d.name || e.name AS filter_order, [a.bit, b.bit, c.bit, d.bit, e.bit] AS bits
        FROM filters a, filters b, filters c, filters d, filters e WHERE a.bit | b.bit | c.bit | d.bit | e.bit = 31
    ), walked AS (
        SELECT filter_order, step, bits[step] AS bit, CAST(list_sum(bits[1:step]) AS BIGINT) AS after FROM orders, range(1, 6) r(step)
    ), counted AS (
        SELECT part, filter_order, step, bit,
               sum(CASE WHEN failed & after = 0 THEN n ELSE 0 END) AS kept,
               sum(CASE WHEN failed & after = bit THEN n ELSE 0 END) AS removed,
               sum(CASE WHEN failed & bit = bit AND failed & after <> bit THEN n ELSE 0 END) AS redundant,
               sum(CASE WHEN failed = bit THEN n ELSE 0 END) AS unique_fails,
               sum(CASE WHEN failed & after = bit THEN good ELSE 0 END) AS good_lost,
               sum(CASE WHEN failed & after = bit THEN toxic ELSE 0 END) AS toxic_lost
        FROM cells, walked GROUP BY part, filter_order, step, bit
    )
    SELECT part, filter_order, CAST(step AS INTEGER) AS step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed,
           CAST(redundant AS BIGINT) AS redundant, CAST(unique_fails AS BIGINT) AS unique_fails, CAST(good_lost AS BIGINT) AS good_lost,
           CAST(toxic_lost AS BIGINT) AS toxic_lost, CAST(sum(removed) OVER (PARTITION BY part, bit) AS BIGINT) AS shapley
    FROM counted
    """
)
def op13_gray_code_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text", "lang")
    return filters.filter_audit(docs, table(spark, sf_dir, "labels", "doc_id", "quality", "toxic"))


@query()
def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus_pipeline.run(spark, sf_dir)
