"""Queries over chunks, vectors, search results and golden items."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import retrieval, vectors
from ..session import cut, table

COPY_THRESHOLD = 0.95
BATCH_START = "2025-02-20 20:00:00"  # vectors indexed from here on are a new batch, the rest is stored


def vector_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "chunks")
    return c.select("chunk_id", vectors.vector_id(F.col("filename"), F.col("level"), F.col("section"), F.col("chunk_index")).alias("vector_id"))


def latest_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The chunk indexed last under each identity."""
    c = table(spark, sf_dir, "chunks")
    ids = c.select("chunk_id", "indexed_at", vectors.vector_id(F.col("filename"), F.col("level"), F.col("section"), F.col("chunk_index")).alias("vector_id"))
    return vectors.latest(ids, "vector_id", F.col("indexed_at").isNotNull(), F.col("indexed_at"), F.col("chunk_id")).select("vector_id", "chunk_id")


def _batches(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    v = table(spark, sf_dir, "vectors")
    at = F.coalesce(F.col("indexed_at"), F.lit("1970-01-01").cast("timestamp_ntz")).cast("timestamp_ntz")
    rows = v.select("vec_id", "filename", "embedding", vectors.vector_id(F.col("filename"), F.col("level"), F.col("section"), F.col("chunk_index")).alias("vector_id"), (at >= F.lit(BATCH_START).cast("timestamp_ntz")).alias("new"))
    last = lambda d: vectors.latest(d.drop("new"), "vector_id", F.col("vec_id"))
    return last(rows.filter("not new")), last(rows.filter("new"))


def upsert_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The vector table after a new batch replaced what it has anew, by identity."""
    stored, new = _batches(spark, sf_dir)
    return vectors.upsert(stored, new, "vector_id").select("vector_id", "vec_id")


def replace_file_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same, with all stored vectors of a file in the batch replaced."""
    stored, new = _batches(spark, sf_dir)
    return vectors.upsert(stored, new, "vector_id", "filename").select("vector_id", "vec_id")


def knn_queries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The exact five nearest of every vector whose id is divisible by 100."""
    v = table(spark, sf_dir, "vectors")
    asked = v.filter("vec_id % 100 = 0").select(F.col("vec_id").alias("query_id"), "embedding")
    return vectors.search(v, "vec_id", "embedding", asked, "query_id", "embedding", exclude_self=True)


def chunk_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Vectors with an id divisible by 100 whose nearest other vector is a near copy from another file."""
    v = table(spark, sf_dir, "vectors")
    near = knn_queries(spark, sf_dir)
    new = v.select(F.col("vec_id").alias("query_id"), "filename")
    return vectors.near_copies(near, v, new, "vec_id", "query_id", "filename", COPY_THRESHOLD)


def batch_copies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The vectors of the new batch whose nearest stored vector is a near copy from another file; all of the batch."""
    stored, new = _batches(spark, sf_dir)
    new = new.select(F.col("vec_id").alias("query_id"), "filename", "embedding")
    near = vectors.search(stored, "vec_id", "embedding", new, "query_id", "embedding", 1)
    return vectors.near_copies(near, stored, new, "vec_id", "query_id", "filename", COPY_THRESHOLD)


def usable_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    v = table(spark, sf_dir, "vectors")
    return v.groupBy("model").agg(F.count("*").alias("vectors"), F.count_if(vectors.usable(F.col("embedding"), 64)).alias("usable"))


def score_as_similarity(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = table(spark, sf_dir, "search_results")
    return r.select("result_id", F.round(vectors.similarity_of(F.col("score"), F.col("store")), 6).alias("similarity"))


def _searches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each search once: the results of one question in one store at one time, those logged twice left out."""
    r = table(spark, sf_dir, "search_results")
    return r.groupBy("item_id", "store", "searched_at", "rank").agg(F.min("result_id").alias("result_id")).select("result_id")


def golden_recall(spark: SparkSession, sf_dir: str) -> DataFrame:
    hits = retrieval.recall_hits(table(spark, sf_dir, "search_results"), table(spark, sf_dir, "golden_items"), "item_id")
    return hits


def recall_at_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return retrieval.recall(golden_recall(spark, sf_dir))


def rag_prompts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The prompt of every logged search."""
    r = table(spark, sf_dir, "search_results").join(_searches(spark, sf_dir), "result_id", "left_semi")
    level = F.lit(None).cast("string")
    r = r.withColumn("description", retrieval.describe_source(F.col("filename"), F.col("page_number"), F.col("section"), level))
    return retrieval.prompts(r, ["item_id", "store", "searched_at"], "question", "rank", "text", "description")


def result_snippets(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = table(spark, sf_dir, "search_results")
    return r.select("result_id", "rank", F.coalesce("section", "filename").alias("place"), retrieval.snippet(F.col("text")).alias("snippet"))


def section_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return retrieval.section_texts(table(spark, sf_dir, "chunks"), "filename", "section", ["chunk_index", "chunk_id"], "text")


def chunk_store_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Chunks, files, sections and pages by level."""
    c = table(spark, sf_dir, "chunks")
    return c.groupBy("level").agg(F.count("*").alias("chunks"), F.countDistinct("filename").alias("files"), F.countDistinct("section").alias("sections"), F.max("page_number").alias("last_page"), F.count_if(F.coalesce(F.col("text"), F.lit("")) == "").alias("empty"))


QUERIES = {
    f.__name__: f
    for f in (vector_ids, latest_chunks, upsert_vectors, replace_file_vectors, knn_queries, chunk_dedup, batch_copies, usable_vectors, score_as_similarity, golden_recall, recall_at_k, rag_prompts, result_snippets, section_texts, chunk_store_report)
}

_ID = """(SELECT h[1:8] || '-' || h[9:12] || '-5' || h[14:16] || '-' || translate(h[17:17], '0123456789abcdef', '89ab89ab89ab89ab') || h[18:20] || '-' || h[21:32]
  FROM (SELECT sha1(unhex('6ba7b8119dad11d180b400c04fd430c8') || encode(coalesce(filename, '') || '|' || coalesce(level, 'chunk') || '|' || coalesce(section, '') || '|' || coalesce(chunk_index::VARCHAR, ''))) AS h))"""
_BATCHES = f"""ids AS MATERIALIZED (SELECT vec_id, filename, {_ID} AS vector_id, coalesce(indexed_at, TIMESTAMP '1970-01-01') >= TIMESTAMP '{BATCH_START}' AS fresh FROM vectors),
last AS MATERIALIZED (SELECT vector_id, fresh, max(vec_id) AS vec_id, any_value(filename) AS filename FROM ids GROUP BY ALL)"""
_USABLE = "len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0"
_KNN = f"""ok AS MATERIALIZED (SELECT vec_id, filename, embedding::DOUBLE[64] AS e FROM vectors WHERE {_USABLE}),
scored AS (SELECT q.vec_id AS query_id, v.vec_id, round(array_cosine_similarity(q.e, v.e), 6) AS score FROM ok q JOIN ok v ON q.vec_id % 100 = 0 AND q.vec_id <> v.vec_id),
knn AS MATERIALIZED (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scored QUALIFY rank <= 5)"""
_HITS = """hits AS (SELECT g.item_id, min(r.rank) AS hit_rank FROM golden_items g LEFT JOIN search_results r ON r.item_id = g.item_id AND r.rank <= 5 AND r.filename = g.expected_source
  AND (g.expected_page IS NULL OR r.page_number IS NULL OR abs(r.page_number - g.expected_page) <= 2) WHERE g.expected_source IS NOT NULL GROUP BY 1)"""
_STRIP = r"regexp_replace(regexp_replace(coalesce(text, ''), '\A[\s\x1c-\x1f\x85\p{Z}]+', ''), '[\s\x1c-\x1f\x85\p{Z}]+\z', '')"
SQL = {
    "vector_ids": f"SELECT chunk_id, {_ID} AS vector_id FROM chunks",
    "latest_chunks": f"WITH i AS (SELECT chunk_id, indexed_at, {_ID} AS vector_id FROM chunks) SELECT vector_id, arg_max(chunk_id, (indexed_at IS NOT NULL, coalesce(indexed_at, TIMESTAMP '1970-01-01'), chunk_id)) AS chunk_id FROM i GROUP BY 1",
    "upsert_vectors": f"WITH {_BATCHES} SELECT vector_id, vec_id FROM last l WHERE fresh OR NOT EXISTS (SELECT 1 FROM last n WHERE n.fresh AND n.vector_id = l.vector_id)",
    "replace_file_vectors": f"""WITH {_BATCHES} SELECT vector_id, vec_id FROM last l WHERE fresh OR (vector_id NOT IN (SELECT vector_id FROM last WHERE fresh)
      AND (filename IS NULL OR filename NOT IN (SELECT filename FROM last WHERE fresh AND filename IS NOT NULL)))""",
    "knn_queries": f"WITH {_KNN} SELECT query_id, rank::INT AS rank, vec_id, score FROM knn",
    "chunk_dedup": f"WITH {_KNN} SELECT query_id FROM knn JOIN ok o USING (vec_id) JOIN ok n ON n.vec_id = query_id WHERE rank = 1 AND score >= {COPY_THRESHOLD} AND coalesce(o.filename, '') <> '' AND o.filename IS DISTINCT FROM n.filename",
    "batch_copies": f"""WITH {_BATCHES}, ok AS MATERIALIZED (SELECT l.vec_id, l.filename, fresh, embedding::DOUBLE[64] AS e FROM last l JOIN vectors v ON v.vec_id = l.vec_id WHERE {_USABLE}),
      scored AS (SELECT n.vec_id AS query_id, n.filename AS own, o.filename AS other, o.vec_id, round(array_cosine_similarity(n.e, o.e), 6) AS score FROM ok n JOIN ok o ON n.fresh AND NOT o.fresh),
      near AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) = 1)
      SELECT query_id FROM near WHERE score >= {COPY_THRESHOLD} AND coalesce(other, '') <> '' AND other IS DISTINCT FROM own""",
    "usable_vectors": f"SELECT model, count(*) AS vectors, count_if({_USABLE}) AS usable FROM vectors GROUP BY 1",
    "score_as_similarity": "SELECT result_id, round(CASE store WHEN 'qdrant' THEN score WHEN 'chroma' THEN 1 - score END, 6) AS similarity FROM search_results",
    "golden_recall": f"WITH {_HITS} SELECT item_id, hit_rank IS NOT NULL AS hit, hit_rank FROM hits",
    "recall_at_k": f"WITH {_HITS} SELECT count(*) AS questions, count(hit_rank) AS hits, round(count(hit_rank) / count(*), 6) AS recall FROM hits",
    "rag_prompts": f"""WITH once AS (SELECT * FROM search_results QUALIFY row_number() OVER (PARTITION BY item_id, store, searched_at, rank ORDER BY result_id) = 1),
      described AS (SELECT *, {_STRIP} AS t, coalesce(CASE WHEN filename <> '' THEN filename END, 'unknown file') || ', ' || coalesce('page ' || page_number, 'page unknown') ||
        CASE WHEN section <> '' THEN ', section: ' || section ELSE '' END AS d FROM once),
      placed AS (SELECT *, row_number() OVER (PARTITION BY item_id, store, searched_at ORDER BY rank, d, t) AS n FROM described)
      SELECT item_id, store, searched_at, count(*)::INT AS sources, 'Context passages:' || chr(10) || chr(10) || string_agg('[' || n || '] (' || d || ')' || chr(10) || t, chr(10) || chr(10) ORDER BY n)
        || chr(10) || chr(10) || 'Question: ' || any_value(question) AS prompt FROM placed GROUP BY ALL""",
    "result_snippets": "SELECT result_id, rank, coalesce(section, filename) AS place, replace(text[1:200], chr(10), ' ') || CASE WHEN length(text) > 200 THEN '...' ELSE '' END AS snippet FROM search_results",
    "section_texts": "SELECT filename, section, count(*) AS chunks, substr(string_agg(text, chr(10) ORDER BY chunk_index NULLS FIRST, chunk_id), 1, 8000) AS text FROM chunks WHERE section <> '' AND text IS NOT NULL GROUP BY 1, 2",
    "chunk_store_report": "SELECT level, count(*) AS chunks, count(DISTINCT filename) AS files, count(DISTINCT section) AS sections, max(page_number) AS last_page, count_if(coalesce(text, '') = '') AS empty FROM chunks GROUP BY 1",
}
