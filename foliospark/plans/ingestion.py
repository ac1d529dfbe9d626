"""Queries over the way in: front matter, phases, finished files, streaming, and the index of extracts."""

from __future__ import annotations

import uuid
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import Config
from ..operators import vectors
from ..session import shared_dir, table, texts
from ..sources import markdown
from ..streaming import ingest
from .pipeline import hash_embedder, index


def front_matter_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Extracts written with their metadata as front matter and read again."""
    e = table(spark, sf_dir, "extracts").select("extract_id", markdown.with_front_matter(F.col("content"), F.col("metadata")).alias("raw"))
    back = markdown.split_front_matter(e, "raw")
    return back.select("extract_id", F.length("content").alias("chars"), F.size("metadata").alias("entries"), F.try_element_at("metadata", F.lit("title")).alias("title"))


def pending_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ingest.pending(table(spark, sf_dir, "extracts"), "clean").select("extract_id", F.size(F.coalesce("pipeline_phases", F.array().cast("array<string>"))).alias("phases"))


def unfinished_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files that were extracted but of which nothing is indexed."""
    e = table(spark, sf_dir, "extracts").filter("source_file is not null").select("source_file").distinct()
    return e.join(table(spark, sf_dir, "chunks").select(F.col("filename").alias("source_file")).distinct(), "source_file", "left_anti")


def stream_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Extracts streamed in, cleaned and stored; the newest of each file."""
    work = f"{shared_dir(spark)}/stream-{uuid.uuid4().hex}"
    path = f"{sf_dir}/extracts.parquet"
    source = path if Path(path).is_dir() else f"{path[:-8]}*.parquet"
    schema = spark.read.parquet(path).schema
    ingest.ingest(spark, source, schema, f"{work}/table", f"{work}/checkpoint").awaitTermination()
    now = ingest.current(spark, f"{work}/table")
    return now.select("source_file", "extracted_at", F.size("pipeline_phases").alias("phases"))


def index_extracts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The index rows of the newest extract of each file, with stand-in embeddings."""
    e = texts(spark, sf_dir, "extracts", "source_file", "content", "extracted_at")
    rows = index(ingest.latest_by(e, "source_file", "extracted_at"), Config(), hash_embedder())
    return rows.select("vector_id", "filename", "section", "chunk_index", "page_number", F.size("embedding").alias("width"))


def metadata_overlay(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is stored with a chunk: the metadata of its file under that of its own place."""
    from ..functions.expressions import overlay

    e = ingest.latest_by(table(spark, sf_dir, "extracts"), "source_file", "extracted_at").select(F.col("source_file").alias("filename"), F.coalesce("metadata", F.create_map().cast("map<string,string>")).alias("m"))
    c = vectors.latest(table(spark, sf_dir, "chunks").select("chunk_id", "filename", "section"), "chunk_id", F.col("filename"), F.col("section"))
    own = F.map_filter(F.create_map(F.lit("title"), F.col("section"), F.lit("filename"), F.col("filename")), lambda k, v: v.isNotNull())
    out = c.join(e, "filename").select("chunk_id", overlay(F.col("m"), own).alias("m"))
    return out.select("chunk_id", F.size("m").alias("entries"), F.try_element_at("m", F.lit("title")).alias("title"), F.try_element_at("m", F.lit("lang")).alias("lang"))


QUERIES = {f.__name__: f for f in (front_matter_roundtrip, pending_clean, unfinished_files, stream_ingest, index_extracts, metadata_overlay)}

_LATEST = "(SELECT * FROM extracts WHERE source_file IS NOT NULL QUALIFY row_number() OVER (PARTITION BY source_file ORDER BY extracted_at DESC NULLS LAST, {content} DESC) = 1)"
SQL = {
    "front_matter_roundtrip": r"""SELECT extract_id, length(regexp_replace(content, '\A[\s\x1c-\x1f\x85\p{Z}]+', ''))::INT AS chars, CASE WHEN content IS NULL THEN 0 ELSE coalesce(cardinality(metadata), 0) END::INT AS entries,
      CASE WHEN content IS NOT NULL THEN metadata['title'] END AS title FROM extracts""",
    "pending_clean": "SELECT extract_id, coalesce(len(pipeline_phases), 0)::INT AS phases FROM extracts WHERE NOT coalesce(list_contains(pipeline_phases, 'clean'), false)",
    "unfinished_files": "SELECT DISTINCT source_file FROM extracts WHERE source_file IS NOT NULL AND source_file NOT IN (SELECT filename FROM chunks WHERE filename IS NOT NULL)",
    "metadata_overlay": f"""WITH e AS {_LATEST.format(content="coalesce(content, '')")} SELECT chunk_id, (len(list_distinct(list_concat(coalesce(map_keys(metadata), []), ['filename'], CASE WHEN section IS NULL THEN [] ELSE ['title'] END))))::INT AS entries,
      coalesce(section, metadata['title']) AS title, metadata['lang'] AS lang FROM chunks JOIN e ON filename = source_file""",
    "stream_ingest": f"WITH e AS {_LATEST.format(content='(extract_id)')} SELECT source_file, extracted_at, (coalesce(len(pipeline_phases), 0) + CASE WHEN coalesce(list_contains(pipeline_phases, 'clean'), false) THEN 0 ELSE 1 END)::INT AS phases FROM e",
}
