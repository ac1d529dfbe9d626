"""Registered queries of the training-text problems; each takes (spark, sf_dir)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import cut, table, texts
from . import leaks, lookalike, packing, scans, site_lines, splitting
from .hnsw import neighbours, similar_pairs
from .oracle import sql  # noqa: F401 - the SQL of these queries
from .setsketch import NearDuplicates

SIMILAR = 0.7


def _look_alike_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    keys = lookalike.look_alike_keys(texts(spark, sf_dir, "chunks", "chunk_id", "text"), "chunks", "chunk_id", "text")
    return cut(keys.union(lookalike.look_alike_keys(texts(spark, sf_dir, "extracts", "extract_id", "content"), "extracts", "extract_id", "content")))


def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lookalike.look_alike_pairs(_look_alike_keys(spark, sf_dir))


def p1_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lookalike.look_alike_groups(_look_alike_keys(spark, sf_dir))


def p1_form(spark: SparkSession, sf_dir: str) -> DataFrame:
    chunks = table(spark, sf_dir, "chunks").select(F.lit("chunks").alias("tab"), F.col("chunk_id").alias("id"), "text")
    extracts = table(spark, sf_dir, "extracts").select(F.lit("extracts").alias("tab"), F.col("extract_id").alias("id"), F.col("content").alias("text"))
    return lookalike.consistent_form(chunks.union(extracts), "text").select("tab", "id", "form")


def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return similar_pairs(table(spark, sf_dir, "vectors"), "vec_id", "embedding", 0.8)


def p2_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The neighbours of every vector; as a search's log would rank them."""
    return neighbours(table(spark, sf_dir, "vectors"), "vec_id", "embedding")


def _scanned_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    title = F.try_element_at("metadata", F.lit("title"))
    return scans.scanned_pages(texts(spark, sf_dir, "extracts", "extract_id", "source_file", "content", "metadata"), "extract_id", "source_file", "content", title)


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scans.noise_lines(_scanned_pages(spark, sf_dir), "extract_id")


def p3_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scans.repaired(_scanned_pages(spark, sf_dir), "extract_id")


def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return site_lines.site_lines(texts(spark, sf_dir, "extracts", "extract_id", "source_file", "content"), "extract_id", "source_file", "content")


def p4_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return site_lines.without_site_lines(texts(spark, sf_dir, "extracts", "extract_id", "source_file", "content"), "extract_id", "source_file", "content").select("extract_id", "content")


def _stored_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(tab, id, text) of all chunks and extracts."""
    c = texts(spark, sf_dir, "chunks", "chunk_id", "text").select(F.lit("chunks").alias("tab"), F.col("chunk_id").alias("id"), "text")
    e = texts(spark, sf_dir, "extracts", "extract_id", "content").select(F.lit("extracts").alias("tab"), F.col("extract_id").alias("id"), F.col("content").alias("text"))
    return c.union(e)


def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return NearDuplicates(_stored_texts(spark, sf_dir), SIMILAR).pairs()


def p5_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return NearDuplicates(_stored_texts(spark, sf_dir), SIMILAR).groups()


def p7_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return leaks.leaks(texts(spark, sf_dir, "documents", "doc_id", "text"), "doc_id", "text", table(spark, sf_dir, "golden_items"), "item_id", "passage")


def p7_overlap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same documents and items with how much of passage and question they have in common."""
    return leaks.leaks(texts(spark, sf_dir, "documents", "doc_id", "text"), "doc_id", "text", table(spark, sf_dir, "golden_items"), "item_id", "passage", "question")


def _limits(spark: SparkSession, sf_dir: str, purpose: str) -> list[tuple[int, int]]:
    rows = table(spark, sf_dir, "token_limits").filter((F.col("purpose") == purpose) & F.col("max_tokens").isNotNull())
    return sorted((r.max_tokens, r.overlap_tokens or 0) for r in rows.collect())  # a parameter table of five rows


def p6_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    capacities = [m for m, _ in _limits(spark, sf_dir, "pack")]
    return packing.pack_all(texts(spark, sf_dir, "documents", "doc_id", "text"), "doc_id", "text", capacities)


def p6_fill(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How full the containers are: their number, the least number that their tokens need, and the unused share."""
    boxes = p6_pack(spark, sf_dir).filter("container is not null").groupBy("max_tokens", "container").agg(F.sum("tokens").alias("tokens"))
    out = boxes.groupBy("max_tokens").agg(F.count("*").alias("containers"), F.sum("tokens").alias("tokens"), F.max("tokens").alias("fullest"))
    least = F.ceil(F.col("tokens") / F.col("max_tokens"))
    return out.withColumn("least", least).withColumn("unused", F.round(1 - F.col("tokens") / (F.col("containers") * F.col("max_tokens")), 6))


def p8_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    return splitting.split_texts(texts(spark, sf_dir, "documents", "doc_id", "text"), "doc_id", "text", _limits(spark, sf_dir, "split"))


def p6_cover(spark: SparkSession, sf_dir: str) -> DataFrame:
    """For each capacity how many documents have a place, containers that hold too much, and texts of which the parts
    don't follow one another from the first token on."""
    parts = cut(p6_pack(spark, sf_dir))
    boxes = parts.filter("container is not null").groupBy("max_tokens", "container").agg(F.sum("tokens").alias("held"))
    overfull = boxes.groupBy("max_tokens").agg(F.count_if(F.col("held") > F.col("max_tokens")).alias("overfull"))
    order = Window.partitionBy("max_tokens", "doc_id").orderBy("part")
    due = F.coalesce(F.sum("tokens").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    texts_ = parts.withColumn("wrong", (F.col("first_token") != due) | (F.col("part") != F.row_number().over(order) - 1))
    each = texts_.groupBy("max_tokens").agg(F.countDistinct("doc_id").alias("documents"), F.count_if("wrong").alias("broken"))
    return each.join(overfull, "max_tokens", "left").select("max_tokens", "documents", F.coalesce("overfull", F.lit(0)).alias("overfull"), "broken")


def p8_cover(spark: SparkSession, sf_dir: str) -> DataFrame:
    """For each limit the pieces that exceed it, that don't hold the bytes they should, counting on from the piece before,
    or that lack their overlap, which is the whole piece before if that is shorter; of all pieces."""
    limits = spark.createDataFrame(_limits(spark, sf_dir, "split"), "max_tokens int, asked int").groupBy("max_tokens").agg(F.max("asked").alias("asked"))
    pieces = p8_split(spark, sf_dir).withColumn("own", F.octet_length("text"))
    order = Window.partitionBy("max_tokens", "doc_id").orderBy("piece")
    before = F.lag("end_byte").over(order)
    pieces = pieces.withColumn("gap", F.when(before.isNull(), F.col("first_byte") != 0).otherwise(F.col("first_byte") > before)).join(limits, "max_tokens")
    wrong = F.col("gap") | (F.col("own") != F.col("end_byte") - F.col("first_byte"))
    short = (F.col("piece") > 0) & (F.col("overlap_tokens") < F.least("asked", F.lag("tokens").over(order)))
    pieces = pieces.withColumns({"wrong": wrong, "short": short})
    out = pieces.groupBy("max_tokens").agg(F.count_if(F.col("tokens") > F.col("max_tokens")).alias("over_limit"), F.count_if("wrong").alias("wrong_bytes"), F.count_if("short").alias("without_overlap"))
    return limits.select("max_tokens").join(out, "max_tokens", "left").na.fill(0)


QUERIES = {f.__name__: f for f in (p1_found, p1_groups, p1_form, p2_found, p2_neighbours, p3_found, p3_text, p4_found, p4_clean, p5_found, p5_groups, p6_pack, p6_fill, p6_cover, p7_found, p7_overlap, p8_split, p8_cover)}
