"""Problem 1: visually identical text with different characters.

Every text gets its look-alike skeleton (see ``functions.textform``); texts with equal skeletons are drawn alike.
"""

from __future__ import annotations

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.textform import text_form
from ..operators.joins import grid_join, salted_join


def consistent_form(df: DataFrame, text: str, out: str = "form") -> DataFrame:
    """Adds the consistent form of column ``text`` as ``out``, which it replaces if there is one already.

    Null stays null and empty stays empty; other columns are passed through unchanged. Texts of any length are
    processed whole. An empty table gives an empty table.
    """
    form = text_form(df.sparkSession)

    @F.arrow_udf("string")
    def formed(texts: pa.Array) -> pa.Array:
        return pa.array([form(t) for t in texts.to_pylist()], pa.string())

    return df.withColumn(out, formed(F.col(text)))


def look_alike_keys(df: DataFrame, tab: str, key: str, text: str) -> DataFrame:
    """``(tab, id, form_key, raw_key)`` of each row with a text: 128-bit digests of its consistent form and of the
    text itself. Null and empty texts have no row."""
    form = text_form(df.sparkSession)

    def keys(batches):
        for b in batches:
            texts = b.column(1).to_pylist()
            raw = [xxhash.xxh3_128_digest(t) for t in texts]
            new = [xxhash.xxh3_128_digest(form(t)) for t in texts]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(new, pa.binary()), pa.array(raw, pa.binary())], names=["id", "form_key", "raw_key"])

    rows = df.select(F.col(key).cast("long").alias("id"), F.col(text).alias("text")).filter("id is not null and text <> ''")
    return rows.mapInArrow(keys, "id long, form_key binary, raw_key binary").select(F.lit(tab).alias("tab"), "id", "form_key", "raw_key")


def look_alike_groups(keys: DataFrame) -> DataFrame:
    """``(tab, id, group_id, n_rows, n_variants)``: the group of rows drawn alike that each row belongs to, named by
    its smallest id. Rows whose text is drawn unlike any other form a group of one. Identical rows share a group."""
    groups = keys.groupBy("tab", "form_key", "raw_key").agg(F.min("id").alias("m"), F.count("*").alias("n"))
    groups = groups.groupBy("tab", "form_key").agg(F.min("m").alias("group_id"), F.sum("n").alias("n_rows"), F.count("*").alias("n_variants"))
    return salted_join(keys, groups, ["tab", "form_key"], F.col("id")).select("tab", "id", "group_id", "n_rows", "n_variants")


def look_alike_pairs(keys: DataFrame) -> DataFrame:
    """``(tab, id_a, id_b)`` of all rows of one table that are drawn alike but don't consist of the same characters.

    Only groups with several variants are joined, variant with variant; the rows of a variant come in afterwards,
    spread over partitions, so that no pair of identical texts is ever formed.
    """
    variants = keys.groupBy("tab", "form_key", "raw_key").agg(F.lit(0).alias("z"))
    several = variants.groupBy("tab", "form_key").agg(F.count("*").alias("v")).filter("v > 1").select("tab", "form_key")
    variants = variants.join(several, ["tab", "form_key"], "left_semi")
    a = variants.select("tab", "form_key", F.col("raw_key").alias("raw_a"))
    b = variants.select("tab", "form_key", F.col("raw_key").alias("raw_b"))
    pairs = grid_join(a, b, ["tab", "form_key"], F.col("raw_a"), F.col("raw_b"), 3).filter("raw_a < raw_b").select("tab", "raw_a", "raw_b")
    rows = salted_join(keys, several, ["tab", "form_key"], F.col("id"), how="left_semi")
    found = salted_join(rows.select("tab", F.col("raw_key").alias("raw_a"), F.col("id").alias("x")), pairs, ["tab", "raw_a"], F.col("x"))
    found = grid_join(found, rows.select("tab", F.col("raw_key").alias("raw_b"), F.col("id").alias("y")), ["tab", "raw_b"], F.col("x"), F.col("y"))
    return found.select("tab", F.least("x", "y").alias("id_a"), F.greatest("x", "y").alias("id_b"))
