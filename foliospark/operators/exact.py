"""Exact duplicates by size and SHA-256."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .joins import salted_join


def exact_duplicates(df: DataFrame, key: str, content: Column) -> DataFrame:
    """(key, kept): for each row the row that stands for all with the same content, the least key.

    Contents of a length that occurs once are never hashed. Null contents are never equal to any other and stand for
    themselves; empty contents are equal. Keys must be unique.
    """
    sized = df.select(key, content.alias("_c")).withColumn("_n", F.octet_length("_c"))
    shared = sized.groupBy("_n").agg(F.count("*").alias("_k")).filter("_n is not null and _k > 1").select("_n")
    hashed = salted_join(sized, shared, ["_n"], F.col(key), how="left_semi").select(key, "_n", F.sha2("_c", 256).alias("_h"))
    first = hashed.groupBy("_n", "_h").agg(F.min(key).alias("kept"))
    found = salted_join(hashed, first, ["_n", "_h"], F.col(key)).select(key, "kept")
    return df.select(key).join(found, key, "left").select(key, F.coalesce("kept", F.col(key)).alias("kept"))


def without_duplicates(df: DataFrame, key: str, content: Column) -> DataFrame:
    """``df`` without the rows that another row stands for."""
    return df.join(exact_duplicates(df, key, content).filter(F.col("kept") == F.col(key)).select(key), key, "left_semi")
