"""Incremental ingestion: a stream of document rows through the phases into tables, exactly once a file."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from ..operators.cleaning import CleanupRules, clean


def pending(df: DataFrame, phase: str) -> DataFrame:
    """The rows that a phase still has to run on; null phases count as none."""
    return df.filter(~F.array_contains(F.coalesce("pipeline_phases", F.array().cast("array<string>")), phase))


def run_phase(df: DataFrame, phase: str, column: str, change: Callable) -> DataFrame:
    """``df`` with ``change`` applied to a column where the phase has not run yet, and the phase noted."""
    have = F.coalesce("pipeline_phases", F.array().cast("array<string>"))
    todo = ~F.array_contains(have, phase)
    return df.withColumn(column, F.when(todo, change(F.col(column))).otherwise(F.col(column))).withColumn("pipeline_phases", F.when(todo, F.array_append(have, phase)).otherwise(have))


def clean_phase(df: DataFrame, rules: CleanupRules = CleanupRules()) -> DataFrame:
    return run_phase(df, "clean", "content", lambda c: clean(c, rules))


def latest_by(df: DataFrame, key: str, at: str) -> DataFrame:
    """The newest row of each key; of rows of one time, the one with the greatest content."""
    cols = df.columns
    order = F.struct(F.col(at).isNotNull(), F.col(at), F.coalesce("content", F.lit("")))
    return df.filter(F.col(key).isNotNull()).groupBy(key).agg(F.max_by(F.struct(*cols), order).alias("_r")).select("_r.*")


def ingest(spark: SparkSession, source: str, schema: StructType, target: str, checkpoint: str, key: str = "source_file", at: str = "extracted_at", rules: CleanupRules = CleanupRules()) -> StreamingQuery:
    """Streams parquet files of documents from a folder, cleans them and appends each batch to ``target``, partitioned
    by batch. A batch that is run again after a failure replaces its own partition, so nothing comes twice; readers take
    the newest row of each key with ``current``. Ends when all files present are read."""
    stream = spark.readStream.schema(schema).parquet(source)

    def save(batch: DataFrame, number: int) -> None:
        out = latest_by(clean_phase(batch, rules), key, at).withColumn("batch", F.lit(number))
        out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch").parquet(target)

    return stream.writeStream.foreachBatch(save).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def current(spark: SparkSession, target: str, key: str = "source_file", at: str = "extracted_at") -> DataFrame:
    """The newest row of each key over all batches."""
    return latest_by(spark.read.parquet(target), key, at).drop("batch")
