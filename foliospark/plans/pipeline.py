"""The whole way from files to a searchable table and back to prompts, on top of the operators.

Models are plugged in: an embedder maps a list of texts to a list of vectors and runs in Arrow batches in the executors;
a generator maps a prompt to an answer on the driver. ``hash_embedder`` stands in where there is no model.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import Config
from ..operators import exact, retrieval, vectors
from ..registry import PARTS, lookup
from ..session import cut
from ..sources import files
from ..streaming.ingest import clean_phase

Embedder = Callable[[list[str]], list[list[float]]]
SUMMARY_CHARS = 15_000
SECTION, DOCUMENT, CHUNK = "section", "document", "chunk"


def hash_embedder(width: int = 64) -> Embedder:
    """A deterministic embedder: each word adds a pseudo-random direction, so texts with common words are alike."""

    def embed(texts: list[str]) -> list[list[float]]:
        out = []
        for t in texts:
            v = np.zeros(width)
            for w in re.findall(r"\w+", t.lower()):
                v += np.random.default_rng(xxhash.xxh3_64_intdigest(w)).normal(size=width)
            out.append((v / (np.linalg.norm(v) or 1)).astype(np.float32).tolist())
        return out

    return embed


PARTS["embedders"]["hash"] = hash_embedder


def embed(df: DataFrame, text: str, embedder: Embedder, out: str = "embedding", at_once: int = 256) -> DataFrame:
    """Adds the embedding of a column, ``at_once`` texts a call; null and empty texts have none. An error of the
    embedder fails the task, which Spark tries again."""
    from pyspark.sql.types import ArrayType, FloatType

    @F.arrow_udf(ArrayType(FloatType()))
    def run(texts: pa.Array) -> pa.Array:
        rows = texts.to_pylist()
        result: list = [None] * len(rows)
        at = [i for i, t in enumerate(rows) if t]
        for s in range(0, len(at), at_once):
            part = at[s : s + at_once]
            for i, v in zip(part, embedder([rows[j] for j in part]), strict=True):
                result[i] = v
        return pa.array(result, pa.list_(pa.float32()))

    return df.withColumn(out, run(F.col(text)))


def ingest(spark: SparkSession, config: Config, done: DataFrame | None = None) -> DataFrame:
    """Documents of the files under the targets: discovered, each content once, those in ``done`` left out, extracted
    and cleaned. Unreadable files stay as rows with an error and no phases."""
    found = files.discover(spark, config.input_targets, config.file_rules)
    if done is not None:
        found = files.unfinished(found, done)
    found = exact.without_duplicates(found, "path", F.col("content"))
    docs = files.extract(found, config.file_rules)
    cleaned = clean_phase(docs.filter("error is null"), config.cleanup) if config.clean else docs.filter("error is null")
    return cleaned.unionByName(docs.filter("error is not null"))


def index(documents: DataFrame, config: Config, embedder: Embedder, summarise: Callable[[str], str] | None = None) -> DataFrame:
    """(vector_id, filename, level, section, chunk_index, page_number, text, embedding) of all chunks and, with a
    summariser, of a summary of each document (index -1) and section (index -2)."""
    c = lookup("chunkers", config.chunks.kind)(documents, "source_file", "content", config.chunks.size, config.chunks.overlap)
    rows = c.select(F.col("source_file").alias("filename"), F.lit(CHUNK).alias("level"), "section", "chunk_index", "page_number", "text")
    if summarise is not None:
        from pyspark.sql.types import StringType

        short = F.arrow_udf(lambda texts: pa.array([summarise(t) if t else None for t in texts.to_pylist()], pa.string()), StringType())
        whole = documents.select(F.col("source_file").alias("filename"), F.lit(DOCUMENT).alias("level"), F.lit(None).cast("string").alias("section"), F.lit(-1).alias("chunk_index"), F.lit(None).cast("int").alias("page_number"), short(F.substring("content", 1, SUMMARY_CHARS)).alias("text"))
        parts = retrieval.section_texts(rows, "filename", "section", ["chunk_index"], "text")
        parts = parts.select("filename", F.lit(SECTION).alias("level"), "section", F.lit(-2).alias("chunk_index"), F.lit(None).cast("int").alias("page_number"), short(F.col("text")).alias("text"))
        rows = rows.unionByName(whole).unionByName(parts).filter("text <> ''")
    id_ = vectors.vector_id(F.col("filename"), F.col("level"), F.col("section"), F.col("chunk_index"))
    return embed(rows, "text", embedder).withColumn("vector_id", id_)


def _numbered(rows: DataFrame) -> DataFrame:
    """The rows as a table with a number of their own, which stays the same because it is written."""
    return cut(rows.withColumn("_n", F.monotonically_increasing_id()))


def add_to_store(store: DataFrame, new: DataFrame, config: Config, replace_files: bool = True) -> DataFrame:
    """The store with new rows in, by identity; with a near-copy threshold, chunks whose nearest stored vector is
    another file's near copy are left out first. New chunks are only compared with what is stored."""
    if config.retrieval.near_copy_threshold is not None:
        old, fresh = _numbered(store), _numbered(new)
        near = vectors.search(old, "_n", "embedding", fresh.select(F.col("_n").alias("q"), "embedding"), "q", "embedding", 1, config.retrieval.width)
        copies = vectors.near_copies(near, old, fresh.select(F.col("_n").alias("q"), "filename"), "_n", "q", "filename", config.retrieval.near_copy_threshold)
        new = fresh.join(copies.withColumnRenamed("q", "_n"), "_n", "left_anti").drop("_n")
    return vectors.upsert(store, new, "vector_id", "filename" if replace_files else None)


def retrieve(store: DataFrame, questions: DataFrame, embedder: Embedder, config: Config) -> DataFrame:
    """(question_id, question, rank, score, filename, page_number, section, level, text) of the best rows of the store
    for each question of ``questions(question_id, question)``."""
    asked = embed(questions, "question", embedder, "_e")
    keyed = _numbered(store)
    found = vectors.search(keyed, "_n", "embedding", asked, "question_id", "_e", config.retrieval.top_k, config.retrieval.width)
    rows = found.join(keyed.select("_n", "filename", "page_number", "section", "level", "text"), "_n").drop("_n")
    return rows.join(questions, "question_id").select("question_id", "question", "rank", "score", "filename", "page_number", "section", "level", "text")


def answer_pieces(results: DataFrame, questions: DataFrame, generate: Callable[[str, str], Iterator[str]]) -> Iterator[tuple[int, str]]:
    """(question_id, piece) as the generator gives its pieces, one question after the other; a question without results
    gets a fixed answer as one piece, and the generator isn't called."""
    described = results.withColumn("description", retrieval.describe_source(F.col("filename"), F.col("page_number"), F.col("section"), F.col("level")))
    built = retrieval.prompts(described, ["question_id"], "question", "rank", "text", "description")
    for r in questions.select("question_id").join(built, "question_id", "left").orderBy("question_id").toLocalIterator():
        for piece in generate(retrieval.INSTRUCTIONS, r.prompt) if r.prompt else [retrieval.NO_SOURCES]:
            yield r.question_id, piece


def answer(results: DataFrame, questions: DataFrame, generate: Callable[[str, str], Iterator[str]]) -> Iterator[tuple[int, str]]:
    """(question_id, answer) of each question, its pieces put together."""
    for question, pieces in groupby(answer_pieces(results, questions, generate), key=lambda p: p[0]):
        yield question, "".join(text for _, text in pieces)
