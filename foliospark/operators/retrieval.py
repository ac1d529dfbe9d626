"""Retrieval: prompts, displayed results, section texts, and recall against golden questions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import expressions as X
from .joins import SALTS, salted_join

PAGE_TOLERANCE = 2
SECTION_CHARS, SNIPPET_CHARS = 8000, 200
NO_SOURCES = "No indexed passage is relevant to this question, so it can't be answered from the sources."
INSTRUCTIONS = "Answer from the numbered passages only, cite them by number in square brackets, and say so where they don't hold the answer."


def describe_source(filename: Column, page: Column, section: Column, level: Column) -> Column:
    """File, page or ``page unknown``, section and, for summaries, their level."""
    name = F.coalesce(F.when(filename != "", filename), F.lit("unknown file"))
    where = F.coalesce(F.concat(F.lit("page "), page.cast("string")), F.lit("page unknown"))
    part = F.when(section != "", F.concat(F.lit("section: "), section))
    summary = F.when(level.isin("document", "section"), F.concat(level, F.lit(" summary")))
    return F.concat_ws(", ", name, where, part, summary)


def prompts(results: DataFrame, question_key: list[str], question: str, rank: str, text: str, description: str) -> DataFrame:
    """(question_key, sources, prompt): the passages of each question in order of rank, numbered from 1, then the
    question. A question has a few ranked rows; null texts count as empty."""
    block = F.struct(F.col(rank).alias("r"), F.col(description).alias("d"), X.strip(F.coalesce(text, F.lit(""))).alias("t"))
    out = results.groupBy(*question_key).agg(F.first(question).alias("_q"), F.sort_array(F.collect_list(block)).alias("_b"))
    numbered = F.transform("_b", lambda b, i: F.concat(F.lit("["), (i + 1).cast("string"), F.lit("] ("), b["d"], F.lit(")\n"), b["t"]))
    whole = F.concat(F.lit("Context passages:\n\n"), F.array_join(numbered, "\n\n"), F.lit("\n\nQuestion: "), F.col("_q"))
    return out.select(*question_key, F.size("_b").alias("sources"), whole.alias("prompt"))


def snippet(text: Column, chars: int = SNIPPET_CHARS) -> Column:
    """The start of a text on one line, with dots if there is more."""
    return F.concat(F.replace(F.substring(text, 1, chars), F.lit("\n"), F.lit(" ")), F.when(F.length(text) > chars, "...").otherwise(""))


def page_matches(expected: Column, page: Column, tolerance: int = PAGE_TOLERANCE) -> Column:
    return expected.isNull() | page.isNull() | (F.abs(page - expected) <= tolerance)


def recall_hits(results: DataFrame, golden: DataFrame, key: str, top_k: int = 5, tolerance: int = PAGE_TOLERANCE) -> DataFrame:
    """(key, hit, hit_rank) of every golden item with an expected source: whether one of its ``top_k`` results is of
    that file and, where both pages are known, within the tolerance. Items without results are misses."""
    few = golden.filter("expected_source is not null").select(key, "expected_source", "expected_page")
    met = salted_join(results.filter(F.col("rank") <= top_k).select(key, "rank", "filename", "page_number"), few, [key], F.col("rank"))
    ok = met.filter((F.col("filename") == F.col("expected_source")) & page_matches(F.col("expected_page"), F.col("page_number"), tolerance))
    best = ok.groupBy(key).agg(F.min("rank").alias("hit_rank"))
    return few.join(best, key, "left").select(key, F.col("hit_rank").isNotNull().alias("hit"), "hit_rank")


def recall(hits: DataFrame) -> DataFrame:
    """(questions, hits, recall); recall is null without questions."""
    n = F.count("*")
    return hits.agg(n.alias("questions"), F.count_if("hit").alias("hits"), F.round(F.try_divide(F.count_if("hit"), n), 6).alias("recall"))


def section_texts(chunks: DataFrame, file: str, section: str, order: list[str], text: str, chars: int = SECTION_CHARS) -> DataFrame:
    """(file, section, chunks, text): the chunks of each named section of a file joined by line ends, in order, and cut
    at ``chars``. Chunks without section or text are left out; equal titles in one file are one section.

    A section of any size is fine: of each of its salted parts only the first ``chars`` chunks, which hold at least
    as many characters, go on, and only those that begin within the limit are gathered.
    """
    named = chunks.filter((F.col(section) != "") & F.col(text).isNotNull()).select(file, section, *order, F.col(text).alias("_t"))
    counts = named.groupBy(file, section).agg(F.count("*").alias("chunks"))
    salted = named.withColumn("_salt", F.pmod(F.xxhash64(*order), F.lit(SALTS)))
    rank = F.row_number().over(Window.partitionBy(file, section, "_salt").orderBy(*order))
    few = salted.withColumn("_r", rank).filter(F.col("_r") <= chars)
    total = F.sum(F.length("_t") + 1).over(Window.partitionBy(file, section).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1))
    few = few.withColumn("_before", F.coalesce(total, F.lit(0))).filter(F.col("_before") < chars)
    out = few.groupBy(file, section).agg(F.sort_array(F.collect_list(F.struct(*order, "_t"))).alias("_l")).join(counts, [file, section])
    return out.select(file, section, "chunks", F.substring(F.array_join(F.transform("_l", lambda x: x["_t"]), "\n"), 1, chars).alias("text"))
