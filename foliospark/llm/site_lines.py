"""Problem 4: lines that one source repeats on page after page.

The documents that have a line are kept as a compressed bitmap for each source and spelling of the line. An id's
upper bits name a container and its lower 15 bits a place in it; a container is a sorted array of places while that is
shorter, else a bitmap of 4 KB. The bitmaps of all spellings with the same letters are united container by container,
their exact cardinalities are held against the limits, and each document looks itself up in the bitmaps that pass.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.expressions import fresh
from ..functions.textform import text_form
from ..operators.joins import salted_join
from ..session import cut

BITS = 15
PLACES = 1 << BITS
MOST_IN_ARRAY = PLACES // 16
MIN_LETTERS, MIN_DOCUMENTS, MIN_SHARE = 12, 5, 0.1
PAGE_COMMENT = re.compile(r"\s*<!--\s*page_number:\s*\d+\s*-->\s*")
NO_LETTERS = re.compile(r"[\W\d_]+")


def source_of(source_file: Column) -> Column:
    """The site or top folder, in lower case, without scheme and ``www.``; null for null."""
    return F.regexp_extract(F.lower(F.trim(source_file)), r"^(?:[a-z][a-z0-9+.-]*://)?(?:www\.)?([^/]*)", 1)


def letters_of(line: str) -> str:
    s = NO_LETTERS.sub("", line)
    if not s.isalpha():
        s = "".join(c for c in s if c.isalpha())
    return s.lower()


def line_keys(df: DataFrame, key: str, source: Column, text: str) -> DataFrame:
    """(source, id, line_no, letters, spelling) of every line with enough letters."""
    form = text_form(df.sparkSession)

    def run(batches):
        for b in batches:
            src, no, letters, spelling = [], [], [], []
            for i, text in enumerate(b.column(2).to_pylist()):
                for n, line in enumerate(form(text.replace("\r", " ")).split("\n"), 1):
                    if len(line) < MIN_LETTERS or PAGE_COMMENT.fullmatch(line):
                        continue
                    s = letters_of(line)
                    if len(s) >= MIN_LETTERS:
                        src.append(i), no.append(n), letters.append(xxhash.xxh3_128_digest(s)), spelling.append(xxhash.xxh3_64_intdigest(line) - 2**63)
            at = pa.array(src, pa.int64())
            yield pa.RecordBatch.from_arrays([b.column(0).take(at), b.column(1).take(at), pa.array(no, pa.int32()), pa.array(letters, pa.binary()), pa.array(spelling, pa.int64())], names=["source", "id", "line_no", "letters", "spelling"])

    rows = df.select(source.alias("source"), F.col(key).cast("long").alias("id"), F.col(text).alias("text")).filter("source is not null and id is not null and text <> ''")
    return rows.mapInArrow(run, "source string, id long, line_no int, letters binary, spelling long")


def _to_bits(places: np.ndarray) -> np.ndarray:
    bits = np.zeros(PLACES, bool)
    bits[places] = True
    return np.packbits(bits, bitorder="little")


def _united(spellings: DataFrame) -> DataFrame:
    """(source, letters, box, few, bits, n): containers united over spellings. Rows arrive sorted by container, so one
    running container is held at a time, however many spellings it has."""

    def run(batches):
        key, held = None, None

        def ended(out):
            if key is not None:
                out[0].append(key[0]), out[1].append(key[1]), out[2].append(key[2])
                dense = held.dtype == np.uint8
                n = int(np.unpackbits(held).sum()) if dense else len(held)
                out[3].append(None if dense else held.tolist()), out[4].append(held.tobytes() if dense else None), out[5].append(n)

        def batch(out):
            return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(out, (pa.string(), pa.binary(), pa.int64(), pa.list_(pa.int32()), pa.binary(), pa.int64()))], names=["source", "letters", "box", "few", "bits", "n"])

        for b in batches:
            out = [[], [], [], [], [], []]
            for s, k, x, places in zip(*(b.column(i).to_pylist() for i in range(4))):
                new = np.array(places, np.int32)
                if key == (s, k, x):
                    if held.dtype == np.uint8:
                        held = held | _to_bits(new)
                    else:
                        held = np.union1d(held, new)
                else:
                    ended(out)
                    key, held = (s, k, x), np.sort(new)
                if held.dtype != np.uint8 and len(held) > MOST_IN_ARRAY:
                    held = _to_bits(held)
            yield batch(out)
        out = [[], [], [], [], [], []]
        ended(out)
        yield batch(out)

    return spellings.mapInArrow(run, "source string, letters binary, box long, few array<int>, bits binary, n long")


def site_line_bitmaps(lines: DataFrame, totals: DataFrame, least: int = MIN_DOCUMENTS, share: float = MIN_SHARE) -> DataFrame:
    """(source, letters, box, few, bits): the containers of the lines that are repeated within their source.

    ``totals`` has (source, documents). A line counts once a document.
    """
    box, place = F.shiftright("id", BITS), F.col("id").bitwiseAND(F.lit(PLACES - 1)).cast("int")
    spellings = lines.select("source", "letters", "spelling", box.alias("box"), place.alias("at"))
    spellings = spellings.groupBy("source", "letters", "spelling", "box").agg(F.collect_set("at").alias("places"))
    spellings = spellings.select("source", "letters", "box", "places").repartition("source", "letters", "box").sortWithinPartitions("source", "letters", "box")
    boxes = cut(_united(spellings))
    counts = boxes.groupBy("source", "letters").agg(F.sum("n").alias("n")).filter(F.col("n") >= least)
    kept = counts.join(totals, "source").filter(F.col("n") >= share * F.col("documents"))
    return boxes.join(kept.select("source", "letters"), ["source", "letters"], "left_semi").drop("n")


def _has(id_: Column, few: Column, bits: Column) -> Column:
    at = id_.bitwiseAND(F.lit(PLACES - 1)).cast("int")
    byte = F.conv(F.hex(F.substring(bits, F.shiftright(at, 3) + 1, F.lit(1))), 16, 10).cast("int")
    return F.when(bits.isNotNull(), F.call_function("getbit", byte, at.bitwiseAND(F.lit(7))) == 1).otherwise(F.array_contains(few, at))


def site_lines(df: DataFrame, key: str, source_file: str, text: str) -> DataFrame:
    """(key, line_no) of the lines that are repeated within their source.

    A line is repeated if it occurs in at least five documents and a tenth of all documents of its source, those
    without a text included. Lines are the same if their letters are, in consistent form and lower case; lines of fewer
    than 12 letters and page comments never count. Rows without a source or key have no line. An empty table gives an
    empty result.
    """
    source = source_of(F.col(source_file))
    lines = cut(line_keys(df, key, source, text))
    totals = df.select(source.alias("source")).filter("source is not null").groupBy("source").agg(F.count("*").alias("documents"))
    kept = cut(site_line_bitmaps(lines, totals))
    here = lines.select("source", "letters", F.shiftright("id", BITS).alias("box"), "id", "line_no")
    met = salted_join(here, kept, ["source", "letters", "box"], F.col("id"), 4)
    return met.filter(_has(F.col("id"), F.col("few"), F.col("bits"))).select(F.col("id").alias(key), "line_no")


def without_site_lines(df: DataFrame, key: str, source_file: str, text: str) -> DataFrame:
    """``df`` with ``text`` freed of the lines that its source repeats. Null and empty texts stay as they are."""
    found = fresh(df.columns, "_lines")
    out = site_lines(df, key, source_file, text).groupBy(key).agg(F.collect_set("line_no").alias(found))
    numbered = F.filter(F.split(F.col(text), "\n", -1), lambda line, i: ~F.array_contains(found, i + 1))
    return df.join(out, key, "left").withColumn(text, F.when(F.col(found).isNull(), F.col(text)).otherwise(F.array_join(numbered, "\n"))).select(*df.columns)
