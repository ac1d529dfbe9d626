"""Chunks of Markdown: split at headers, then at the widest separator that makes pieces small enough, with overlap."""

from __future__ import annotations

import re

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import expressions as X

SIZE, OVERLAP = 1000, 200
SEPARATORS = ("\n\n", "\n", " ", "")
HEADERS = (("#", 1), ("##", 2), ("###", 3))
PAGE_MARK = r"<!-- page_number: (\d+) -->"


def page_mark(page: Column) -> Column:
    return F.concat(F.lit("<!-- page_number: "), page.cast("string"), F.lit(" -->"))


def sections(text: str, headers=HEADERS) -> list[tuple[str, dict[int, str]]]:
    """(content, titles by level) of each stretch under the same headers, the header line kept at its start. Headers
    inside fenced code are text. A header with nothing but a deeper header after it stays with that one."""
    marks = dict(headers)
    out: list[tuple[list[str], dict[int, str]]] = []
    stack: dict[int, str] = {}
    now: list[str] = []
    fence = ""

    def flush() -> None:
        if any(x.strip() for x in now):
            out.append((now.copy(), dict(stack)))
        now.clear()

    for raw in text.split("\n"):
        line = raw.strip()
        if fence:
            fence = "" if line.startswith(fence) else fence
        elif line.startswith(("```", "~~~")) and line.count(line[:3]) == 1:
            fence = line[:3]
        elif (m := re.match(r"(#+)(?:\s+|$)", line)) and m[1] in marks:
            only_header = bool(now) and len(now) == 1 and now[0].startswith("#")
            if not (only_header and marks[m[1]] > max(stack, default=0)):
                flush()
            level = marks[m[1]]
            stack = {k: v for k, v in stack.items() if k < level} | {level: line[len(m[1]) :].strip()}
        if line or now:
            now.append(line)
    flush()
    return [("\n".join(lines).strip("\n"), titles) for lines, titles in out]


def pieces(text: str, size: int = SIZE, overlap: int = OVERLAP, separators: tuple[str, ...] = SEPARATORS) -> list[str]:
    """Pieces of at most ``size`` characters, each but the first beginning with up to ``overlap`` of the one before.

    The first separator that occurs splits the text and stays at the start of what follows it; parts that are still
    too large are split by the next one, and small parts are joined while they fit. Pieces are stripped; empty ones go.
    """
    if overlap > size:
        raise ValueError("the overlap must not exceed the size")
    at = next((i for i, s in enumerate(separators) if s == "" or s in text), len(separators) - 1)
    mark, rest = separators[at], separators[at + 1 :]
    if mark:
        first, *others = text.split(mark)
        parts = [p for p in (first, *(mark + o for o in others)) if p]
    else:
        parts = list(text)
    out: list[str] = []
    small: list[str] = []

    def merge() -> None:
        held: list[str] = []
        n = 0
        for p in small:
            if held and n + len(p) > size:
                out.append("".join(held).strip())
                while held and (n > overlap or n + len(p) > size):
                    n -= len(held.pop(0))
            held.append(p)
            n += len(p)
        if held:
            out.append("".join(held).strip())
        small.clear()

    for p in parts:
        if len(p) < size or (len(p) == size and not rest):
            small.append(p)
        else:
            merge()
            out.extend(pieces(p, size, overlap, rest) if rest else [p.strip()])
    merge()
    return [p for p in out if p]


def split_markdown(df: DataFrame, key: str, text: str, size: int = SIZE, overlap: int = OVERLAP, headers=HEADERS) -> DataFrame:
    """(key, split, text, h1, h2, h3) of all splits of each text, in order; none for null and blank texts."""
    kind = df.schema[key].dataType.simpleString()
    levels = [level for _, level in headers]

    def run(batches):
        for b in batches:
            cols: list[list] = [[], [], [], [], [], []]
            for i, t in enumerate(b.column(1).to_pylist()):
                n = 0
                for content, titles in sections(t or "", headers):
                    for p in pieces(content, size, overlap):
                        for c, v in zip(cols, (i, n, p, *(titles.get(x) for x in (1, 2, 3)))):
                            c.append(v)
                        n += 1
            arrays = [b.column(0).take(pa.array(cols[0], pa.int64())), pa.array(cols[1], pa.int32()), *(pa.array(c, pa.string()) for c in cols[2:])]
            yield pa.RecordBatch.from_arrays(arrays, names=[key, "split", "text", "h1", "h2", "h3"])

    if any(level not in (1, 2, 3) for level in levels):
        raise ValueError("header levels are 1 to 3")
    return df.select(key, F.col(text).alias("_t")).mapInArrow(run, f"`{key}` {kind}, split int, text string, h1 string, h2 string, h3 string")


def split_fixed(df: DataFrame, key: str, text: str, size: int = SIZE, overlap: int = OVERLAP) -> DataFrame:
    """(key, split, text): each text in windows of ``size`` characters, each but the first beginning ``overlap`` characters
    before the end of the one before. Windows are stripped; blank ones are left out, and the rest numbered from 0. Null
    and empty texts have none."""
    step = size - overlap
    if step < 1:
        raise ValueError("the overlap must be less than the size")
    n = F.when(F.length(text) <= size, 1).otherwise(1 + F.ceil((F.length(text) - size) / step)).cast("int")
    windows = F.transform(F.sequence(F.lit(0), n - 1), lambda i: X.strip(F.substring(F.col(text), i * step + 1, F.lit(size))))
    return df.filter(F.col(text) != "").select(key, F.posexplode(F.filter(windows, lambda w: w != "")).alias("split", "text"))


def number_chunks(splits: DataFrame, key: str, page: Column | None = None) -> DataFrame:
    """(key, chunk_index, page_number, section, text) from splits (key, split, text, h1, h2, h3).

    A chunk's page is the last mark in it, else that of the split before, dropped ones included; ``page``, where not
    null, overrides it. Marks leave the text; splits that are empty then are dropped, and the rest numbered from 0. The
    section is the deepest header.
    """
    order = Window.partitionBy(key).orderBy("split")
    marks = F.regexp_extract_all("text", F.lit(PAGE_MARK), F.lit(1))
    own = F.try_element_at(marks, F.lit(-1)).cast("int")
    carried = F.last(own, ignorenulls=True).over(order.rowsBetween(Window.unboundedPreceding, 0))
    number = F.coalesce(page.cast("int"), carried) if page is not None else carried
    bare = X.strip(F.regexp_replace(F.regexp_replace("text", PAGE_MARK, ""), r"\n{3,}", "\n\n"))
    out = splits.select(key, "split", number.alias("page_number"), F.coalesce("h3", "h2", "h1").alias("section"), bare.alias("text")).filter("text <> ''")
    return out.select(key, (F.row_number().over(order) - 1).alias("chunk_index"), "page_number", "section", "text")


def chunk_markdown(df: DataFrame, key: str, text: str, size: int = SIZE, overlap: int = OVERLAP) -> DataFrame:
    """Chunks of each text; see ``split_markdown`` and ``number_chunks``. Windows hold one document's splits."""
    return number_chunks(split_markdown(df, key, text, size, overlap), key)


def chunk_fixed(df: DataFrame, key: str, text: str, size: int = SIZE, overlap: int = OVERLAP) -> DataFrame:
    """Chunks of fixed windows, numbered as those of ``chunk_markdown``; they have no section."""
    none = F.lit(None).cast("string")
    return number_chunks(split_fixed(df, key, text, size, overlap).select(key, "split", "text", none.alias("h1"), none.alias("h2"), none.alias("h3")), key)
