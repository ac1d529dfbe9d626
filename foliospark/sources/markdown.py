"""Markdown with front matter: reading, writing, and what its marks and headings tell."""

from __future__ import annotations

import json

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, MapType, StringType, StructField, StructType

from ..functions import expressions as X
from .files import mounted

try:
    import yaml
except ImportError:  # front matter of plain ``key: value`` lines still works
    yaml = None

PARSED = StructType([StructField("metadata", MapType(StringType(), StringType())), StructField("phases", ArrayType(StringType())), StructField("ok", StringType())])


def _load(text: str) -> dict:
    if yaml is not None:
        got = yaml.safe_load(text)
    else:
        got = dict(line.split(":", 1) for line in text.splitlines() if ":" in line)
        got = {k.strip(): v.strip() for k, v in got.items()}
    if got is None:
        return {}
    if not isinstance(got, dict):
        raise ValueError("front matter is no mapping")
    return got


def scalar(value: object) -> str | None:
    """A metadata value as a string: text as it is, nested values as JSON."""
    if value is None or isinstance(value, str):
        return value
    return str(value) if not isinstance(value, (dict, list)) else json.dumps(value, ensure_ascii=False, default=str)


def split_front_matter(df: DataFrame, text: str, strip: bool = False) -> DataFrame:
    """``df`` with content STRING, metadata MAP<STRING,STRING> and pipeline_phases ARRAY<STRING> of column ``text``.

    Front matter stands between the first two ``---`` of a text that begins with one. Its absence or invalid YAML
    leaves the whole text as content and no metadata. The body loses white space at its start and, with ``strip``, at
    its end. Null texts have null content.
    """
    kind = pa.struct([("metadata", pa.map_(pa.string(), pa.string())), ("phases", pa.list_(pa.string())), ("ok", pa.string())])

    @F.arrow_udf(PARSED)
    def parsed(heads: pa.Array) -> pa.Array:
        out = []
        for h in heads.to_pylist():
            try:
                meta = _load(h) if h is not None else {}
                phases = meta.get("pipeline_phases")
                out.append({"metadata": [(str(k), scalar(v)) for k, v in meta.items()], "phases": [str(p) for p in phases] if isinstance(phases, list) else None, "ok": "y" if h is not None else "n"})
            except Exception:  # invalid YAML is content
                out.append({"metadata": [], "phases": None, "ok": "n"})
        return pa.array(out, kind)

    parts = F.split(text, "---", 3)
    head = F.when(F.startswith(F.col(text), F.lit("---")) & (F.size(parts) == 3), parts[1])
    front, got = X.fresh(df.columns, "_head"), X.fresh(df.columns, "_p")
    out = df.withColumn(front, head).withColumn(got, parsed(F.col(front)))
    fine = F.col(got)["ok"] == "y"
    body = F.when(fine, parts[2]).otherwise(F.col(text))
    body = X.strip(body) if strip else F.when(fine, F.regexp_replace(body, rf"\A{X.SPACE}+", "")).otherwise(body)
    return out.withColumns({"content": body, "metadata": F.col(got)["metadata"], "pipeline_phases": F.col(got)["phases"]}).drop(front, got)


def read_markdown(spark: SparkSession, path: str, strip: bool = False) -> DataFrame:
    """(path, stem, source_file, content, metadata, pipeline_phases) of every ``.md`` file under a path."""
    raw = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path).filter(F.lower("path").endswith(".md"))
    name = F.element_at(F.split(F.url_decode(F.replace("path", F.lit("+"), F.lit("%2B"))), "/"), -1)
    rows = raw.select("path", name.alias("source_file"), F.try_validate_utf8(F.col("content").cast("string")).alias("_raw"))
    out = split_front_matter(rows, "_raw", strip).withColumn("stem", F.regexp_replace("source_file", r"\.[^.]*$", ""))
    return out.select("path", "stem", "source_file", "content", "metadata", "pipeline_phases")


def with_front_matter(content, metadata):
    """Column: the content behind its metadata as front matter, one JSON-quoted value a line, in key order."""
    pairs = F.array_sort(F.map_entries(F.coalesce(metadata, F.create_map().cast("map<string,string>"))))
    lines = F.transform(pairs, lambda p: F.concat(p["key"], F.lit(": "), F.coalesce(F.to_json(F.array(p["value"])), F.lit("null"))))
    lines = F.transform(lines, lambda x: F.regexp_replace(F.regexp_replace(x, r": \[(.*)\]$", ": $1"), r": \[null\]$", ": null"))
    return F.concat(F.lit("---\n"), F.array_join(lines, "\n"), F.when(F.size(pairs) > 0, "\n").otherwise(""), F.lit("---\n\n"), content)


def write_markdown(df: DataFrame, path: str, name: str, content: str, metadata: str) -> None:
    """One ``.md`` file a row under a shared, mounted folder, written by the executors; parquet is better for anything large."""
    rows = df.select(F.col(name).alias("name"), with_front_matter(F.col(content), F.col(metadata)).alias("text"))
    root = mounted(path)

    def save(part):
        from pathlib import Path

        for r in part:
            to = Path(root, f"{Path(r.name).name}.md")
            to.parent.mkdir(parents=True, exist_ok=True)
            tmp = to.with_suffix(".tmp")
            tmp.write_text(r.text or "", encoding="utf-8")
            tmp.replace(to)

    rows.foreachPartition(save)


def pages_of(df: DataFrame, key: str, text: str) -> DataFrame:
    """(key, i, text): the pages of each text, cut at page comments and form feeds, numbered from 0."""
    body = F.regexp_replace(text, r"\A\s*<!-- page_number: \d+ -->\n?", "")
    pages = F.split(body, r"\n?(?:<!-- page_number: \d+ -->|\x0c)\n?", -1)
    return df.filter(F.col(text) != "").select(key, F.posexplode(pages).alias("i", "text"))


def toc_of(df: DataFrame, key: str, text: str) -> DataFrame:
    """(key, line, level, title) of each Markdown heading, lines numbered from 1."""
    lines = df.filter(F.col(text).isNotNull()).select(key, F.posexplode(F.split(text, "\n", -1)).alias("n", "t")).filter(F.col("t").rlike(r"^#{1,6}[ \t]+\S"))
    return lines.select(key, (F.col("n") + 1).alias("line"), F.length(F.regexp_extract("t", r"^(#{1,6})[ \t]", 1)).alias("level"), F.trim(F.regexp_extract("t", r"^#{1,6}[ \t]+(.*)$", 1)).alias("title"))
