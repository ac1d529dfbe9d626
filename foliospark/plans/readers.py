"""Queries that read files. Each document's lines are written as a small file of some format, and the readers take it from
there: what comes out is compared with what SQL makes of the same lines."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import audit
from ..session import texts
from ..sources import epub, files, make, pdf
from ..sources.markdown import toc_of

# Blanks of all kinds and control characters, which not every format can hold, become one blank in every line.
BLANKS = r"[\s\x00-\x1f\x7f\x85\p{Z}￾￿]+"
KINDS = list(make.KINDS)


def _lines(text: Column) -> Column:
    return F.filter(F.transform(F.split(F.coalesce(text, F.lit("")), "\n"), lambda x: F.trim(F.regexp_replace(x, BLANKS, " "))), lambda x: x != "")


def _files(spark: SparkSession, sf_dir: str, kind: str | None = None, **options) -> DataFrame:
    """(path, content): a file of each document, of one kind or of all in turn."""
    rows = texts(spark, sf_dir, "documents", "doc_id", "text").select("doc_id", _lines(F.col("text")).alias("lines"))

    def run(batches):
        for b in batches:
            ids = b.column(0).to_pylist()
            kinds = [kind or KINDS[i % len(KINDS)] for i in ids]
            for s in range(0, len(ids), 200):
                some = range(s, min(s + 200, len(ids)))
                contents = [make.KINDS[kinds[i]](b.column(1)[i].as_py(), **options) for i in some]
                yield pa.RecordBatch.from_arrays([pa.array([f"in/doc_{ids[i]}.{kinds[i]}" for i in some]), pa.array(contents, pa.binary())], names=["path", "content"])

    return rows.mapInArrow(run, "path string, content binary")


def _id(path: str = "path") -> Column:
    return F.regexp_extract(path, r"doc_(\d+)\.", 1).cast("long").alias("doc_id")


def extract_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A file of each document, every format in turn, found by its extension and read. PDFs without enough text have
    no reader here and are errors."""
    docs = files.extract(_files(spark, sf_dir))
    return docs.select(_id(), "reader", "content", F.col("error").isNotNull().alias("failed"), F.size("assets").alias("n_assets"))


def html_headings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The headings of every document as a web page."""
    docs = files.extract(_files(spark, sf_dir, "html")).select(_id(), "content")
    return toc_of(docs, "doc_id", "content").select("doc_id", "level", "title").groupBy("doc_id", "level", "title").agg(F.count("*").alias("times"))


def pdf_text_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pages of every document as a PDF of three pages."""
    found = pdf.pdf_pages(_files(spark, sf_dir, "pdf", pages=3))
    return found.select(_id(), "i", "text", "width", "height", F.array_join("fonts", ",").alias("fonts"), "producer")


def _kinds_of_pdf(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Page tables of PDFs with LaTeX fonts, with page images, and from several tools."""
    made = {"latex": {"fonts": ("ABCDEF+CMR10", "CMMI7"), "label": "A"}, "scan": {"covered": True, "producer": "ABBYY FineReader"}, "plain": {"producer": "calibre 7"}}
    rows = texts(spark, sf_dir, "documents", "doc_id", "text").select("doc_id", _lines(F.col("text")).alias("lines"))

    def run(batches):  # all three of a document at once, so that its lines are read and cleaned once
        for b in batches:
            ids = b.column(0).to_pylist()
            for s in range(0, len(ids), 200):
                some = range(s, min(s + 200, len(ids)))
                lines = [b.column(1)[i].as_py() for i in some]
                names = [f"in/{name}/doc_{ids[i]}.pdf" for i in some for name in made]
                yield pa.RecordBatch.from_arrays([pa.array(names), pa.array([make.pdf(x, pages=2, **options) for x in lines for options in made.values()], pa.binary())], names=["path", "content"])

    found = pdf.pdf_pages(rows.mapInArrow(run, "path string, content binary"))
    return found.withColumn("doc", F.concat_ws(":", F.regexp_extract("path", r"in/(\w+)/", 1), _id()))


def pdf_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Measurements and origin of PDFs by their fonts, images, labels and metadata."""
    m = audit.page_metrics(_kinds_of_pdf(spark, sf_dir), "doc", keep=("producer",), count="page_count")
    o = audit.origin(F.col("producer"), F.col("full_page_image_share"), F.col("avg_chars_per_page"), F.col("latex_font_page_share"))
    return m.select("doc", "pages", "avg_chars_per_page", "has_text_layer", "image_only_page_share", "full_page_image_share", "latex_font_page_share", "math_font_page_share", "page_labels", o["origin"].alias("origin"))


def pdf_outlines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The outline of every document's PDF and its depth."""
    found = pdf.pdf_outline(_files(spark, sf_dir, "pdf", outline=("Contents", "Index")))
    return audit.toc_depth(found.select(_id(), "level"), "doc_id", "level")


def epub_measures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Measurements of every document as an EPUB, from the table of what was seen in it."""
    m = epub.measured(files.epub_facts(_files(spark, sf_dir, "epub")), "path")
    return m.select(_id(), "spine_documents", "linear_documents_with_text", "documents_with_headings", "text_chars", "toc_entries", "toc_depth", "drm", "maths_mode")


def file_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which files can be measured: a file of each document, of which every seventh is cut short."""
    made = _files(spark, sf_dir)
    content = F.when(_id() % 7 == 0, F.substring("content", 1, 8)).otherwise(F.col("content"))
    return files.audited(made.select("path", content.alias("content"))).select(_id(), "format", "supported", F.get_json_object("metrics", "$.title").alias("title"), F.col("error").isNotNull().alias("failed"))


QUERIES = {f.__name__: f for f in (extract_files, html_headings, pdf_text_pages, pdf_audit, pdf_outlines, epub_measures, file_audit)}

_BLANKS = r"[\s\x00-\x1f\x7f\x85\p{Z}￾￿]+"
_LINES = rf"""d AS MATERIALIZED (SELECT doc_id, list_filter(list_transform(string_split(coalesce(text, ''), chr(10)), lambda x: trim(regexp_replace(x, '{_BLANKS}', ' ', 'g'))), lambda x: x <> '') AS l FROM documents)"""
_kind = lambda *names: "doc_id % " + str(len(KINDS)) + " IN (" + ", ".join(str(KINDS.index(n)) for n in names) + ")"
_PARAGRAPHS = "array_to_string(l, chr(10) || chr(10))"
_ROWS = "array_to_string(['| n | text |', '|---|---|'] || list_transform(l, lambda x, i: '| ' || i || ' | ' || x || ' |'), chr(10))"
_PDF = "'<!-- page_number: 1 -->' || chr(10) || array_to_string(l, chr(10))"
_DENSE = "length(array_to_string(l, chr(10))) >= 100"
_READERS = {"html": "html", "docx": "docx", "xlsx": "xlsx", "pptx": "pptx", "odt": "odf", "epub": "epub", "txt": "text", "csv": "text", "zip": "zip", "png": "image", "pdf": "pdf"}
_PAGES = "p AS (SELECT doc_id, l, i, array_to_string(l[i * ceil(len(l) / {n})::INT + 1:(i + 1) * ceil(len(l) / {n})::INT], chr(10)) AS t FROM d, (SELECT unnest(range({n}))::INT AS i))"
SQL = {
    "extract_files": rf"""WITH {_LINES} SELECT doc_id, CASE {" ".join(f"WHEN {_kind(k)} THEN '{r}'" for k, r in _READERS.items())} END AS reader, CASE WHEN {_kind("html", "docx", "epub")} THEN {_PARAGRAPHS}
      WHEN {_kind("xlsx")} THEN CASE WHEN len(l) = 0 THEN '' ELSE '## Sheet: lines' || chr(10) || chr(10) || {_ROWS} || chr(10) || chr(10) || '---' || chr(10) END
      WHEN {_kind("pptx")} THEN array_to_string(['<!-- Slide number: 1 -->'] || l, chr(10)) WHEN {_kind("odt")} THEN array_to_string(['## Head'] || l, chr(10) || chr(10)) WHEN {_kind("txt")} THEN regexp_replace(array_to_string(l, chr(10)), '\A\x{{FEFF}}', '')
      WHEN {_kind("csv")} THEN {_ROWS} WHEN {_kind("zip")} THEN '# Archive Extracted' || chr(10) || chr(10) || 'Extracted 2 files to `doc_' || doc_id || '_unpacked`:' || chr(10) || '- lines.txt' || chr(10) || '- sub/more.txt' || chr(10)
      WHEN {_kind("png")} THEN '![doc_' || doc_id || '](../assets/doc_' || doc_id || '/doc_' || doc_id || '.png)' || chr(10) WHEN {_DENSE} THEN {_PDF} ELSE '' END AS content,
      {_kind("pdf")} AND NOT {_DENSE} AS failed, CASE WHEN {_kind("zip")} THEN 2 WHEN {_kind("png")} THEN 1 ELSE 0 END::INT AS n_assets FROM d""",
    "html_headings": rf"""WITH {_LINES}, h AS (SELECT doc_id, unnest(list_filter(l, lambda x: regexp_matches(x, '^#{{1,6}} \S'))) AS x FROM d)
      SELECT doc_id, length(regexp_extract(x, '^#+'))::INT AS level, regexp_extract(x, '^#+ (.*)$', 1) AS title, count(*) AS times FROM h GROUP BY ALL""",
    "pdf_text_pages": f"WITH {_LINES}, {_PAGES.format(n=3)} SELECT doc_id, i, t AS text, 612.0::DOUBLE AS width, 792.0::DOUBLE AS height, 'Body' AS fonts, 'maker' AS producer FROM p",
    "pdf_audit": f"""WITH {_LINES}, {_PAGES.format(n=2)}, m AS (SELECT doc_id, avg(length(t)) AS a, count_if(length(t) < 100) AS low FROM p GROUP BY 1), k AS (SELECT unnest(['latex', 'scan', 'plain']) AS made)
      SELECT made || ':' || doc_id AS doc, 2::INT AS pages, round_even(a, 0)::BIGINT AS avg_chars_per_page, a >= 100 AS has_text_layer, CASE WHEN made = 'scan' THEN low / 2 ELSE 0 END::DOUBLE AS image_only_page_share, (made = 'scan')::INT::DOUBLE AS full_page_image_share,
      (made = 'latex')::INT::DOUBLE AS latex_font_page_share, (made = 'latex')::INT::DOUBLE AS math_font_page_share, made = 'latex' AS page_labels,
      CASE made WHEN 'latex' THEN 'typeset' WHEN 'plain' THEN 'converted' ELSE CASE WHEN round_even(a, 0) >= 100 THEN 'scan_ocr' ELSE 'scan_image_only' END END AS origin FROM m, k""",
    "file_audit": f"""SELECT doc_id, CASE {" ".join(f"WHEN {_kind(k)} THEN '{k}'" for k in KINDS)} END AS format, {_kind("pdf", "epub")} AND doc_id % 7 <> 0 AS supported,
      CASE WHEN doc_id % 7 = 0 THEN NULL WHEN {_kind("epub")} THEN 'Book' WHEN {_kind("pdf")} THEN 'Büch' END AS title, {_kind("pdf", "epub")} AND doc_id % 7 = 0 AS failed FROM documents""",
    "pdf_outlines": "SELECT doc_id, 2::BIGINT AS toc_entries, 1::INT AS toc_depth FROM documents",
    "epub_measures": f"""WITH {_LINES} SELECT doc_id, 1::BIGINT AS spine_documents, (len(l) > 0)::BIGINT AS linear_documents_with_text, 0::BIGINT AS documents_with_headings, length(array_to_string(l, ' '))::BIGINT AS text_chars,
      len(l)::BIGINT AS toc_entries, 1::INT AS toc_depth, false AS drm, 'none_detected' AS maths_mode FROM d""",
}
