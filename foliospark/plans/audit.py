"""Queries that measure sources. Pages come from the page marks of extracts, file names from fields of documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import audit, images
from ..session import table
from ..sources.markdown import pages_of, toc_of


def _names(spark: SparkSession, sf_dir: str) -> DataFrame:
    isbn = F.concat(F.lit("978-0-"), F.lpad(F.col("doc_id").cast("string"), 8, "0"), F.lit("-"), (F.col("doc_id") % 10).cast("string"))
    name = F.concat_ws(" -- ", "source", "kind", F.concat(F.lit("2nd ed., "), (1795 + F.col("doc_id") % 250).cast("string")), isbn, F.md5("text"), F.lit("Anna's Archive.pdf"))
    return table(spark, sf_dir, "documents").select("doc_id", "source", name.alias("name"))


def filename_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = _names(spark, sf_dir).select("doc_id", audit.parse_name(F.col("name")).alias("p"))
    return p.select("doc_id", "p.is_archive_name", "p.title", "p.authors", "p.year", "p.md5", F.array_join("p.isbns", ",").alias("isbns"), F.array_join("p.other", "|").alias("other"))


def same_edition(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "documents").filter("source is not null").select("source", "doc_id", F.when(F.col("doc_id") % 5 != 0, F.array(F.concat(F.lit("978"), F.lpad((F.col("doc_id") % 2).cast("string"), 10, "0")), F.lit("9781234567890"))).otherwise(F.array().cast("array<string>")).alias("isbns"))
    out = audit.shared_isbns(c, "source", "doc_id", "isbns")
    return out.select("source", "status", F.array_join("shared", ",").alias("shared"))


def isbns_in_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ISBNs found in documents, each of which gets one in its last line, with hyphens and as it is."""
    d = table(spark, sf_dir, "documents")
    tail = F.concat(F.lit("\nISBN 978-0-"), F.lpad(F.col("doc_id").cast("string"), 8, "0"), F.lit("-7 or "), F.lpad(F.col("doc_id").cast("string"), 9, "1"), F.lit("x."))
    return d.select("doc_id", F.array_join(audit.isbns(F.concat(F.coalesce("text", F.lit("")), tail)), ",").alias("isbns"))


def page_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.page_metrics(pages_of(table(spark, sf_dir, "extracts"), "extract_id", "content"), "extract_id")


def first_pages_density(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = audit.first_pages_density(pages_of(table(spark, sf_dir, "extracts"), "extract_id", "content"), "extract_id")
    return out.select("extract_id", F.round("avg_chars", 6).alias("avg_chars"), (F.col("avg_chars") >= audit.CHARS_PER_PAGE).alias("has_text_layer"))


def pdf_origin(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = page_metrics(spark, sf_dir).join(table(spark, sf_dir, "extracts").select("extract_id", F.try_element_at("metadata", F.lit("producer")).alias("producer")), "extract_id")
    o = audit.origin(F.col("producer"), F.col("full_page_image_share"), F.col("avg_chars_per_page"), F.col("latex_font_page_share"))
    return m.select("extract_id", "producer", o["origin"].alias("origin"), F.array_join(o["evidence"], "; ").alias("evidence"))


def toc_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.toc_depth(toc_of(table(spark, sf_dir, "extracts"), "extract_id", "content"), "extract_id", "level")


def back_matter_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Headings of documents as a table of contents, in lines; top entries that are questions stand for back matter."""
    toc = toc_of(table(spark, sf_dir, "documents"), "doc_id", "text").withColumn("title", F.regexp_replace("title", r"^(Rules|Exercises|Regeln|Règles|Reglas)", "Index"))
    return audit.back_matter(toc, "doc_id", "line", "level", "title", "line", F.lit(1_000_000))


def manifest_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Newer extracts of a file over older ones, with the first loading time kept."""
    e = table(spark, sf_dir, "extracts").filter("source_file is not null")
    half = lambda n: e.filter(F.col("extract_id") % 2 == n).groupBy("source_file").agg(F.max("extract_id").alias("extract_id"), F.min("loaded_at").alias("loaded_at"))
    return audit.merge_preserving(half(0), half(1), "source_file", "loaded_at")


def image_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The image links of all extracts, one of which is added to each."""
    e = table(spark, sf_dir, "extracts").filter("content is not null")
    e = e.withColumn("content", F.concat("content", F.lit("\n\n![a figure](img/figure ("), F.col("extract_id").cast("string"), F.lit(").png)\n")))
    each = e.select("extract_id", F.posexplode(images.links(F.col("content"))).alias("n", "l")).select("extract_id", "n", "l.match", "l.path")
    results = each.select("extract_id", "n", "match", F.concat(F.lit("text of "), "path").alias("result"))
    done = images.inject(e.select("extract_id", "content"), "extract_id", "content", results)
    return done.select("extract_id", F.length("content").alias("chars"), F.regexp_count("content", F.lit("text of img/")).alias("injected"))


QUERIES = {
    f.__name__: f for f in (filename_parse, same_edition, isbns_in_text, page_metrics, first_pages_density, pdf_origin, toc_summary, back_matter_ranges, manifest_merge, image_links)
}

_PAGES = r"""pages AS MATERIALIZED (SELECT extract_id, unnest(p) AS text, generate_subscripts(p, 1) - 1 AS i FROM (SELECT extract_id,
  string_split_regex(regexp_replace(content, '\A\s*<!-- page_number: \d+ -->\n?', ''), '\n?(?:<!-- page_number: \d+ -->|\x0c)\n?') AS p FROM extracts WHERE content <> ''))"""
_S = r"'\A[\s\x1c-\x1f\x85\p{Z}]+'", r"'[\s\x1c-\x1f\x85\p{Z}]+\z'"
_strip = lambda c: f"regexp_replace(regexp_replace({c}, {_S[0]}, ''), {_S[1]}, '')"
_METRICS = rf"""{_PAGES}, n AS (SELECT extract_id, max(i) + 1 AS page_count FROM pages GROUP BY 1),
rows AS MATERIALIZED (SELECT extract_id, page_count, i, text, list_filter(list_transform(string_split_regex(text, '\r\n|[\n\r\x0b\x0c\x1c-\x1e\x85\x{{2028}}\x{{2029}}]'), lambda x: {_strip("x")}), lambda x: x <> '') AS l
  FROM pages JOIN n USING (extract_id) WHERE page_count <= 40 OR i IN (SELECT floor(k * page_count / 40) FROM range(40) t(k))),
one AS MATERIALIZED (SELECT *, length({_strip("text")}) AS chars, len(list_filter(l, lambda x: regexp_matches(x, '[a-z]-$'))) AS cut, len(regexp_extract_all(text, '[ﬀ-ﬆ]')) AS lig,
  i + 1 - list_filter(list_transform(list_filter(l[1:3] || l[greatest(len(l) - 2, 1):], lambda x: regexp_full_match(x, '\d{{1,9}}')), lambda x: x::INT), lambda v: v > 0 AND v <= page_count)[1] AS offs FROM rows),
modes AS (SELECT extract_id, arg_max(offs, (hits, -f)) AS printed_offset, max(hits) AS h FROM (SELECT extract_id, offs, count(*) AS hits, min(i) AS f FROM one WHERE offs IS NOT NULL GROUP BY ALL) GROUP BY 1),
metrics AS (SELECT extract_id, max(page_count)::INT AS pages, count(*) AS sampled_pages, round_even(avg(chars), 0)::BIGINT AS avg_chars_per_page, avg(chars) >= 100 AS has_text_layer, 0.0::DOUBLE AS image_only_page_share, 0.0::DOUBLE AS full_page_image_share,
  sum(lig)::BIGINT AS ligature_chars, round_even(sum(cut) / greatest(sum(len(l)), 1), 3) AS hyphenated_line_share, 0.0::DOUBLE AS latex_font_page_share, 0.0::DOUBLE AS math_font_page_share, false AS page_labels FROM one GROUP BY 1)"""
_TOC = r"""(SELECT {key}, n AS line, length(regexp_extract(t, '^(#{{1,6}})[ \t]', 1)) AS level, trim(regexp_extract(t, '^#{{1,6}}[ \t]+(.*)$', 1)) AS title FROM
  (SELECT {key}, unnest(string_split({text}, chr(10))) AS t, generate_subscripts(string_split({text}, chr(10)), 1) AS n FROM {tab} WHERE {text} IS NOT NULL) WHERE regexp_matches(t, '^#{{1,6}}[ \t]+\S'))"""
SQL = {
    "filename_parse": """SELECT doc_id, true AS is_archive_name, f[1] AS title, f[2] AS authors, y AS year, m AS md5, i AS isbns, o AS other FROM (SELECT doc_id,
      list_filter([source, kind, '2nd ed., ' || (1795 + doc_id % 250)], lambda x: x IS NOT NULL) AS f, CASE WHEN source IS NOT NULL AND kind IS NOT NULL AND doc_id % 250 >= 5 THEN (1795 + doc_id % 250)::INT END AS y,
      md5(text) AS m, '9780' || lpad(doc_id::VARCHAR, 8, '0') || doc_id % 10 AS i, CASE WHEN source IS NOT NULL AND kind IS NOT NULL THEN '2nd ed., ' || (1795 + doc_id % 250) ELSE '' END AS o FROM documents)""",
    "isbns_in_text": r"""WITH t AS (SELECT doc_id, coalesce(text, '') || chr(10) || 'ISBN 978-0-' || lpad(doc_id::VARCHAR, 8, '0') || '-7 or ' || lpad(doc_id::VARCHAR, 9, '1') || 'x.' AS s FROM documents),
      c AS (SELECT doc_id, regexp_replace(regexp_replace(s, '(\d)[\s-]([\dXx])', '\1\2', 'g'), '(\d)[\s-]([\dXx])', '\1\2', 'g') AS s FROM t),
      f AS (SELECT doc_id, list_transform(regexp_extract_all(s, '\b(97[89]\d{10}|\d{9}[\dXx])\b', 1), lambda x: upper(x)) AS l FROM c)
      SELECT doc_id, array_to_string(list_filter(l, lambda x, i: list_position(l, x) = i), ',') AS isbns FROM f""",
    "same_edition": """WITH c AS (SELECT source, doc_id, CASE WHEN doc_id % 5 <> 0 THEN ['978' || lpad((doc_id % 2)::VARCHAR, 10, '0'), '9781234567890'] ELSE [] END AS isbns FROM documents WHERE source IS NOT NULL),
      f AS (SELECT source, count(*) AS n, count_if(len(isbns) > 0) AS known FROM c GROUP BY 1), e AS (SELECT source, i, count(*) AS k FROM (SELECT source, unnest(isbns) AS i FROM c) GROUP BY ALL),
      s AS (SELECT source, string_agg(i, ',' ORDER BY i) AS shared FROM e JOIN f USING (source) WHERE k = known AND known > 1 GROUP BY 1)
      SELECT source, CASE WHEN n < 2 THEN 'single_candidate' WHEN known < 2 THEN 'unknown' WHEN shared IS NOT NULL THEN 'match' ELSE 'no_isbn_overlap' END AS status, coalesce(shared, '') AS shared FROM f LEFT JOIN s USING (source)""",
    "page_metrics": f"WITH {_METRICS} SELECT metrics.*, printed_offset::INT AS printed_offset, round_even(h / sampled_pages, 2) AS printed_agreement, coalesce(h / sampled_pages >= 0.5, false) AS printed_detected FROM metrics LEFT JOIN modes USING (extract_id)",
    "first_pages_density": f"WITH {_PAGES} SELECT extract_id, round(avg(length({_strip('text')})), 6) AS avg_chars, avg(length({_strip('text')})) >= 100 AS has_text_layer FROM pages WHERE i < 5 GROUP BY 1",
    "toc_summary": f"SELECT extract_id, count(*) AS toc_entries, max(level)::INT AS toc_depth FROM {_TOC.format(key='extract_id', text='content', tab='extracts')} GROUP BY 1",
    "back_matter_ranges": f"""WITH toc AS (SELECT doc_id, line, regexp_replace(title, '^(Rules|Exercises|Regeln|Règles|Reglas)', 'Index') AS title FROM {_TOC.format(key='doc_id', text='text', tab='documents')} WHERE level = 1)
      SELECT * FROM (SELECT doc_id, {_strip('title')} AS title, line::INT AS first_page, coalesce(lead(line) OVER (PARTITION BY doc_id ORDER BY line) - 1, 1000000)::INT AS last_page FROM toc)
      WHERE regexp_matches(title, '(?i)^(index|glossary|bibliography|references|answers?\\b|solutions?\\b|answer key)')""",
    "manifest_merge": """WITH o AS (SELECT source_file, max(extract_id) AS extract_id, min(loaded_at) AS loaded_at FROM extracts WHERE source_file IS NOT NULL AND extract_id % 2 = 0 GROUP BY 1),
      n AS (SELECT source_file, max(extract_id) AS extract_id, min(loaded_at) AS loaded_at FROM extracts WHERE source_file IS NOT NULL AND extract_id % 2 = 1 GROUP BY 1)
      SELECT source_file, coalesce(n.extract_id, o.extract_id) AS extract_id, coalesce(o.loaded_at, n.loaded_at) AS loaded_at FROM o FULL JOIN n USING (source_file)""",
    "image_links": """SELECT extract_id, (length(c) + 4 + length('text of img/figure (' || extract_id || ').png'))::INT AS chars, 1 AS injected
      FROM (SELECT extract_id, content || chr(10) || chr(10) || '![a figure](img/figure (' || extract_id || ').png)' || chr(10) AS c FROM extracts WHERE content IS NOT NULL)""",
    "pdf_origin": f"""WITH {_METRICS}, named AS (SELECT extract_id, metadata['producer'] AS producer, lower(coalesce(metadata['producer'], '')) AS low FROM extracts WHERE content <> ''),
      found AS (SELECT *, {", ".join(f"list_filter({list(tools)}, lambda t: contains(low, t))[1] AS t{n}" for n, tools in enumerate((audit.SCAN_TOOLS, audit.CONVERTERS, audit.TYPESETTERS)))} FROM named)
      SELECT extract_id, producer, CASE WHEN t0 IS NOT NULL THEN 'scan_ocr' WHEN t1 IS NOT NULL THEN 'converted' WHEN t2 IS NOT NULL THEN 'typeset' ELSE 'unknown' END AS origin,
        coalesce('metadata names ' || coalesce(t0, t1, t2), 'no known tool') AS evidence FROM found JOIN metrics USING (extract_id)""",
}
