"""Measurements of source files: names, ISBNs, pages, tables of contents, and merging of what is known of a title."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import expressions as X

# Patterns for what a file name or page tells.
ISBN = r"\b(97[89]\d{10}|\d{9}[\dXx])\b"
YEAR = r"\b(1[89]\d{2}|20\d{2})\b"
MD5 = r"(?i)^[0-9a-f]{32}$"
ARCHIVE = r"(?i)^anna[’'`]?s archive$"
SEPARATOR = " -- "
LATEX_FONT = r"^(CM[A-Z]{1,4}\d+|LM[A-Z]|SFRM|SFBX|MSAM|MSBM)"
MATH_FONT = r"(?i)^(CMMI|CMSY|CMEX|MSAM|MSBM|LMMath|STIXMath|STIXGeneral|Cambria ?Math|MathematicalPi|MTMI|MTSY|MTEX|Euclid|TeXGyre\w*Math|rsfs|eufm)"
BACK_MATTER = r"(?i)^(index|glossary|bibliography|references|answers?\b|solutions?\b|answer key)"
SCAN_TOOLS = ("abbyy", "finereader", "tesseract", "internet archive", "luratech", "scansnap", "paper capture", "omnipage", "readiris", "kofax", "djvu")
CONVERTERS = ("calibre", "ebook-convert", "wkhtmltopdf")
TYPESETTERS = ("indesign", "distiller", "pdftex", "xetex", "luatex", "latex", "antenna house", "arbortext", "3b2", "quarkxpress", "xep", "prince", "framemaker")
PAGE_SAMPLE, CHARS_PER_PAGE, IMAGE_SHARE, SCAN_SHARE = 40, 100.0, 0.8, 0.5


def isbns(text: Column) -> Column:
    """The distinct ISBNs in a text in the order they come, hyphens and blanks between digits aside."""
    compact = F.regexp_replace(text, r"(?<=\d)[\s-](?=[\dXx])", "")
    return F.array_distinct(F.transform(F.regexp_extract_all(compact, F.lit(ISBN), F.lit(1)), F.upper))


def parse_name(name: Column) -> Column:
    """STRUCT<is_archive_name, title, authors, year, isbns, md5, other> of a file name.

    A name of fields set apart by dashes has title and authors first; each other field is an MD5, nothing but ISBNs,
    or something else, of which the first with a year gives it. Any other name is a title. Null for null.
    """
    stem = F.regexp_replace(F.regexp_replace(name, r"^.*/", ""), r"(?<=.)\.[^.]*$", "")
    parts = F.transform(F.split(stem, SEPARATOR), lambda x: F.trim(x))
    one = F.array().cast("array<string>")

    def fields(f: Column) -> Column:
        archive = (F.size(f) > 1) & F.element_at(f, -1).rlike(ARCHIVE)
        own = F.when(archive, F.slice(f, 1, F.size(f) - 1)).otherwise(f)
        rest = F.when(F.size(own) > 2, F.slice(own, 3, F.greatest(F.size(own) - 2, F.lit(0)))).otherwise(one)
        md5s = F.filter(rest, lambda x: x.rlike(MD5))
        only_isbn = lambda x: (F.size(isbns(x)) > 0) & (F.regexp_replace(x, r"[\dXx,;\s-]", "") == "")
        books = F.filter(rest, lambda x: ~x.rlike(MD5) & only_isbn(x))
        other = F.filter(rest, lambda x: ~x.rlike(MD5) & ~only_isbn(x))
        years = F.filter(other, lambda x: x.rlike(YEAR))
        many = F.size(f) > 1
        return F.struct(
            (many & (archive | (F.size(md5s) > 0))).alias("is_archive_name"),
            F.when(many, own[0]).otherwise(F.trim(stem)).alias("title"),
            F.when(F.size(own) > 1, F.try_element_at(own, F.lit(2))).alias("authors"),
            F.regexp_extract(F.try_element_at(years, F.lit(1)), YEAR, 1).try_cast("int").alias("year"),
            F.array_distinct(F.flatten(F.transform(books, isbns))).alias("isbns"),
            F.lower(F.try_element_at(md5s, F.lit(-1))).alias("md5"),
            other.alias("other"),
        )

    return X.let(parts, fields)


def shared_isbns(candidates: DataFrame, title: str, name: str, isbns_: str) -> DataFrame:
    """(title, status, shared): whether the candidate files of a title have an ISBN in common.

    ``single_candidate`` for one file, ``unknown`` if fewer than two have ISBNs, ``match`` with the ISBNs that all of
    those have, else ``no_isbn_overlap``.
    """
    files = candidates.groupBy(title).agg(F.count("*").alias("n"), F.count_if(F.size(isbns_) > 0).alias("known"))
    each = candidates.select(title, name, F.explode(F.array_distinct(isbns_)).alias("i")).groupBy(title, "i").agg(F.count("*").alias("k"))
    met = each.join(files, title).filter((F.col("k") == F.col("known")) & (F.col("known") > 1)).groupBy(title).agg(F.sort_array(F.collect_set("i")).alias("shared"))
    status = F.when(F.col("n") < 2, "single_candidate").when(F.col("known") < 2, "unknown").when(F.col("shared").isNotNull(), "match").otherwise("no_isbn_overlap")
    return files.join(met, title, "left").select(title, status.alias("status"), F.coalesce(F.when(status == "match", F.col("shared")), F.array().cast("array<string>")).alias("shared"))


def merge_preserving(old: DataFrame, new: DataFrame, key: str, keep: str) -> DataFrame:
    """Rows of ``new`` over those of ``old`` by key, but for column ``keep``, of which the old value stays where it is
    not null. Keys are unique on either side."""
    rest = [c for c in old.columns if c not in (key, keep)]
    o, n = old.withColumn("_o", F.lit(True)).alias("o"), new.withColumn("_n", F.lit(True)).alias("n")
    met = o.join(n, F.col(f"o.{key}") == F.col(f"n.{key}"), "full")
    fresh = F.col("n._n").isNotNull()
    return met.select(
        F.coalesce(f"n.{key}", f"o.{key}").alias(key),
        *[F.when(fresh, F.col(f"n.{c}")).otherwise(F.col(f"o.{c}")).alias(c) for c in rest],
        F.coalesce(f"o.{keep}", f"n.{keep}" if keep in new.columns else F.lit(None)).alias(keep),
    ).select(old.columns)


def first_of(candidates: DataFrame, title: str, name: str, extension: str, *order: str) -> DataFrame:
    """(title, name) of the first file with an extension, letter case aside, among the files of each title that has
    one, by ``order`` and then by name."""
    return candidates.filter(F.lower(name).endswith("." + extension.lower())).groupBy(title).agg(F.min_by(name, F.struct(*order, name)).alias(name))


def md5_agrees(named: Column, content: Column) -> Column:
    """Whether a file's content has the MD5 that its name gives; null if the name gives none."""
    return F.when(named.isNotNull(), F.lower(named) == F.md5(content))


def manifest_yaml(rows: DataFrame, title: str, head: tuple[str, str] = ("Files of each title and which of them to use.", "Choices made by hand are kept.")) -> str:
    """A manifest of few titles as YAML: two lines of remarks, then a mapping from each title to its other columns,
    titles in order and columns as they come. Its size is that of the list of titles, which the driver holds."""
    import yaml

    listed = {r[title]: {k: v for k, v in r.asDict(recursive=True).items() if k != title} for r in rows.orderBy(title).toLocalIterator()}
    return "".join(f"# {h}\n" for h in head) + yaml.safe_dump(listed, sort_keys=False, allow_unicode=True, width=120)


def sampled(pages: DataFrame, doc: str, index: str, sample: int = PAGE_SAMPLE, count: str | None = None) -> DataFrame:
    """``pages`` with ``page_count`` and only an evenly spaced sample of each document's pages: all of up to ``sample``,
    else those at floor(k n / sample). With the column ``count``, which
    gives each page the number of its document's pages, they aren't counted again."""
    # A window, not a join with the counts: what follows groups by document too, so all of it takes one shuffle.
    pages = pages.withColumn("page_count", F.col(count) if count else F.max(index).over(Window.partitionBy(doc)) + 1)
    k = F.ceil(F.col(index) * sample / F.col("page_count"))
    chosen = (F.col("page_count") <= sample) | ((F.floor(k * F.col("page_count") / sample) == F.col(index)) & (k < sample))
    return pages.filter(chosen)


def _lines(text: Column) -> Column:
    return F.filter(F.transform(F.split(text, r"\r\n|[\n\r\x0b\x0c\x1c-\x1e\x85  ]"), X.strip), lambda x: x != "")


def page_metrics(pages: DataFrame, doc: str, index: str = "i", sample: int = PAGE_SAMPLE, keep: tuple[str, ...] = (), count: str | None = None) -> DataFrame:
    """One row a document with what a sample of its pages tells.

    ``pages`` has (doc, i from 0, text) and, where known, width, height, fonts ARRAY<STRING>, images
    ARRAY<STRUCT<x0,y0,x1,y1>> and label. Null texts count as empty. Shares are of the sampled pages, rounded half even.
    Columns in ``keep``, which are the same on all pages of a document, stay; ``count`` is as in ``sampled``.
    """
    have = {"width", "height", "fonts", "images", "label"} & set(pages.columns)
    pages = pages.select(doc, index, "text", *sorted(have), *keep, *([count] if count else []))
    rows = sampled(pages, doc, index, sample, count).withColumn("_t", F.coalesce("text", F.lit(""))).withColumn("_l", _lines(F.col("_t")))
    ends = F.concat(F.slice("_l", 1, 3), F.slice("_l", F.greatest(F.size("_l") - 2, F.lit(1)), 3))
    printed = F.try_element_at(F.filter(F.transform(F.filter(ends, lambda x: x.rlike(r"^\d{1,9}$")), lambda x: x.cast("int")), lambda n: (n > 0) & (n <= F.col("page_count"))), F.lit(1))
    fonts = F.transform("fonts", lambda f: F.regexp_replace(f, r"^[^+]*\+", "")) if "fonts" in have else F.array().cast("array<string>")
    covered = F.coalesce(F.exists("images", lambda b: (b["x1"] - b["x0"]) * (b["y1"] - b["y0"]) >= IMAGE_SHARE * F.col("width") * F.col("height")), F.lit(False)) if "images" in have else F.lit(False)
    label = F.coalesce(F.col("label"), F.lit("")) != "" if "label" in have else F.lit(False)
    one = rows.select(
        doc, "page_count", F.col(index).alias("_i"), F.length(X.strip(F.col("_t"))).alias("chars"), F.size("_l").alias("lines"),
        F.size(F.filter("_l", lambda x: x.rlike(r"[a-z]-$"))).alias("cut"), F.regexp_count("_t", F.lit("[ﬀ-ﬆ]")).alias("ligatures"),
        (F.col(index) + 1 - printed).alias("offset"), covered.alias("covered"), label.alias("labelled"),
        F.exists(fonts, lambda f: f.rlike(LATEX_FONT)).alias("latex"), F.exists(fonts, lambda f: f.rlike(MATH_FONT)).alias("maths"), *keep,
    )
    share = lambda c, digits=2: F.bround(F.avg(c.cast("double")), digits)
    out = one.groupBy(doc, *keep).agg(
        F.max("page_count").alias("pages"), F.count("*").alias("sampled_pages"), F.bround(F.avg("chars"), 0).cast("long").alias("avg_chars_per_page"), (F.avg("chars") >= CHARS_PER_PAGE).alias("has_text_layer"),
        share(F.col("covered") & (F.col("chars") < CHARS_PER_PAGE)).alias("image_only_page_share"), share(F.col("covered")).alias("full_page_image_share"), F.sum("ligatures").cast("long").alias("ligature_chars"),
        F.bround(F.sum("cut") / F.greatest(F.sum("lines"), F.lit(1)), 3).alias("hyphenated_line_share"), share(F.col("latex")).alias("latex_font_page_share"), share(F.col("maths")).alias("math_font_page_share"), F.bool_or("labelled").alias("page_labels"),
    )
    offsets = one.filter("offset is not null").groupBy(doc, "offset").agg(F.count("*").alias("hits"), F.min("_i").alias("first"))
    mode = offsets.groupBy(doc).agg(F.max_by("offset", F.struct("hits", -F.col("first"))).alias("printed_offset"), F.max("hits").alias("_h"))
    agreement = F.bround(F.col("_h") / F.col("sampled_pages"), 2)
    detected = F.coalesce(F.col("_h") / F.col("sampled_pages") >= 0.5, F.lit(False))
    return out.join(mode, doc, "left").withColumn("printed_agreement", agreement).withColumn("printed_detected", detected).drop("_h")


def first_pages_density(pages: DataFrame, doc: str, index: str = "i", first: int = 5) -> DataFrame:
    """(doc, avg_chars): mean length of the stripped text of a document's first pages; which way to read a PDF hangs on
    whether it reaches ``CHARS_PER_PAGE``."""
    return pages.filter(F.col(index) < first).groupBy(doc).agg(F.avg(F.length(X.strip(F.coalesce("text", F.lit(""))))).alias("avg_chars"))


def origin(producer: Column, full_page_images: Column, avg_chars: Column, latex_share: Column) -> Column:
    """STRUCT<origin, evidence> of a PDF: a scan by its page images, else by the first tool its metadata names, else by
    its fonts."""
    low = F.lower(F.coalesce(producer, F.lit("")))
    named = lambda tools: F.try_element_at(F.filter(F.array(*map(F.lit, tools)), lambda t: F.contains(low, t)), F.lit(1))
    say = lambda o, e: F.struct(F.lit(o).alias("origin"), F.array(e).alias("evidence"))
    scan = F.concat(F.lit("page images cover "), F.bround(full_page_images * 100, 0).cast("int").cast("string"), F.lit("% of pages"))
    tool = lambda t: F.concat(F.lit("metadata names "), t)
    return (
        F.when((full_page_images >= SCAN_SHARE) & (avg_chars >= CHARS_PER_PAGE), say("scan_ocr", scan))
        .when(full_page_images >= SCAN_SHARE, say("scan_image_only", scan))
        .when(named(SCAN_TOOLS).isNotNull(), say("scan_ocr", tool(named(SCAN_TOOLS))))
        .when(named(CONVERTERS).isNotNull(), say("converted", tool(named(CONVERTERS))))
        .when(named(TYPESETTERS).isNotNull(), say("typeset", tool(named(TYPESETTERS))))
        .when(latex_share >= 0.5, say("typeset", F.lit("LaTeX fonts")))
        .otherwise(say("unknown", F.lit("no known tool")))
    )


def back_matter(toc: DataFrame, doc: str, order: str, level: str, title: str, page: str, page_count: Column) -> DataFrame:
    """(doc, title, first_page, last_page) of indexes, glossaries and the like among the top entries of a table of
    contents; each ends before the next top entry, the last with the document."""
    top = toc.filter(F.col(level) == 1)
    after = F.lead(page).over(Window.partitionBy(doc).orderBy(order))
    rows = top.select(doc, X.strip(F.col(title)).alias("title"), F.col(page).alias("first_page"), F.coalesce(after - 1, page_count).alias("last_page"))
    return rows.filter(F.col("title").rlike(BACK_MATTER))


def toc_depth(toc: DataFrame, doc: str, level: str) -> DataFrame:
    return toc.groupBy(doc).agg(F.count("*").alias("toc_entries"), F.max(level).alias("toc_depth"))


def isbn_lines(pages: DataFrame, doc: str, index: str = "i", first: int = 12) -> DataFrame:
    """(doc, isbns): those on lines that say ISBN, of a document's first pages, in order."""
    rows = pages.filter((F.col(index) < first) & F.col("text").isNotNull())
    said = F.array_join(F.filter(F.split("text", "\n"), lambda x: F.contains(F.lower(x), F.lit("isbn"))), "\n")
    text = rows.groupBy(doc).agg(F.sort_array(F.collect_list(F.struct(F.col(index).alias("i"), said.alias("s")))).alias("_p"))
    return text.select(doc, isbns(F.array_join(F.transform("_p", lambda p: p["s"]), "\n")).alias("isbns"))
