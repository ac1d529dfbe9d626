"""Queries about records of files: names and sizes, first files, image requests and answers, fixed windows, and exact
similarity of likely pairs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import expressions as X
from ..operators import audit, chunking, cleaning, families, images
from ..session import cut, table, texts
from ..sources.markdown import pages_of
from . import documents

PROMPT = "Read the picture."


def file_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Size, checksum and metadata of every extract as a file; every third name gives the right MD5, every third a wrong
    one."""
    e = table(spark, sf_dir, "extracts")
    md5 = F.when(F.col("extract_id") % 3 == 0, F.upper(F.md5("content"))).when(F.col("extract_id") % 3 == 1, F.md5(F.lit("other")))
    scalar = X.stored_scalar(F.map_from_entries(F.array_sort(F.map_entries("metadata"))), "map<string,string>")
    return e.select("extract_id", X.size_mb(F.octet_length("content")).alias("mb"), audit.md5_agrees(md5, F.col("content")).alias("md5_agrees"), X.stored_scalar(F.col("pipeline_phases"), "array<string>").alias("phases"), F.length(scalar).alias("metadata_chars"))


def first_pdfs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first PDF of every top folder, by the time it was loaded."""
    e = table(spark, sf_dir, "extracts").select(F.regexp_extract("source_file", r"^([^/]*)/", 1).alias("folder"), "source_file", F.coalesce("loaded_at", F.lit("1970-01-01").cast("timestamp_ntz")).alias("loaded_at"))
    return audit.first_of(e, "folder", "source_file", "PDF", "loaded_at")


def isbn_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ISBNs on the lines of first pages that say so; every page gets two lines, of which one says it."""
    pages = pages_of(table(spark, sf_dir, "extracts"), "extract_id", "content")
    number = lambda d: F.concat(F.lit(f"978{d}"), F.lpad((F.col("extract_id") * 100 + F.col("i")).cast("string"), 9, "0"))
    pages = pages.withColumn("text", F.concat("text", F.lit("\nISBN: "), number(0), F.lit("\nno. "), number(1)))
    return audit.isbn_lines(pages, "extract_id").select("extract_id", F.array_join("isbns", ",").alias("isbns"))


def _links(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Texts with two links each, and the pictures of which every third text has both, every third only the first."""
    e = table(spark, sf_dir, "extracts").filter("content is not null")
    e = e.select("extract_id", F.concat("content", F.lit("\n\n![one](img/a.png)\n\n![two](img/b.png)\n")).alias("content"))
    assets = e.filter("extract_id % 3 < 2").select(F.col("extract_id"), F.explode(F.when(F.col("extract_id") % 3 == 0, F.array(F.lit("img/a.png"), F.lit("img/b.png"))).otherwise(F.array(F.lit("img/a.png")))).alias("path"))
    return e, assets.withColumn("content", F.encode(F.concat("path", F.col("extract_id").cast("string")), "UTF-8"))


def ocr_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The requests to read the pictures that exist."""
    e, assets = _links(spark, sf_dir)
    found = images.existing_links(e, "extract_id", "content", assets, "extract_id", "path")
    added = found.filter(F.col("path").isin("img/a.png", "img/b.png")).withColumn("n", F.when(F.col("path") == "img/a.png", 0).otherwise(1))
    return images.requests(added, "extract_id", assets, PROMPT)


def ocr_answers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a model's responses say; every fifth is of no use."""
    e = table(spark, sf_dir, "extracts")
    part = F.struct(F.coalesce(F.substring("source_file", 1, 40), F.lit("none")).alias("text"))
    body = F.struct(F.array(F.struct(F.struct(F.array(part).alias("parts")).alias("content"))).alias("candidates"))
    response = F.when(F.col("extract_id") % 5 == 0, '{"error": 1}').otherwise(F.to_json(F.struct(body.alias("response"))))
    return e.select("extract_id", images.recognised(response).alias("answer"))


def proposed_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rules in a model's answers: fenced lists, bare objects, or no JSON at all."""
    d = table(spark, sf_dir, "documents")
    rule = F.to_json(F.struct(F.concat(F.lit("^doc "), F.col("doc_id").cast("string"), F.lit("$")).alias("pattern"), F.lit("a line").alias("description"), (F.col("doc_id") % 100).cast("int").alias("confidence")))
    answer = F.when(F.col("doc_id") % 3 == 0, F.concat(F.lit('```json\n{"note": "x", "rules": ['), rule, F.lit(","), rule, F.lit("]}\n```"))).when(F.col("doc_id") % 3 == 1, rule).otherwise(F.lit("I can't say."))
    out = d.select("doc_id", F.posexplode(cleaning.answered_rules(answer)).alias("n", "r"))
    return out.select("doc_id", "n", "r.pattern", "r.description", "r.confidence")


def chunk_fixed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document in windows of 1,000 characters that overlap by 200; nothing is cut at a separator or header."""
    splits = chunking.split_fixed(texts(spark, sf_dir, "documents", "doc_id", "text"), "doc_id", "text")
    return splits.select("doc_id", "split", F.length("text").alias("chars"), F.md5("text").alias("md5"))


def minhash_murmur3(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first four places of every document's signature by MurmurHash3."""
    signed = families.signatures(texts(spark, sf_dir, "documents", "doc_id", "text"), "doc_id", "text", n=4, family="murmur3")
    return signed.select("doc_id", F.posexplode("signature").alias("position", "least"))


def jaccard_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The exact similarity of the pairs that signatures hold for near duplicates."""
    links = cut(documents.near_dup_pairs(spark, sf_dir))
    return families.exact_similarity(links, table(spark, sf_dir, "documents"), "doc_id", "text")


QUERIES = {f.__name__: f for f in (file_facts, first_pdfs, isbn_lines, ocr_requests, ocr_answers, proposed_rules, chunk_fixed, minhash_murmur3, jaccard_pairs)}

_SPACES = documents._SPACES
# MurmurHash3 x86 32: constants of the published algorithm.
_mul = lambda x, c: f"((({x})::UHUGEINT * {c}) % 4294967296)::UBIGINT"
_rot = lambda x, r: f"((({x}) * {1 << r}) % 4294967296 + ({x}) // {1 << (32 - r)})"
_block = lambda k: _mul(_rot(_mul(k, 3432918353), 15), 461845907)
_fold = lambda x, r: f"xor({x}, ({x}) // {1 << r})"
_number = lambda parts: "('0x' || " + " || ".join(parts) + ")::UBIGINT"
_MURMUR = f"""hexed AS MATERIALIZED (SELECT doc_id, s, hex(encode(s)) AS x, strlen(s) AS n FROM (SELECT DISTINCT doc_id, s FROM shingles)),
mixed AS MATERIALIZED (SELECT doc_id, n, list_transform(range(n // 4), lambda i: {_block(_number([f"x[8 * i + {b - 1}:8 * i + {b}]" for b in (8, 6, 4, 2)]))}) AS ks,
  CASE n % 4 WHEN 0 THEN 0::UBIGINT WHEN 1 THEN {_block(_number(["x[2 * n - 1:2 * n]"]))} WHEN 2 THEN {_block(_number(["x[2 * n - 1:2 * n]", "x[2 * n - 3:2 * n - 2]"]))} ELSE {_block(_number(["x[2 * n - 1:2 * n]", "x[2 * n - 3:2 * n - 2]", "x[2 * n - 5:2 * n - 4]"]))} END AS tail FROM hexed),
body AS (SELECT doc_id, position, xor(xor(list_reduce(list_concat([position::UBIGINT], ks), lambda h, k: ({_rot("xor(h, k)", 13)} * 5 + 3864292196) % 4294967296), tail), n::UBIGINT) AS h FROM mixed, (SELECT unnest(range(4)) AS position)),
f1 AS (SELECT doc_id, position, {_mul(_fold("h", 16), 2246822507)} AS h FROM body), f2 AS (SELECT doc_id, position, {_mul(_fold("h", 13), 3266489909)} AS h FROM f1),
least_of AS (SELECT doc_id, position, min({_fold("h", 16)}) AS least FROM f2 GROUP BY ALL)"""
SQL = {
    "minhash_murmur3": f"WITH {documents._SHINGLES}, {_MURMUR} SELECT d.doc_id, p.position::INT AS position, coalesce(least, 0)::BIGINT AS least FROM documents d CROSS JOIN (SELECT unnest(range(4)) AS position) p LEFT JOIN least_of l ON l.doc_id = d.doc_id AND l.position = p.position",
    "file_facts": """SELECT extract_id, round_even(strlen(content) / 1e6, 1) AS mb, CASE extract_id % 3 WHEN 0 THEN content IS NOT NULL OR NULL WHEN 1 THEN md5(content) = md5('other') END AS md5_agrees,
      CASE WHEN pipeline_phases IS NOT NULL THEN '["' || array_to_string(pipeline_phases, '","') || '"]' END AS phases,
      CASE WHEN metadata IS NOT NULL THEN 1 + greatest(1, list_sum(list_transform(map_entries(metadata), lambda x: 6 + length(x.key) + CASE WHEN x.value IS NULL THEN 2 ELSE length(x.value) + length(x.value) - length(replace(replace(x.value, '"', ''), chr(92), '')) END))) END::INT AS metadata_chars FROM extracts""",
    "first_pdfs": """SELECT regexp_extract(source_file, '^([^/]*)/', 1) AS folder, arg_min(source_file, (coalesce(loaded_at, TIMESTAMP '1970-01-01'), source_file)) AS source_file FROM extracts WHERE lower(source_file) LIKE '%.pdf' GROUP BY 1""",
    "isbn_lines": r"""WITH p AS (SELECT extract_id, string_split_regex(regexp_replace(content, '\A\s*<!-- page_number: \d+ -->\n?', ''), '\n?(?:<!-- page_number: \d+ -->|\x0c)\n?') AS p FROM extracts WHERE content <> '')
      SELECT extract_id, array_to_string(list_transform(range(least(len(p), 12)), lambda i: '9780' || lpad((extract_id * 100 + i)::VARCHAR, 9, '0')), ',') AS isbns FROM p""",
    "ocr_requests": f"""SELECT extract_id || '---' || n AS request_id, '{{"request_id":"' || extract_id || '---' || n || '","request":{{"instruction":{{"text":"{PROMPT}"}},"image":{{"data":"' || to_base64(encode(path || extract_id)) || '"}}}}}}' AS line
      FROM extracts, (VALUES (0, 'img/a.png'), (1, 'img/b.png')) v(n, path) WHERE content IS NOT NULL AND (extract_id % 3 = 0 OR (extract_id % 3 = 1 AND n = 0))""",
    "ocr_answers": f"SELECT extract_id, CASE WHEN extract_id % 5 = 0 THEN '{images.FAILED}' ELSE coalesce(source_file[1:40], 'none') END AS answer FROM extracts",
    "proposed_rules": "SELECT doc_id, n::INT AS n, '^doc ' || doc_id || '$' AS pattern, 'a line' AS description, (doc_id % 100)::INT AS confidence FROM documents, (VALUES (0), (1)) v(n) WHERE doc_id % 3 = 0 OR (doc_id % 3 = 1 AND n = 0)",
    "chunk_fixed": rf"""WITH w AS (SELECT doc_id, unnest(range(CASE WHEN length(text) <= 1000 THEN 1 ELSE 1 + ((length(text) - 1000) + 799) // 800 END)) AS i, text FROM documents WHERE text <> ''),
      s AS (SELECT doc_id, i, regexp_replace(regexp_replace(substr(text, i * 800 + 1, 1000), '\A{_SPACES}+', ''), '{_SPACES}+\z', '') AS t FROM w)
      SELECT doc_id, (row_number() OVER (PARTITION BY doc_id ORDER BY i) - 1)::INT AS split, length(t)::INT AS chars, md5(t) AS md5 FROM s WHERE t <> ''""",
    "jaccard_pairs": f"""WITH {documents._links(52)}, sh AS MATERIALIZED (SELECT DISTINCT doc_id, s FROM shingles), n AS (SELECT doc_id, count(*) AS n FROM sh GROUP BY 1),
      common AS (SELECT rep_a, rep_b, count(b.s) AS c FROM links JOIN sh a ON a.doc_id = rep_a LEFT JOIN sh b ON b.doc_id = rep_b AND b.s = a.s GROUP BY ALL)
      SELECT l.rep_a, l.rep_b, round(coalesce(c / nullif(coalesce(x.n, 0) + coalesce(y.n, 0) - c, 0), 0), 6) AS jaccard FROM links l LEFT JOIN common USING (rep_a, rep_b) LEFT JOIN n x ON x.doc_id = rep_a LEFT JOIN n y ON y.doc_id = rep_b""",
}
