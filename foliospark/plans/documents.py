"""Queries over documents, extracts and chunks: deduplication, families, cleaning, chunking."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import expressions as X
from ..operators import chunking, cleaning, exact, families
from ..session import cut, table, texts

RULES = [
    {"pattern": r"\bIn return\b", "description": "an uncertain rule", "confidence": 40},
    {"pattern": r"^\*\*Written by .*\*\*$", "description": "byline", "confidence": 95},
    {"pattern": r"[aeiou]", "description": "far too greedy", "confidence": 99},
    {"pattern": r"(unclosed", "description": "no pattern", "confidence": 99},
]
REMOVALS = (r"^<!-- .* -->$", r"\d+ shares")


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents")


def exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact.exact_duplicates(_documents(spark, sf_dir), "doc_id", F.col("text"))


def dup_size_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sizes that several documents have, which are all that need hashing."""
    sized = _documents(spark, sf_dir).select(F.octet_length("text").alias("bytes")).filter("bytes is not null")
    return sized.groupBy("bytes").agg(F.count("*").alias("documents")).filter("documents > 1")


def shingle_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = _documents(spark, sf_dir).filter("text is not null")
    return d.select("doc_id", X.let(X.shingles(F.col("text"), 5), lambda s: F.struct(F.size(s).alias("shingles"), F.size(F.array_distinct(s)).alias("distinct_shingles"))).alias("s")).select("doc_id", "s.*")


def _signed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return families.signatures(texts(spark, sf_dir, "documents", "doc_id", "text"), "doc_id", "text")


def minhash_signature(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _signed(spark, sf_dir).select("doc_id", F.posexplode("signature").alias("position", "least"))


def _families(spark: SparkSession, sf_dir: str, threshold: float = families.THRESHOLD) -> families.Families:
    return families.Families(cut(_signed(spark, sf_dir)), "doc_id", threshold)


def near_dup_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pairs of classes of equal signatures, by their least ids; ``near_dup_members`` has each document's class."""
    return _families(spark, sf_dir, 0.8).links


def near_dup_members(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its class and its number of near duplicates. With ``near_dup_pairs`` it gives every pair:
    those within a class, and those between the members of two linked ones."""
    return _families(spark, sf_dir, 0.8).membership()


def document_families(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _families(spark, sf_dir).families()


def canonical_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return families.canonical(document_families(spark, sf_dir), _documents(spark, sf_dir), "doc_id", "text")


def family_roles(spark: SparkSession, sf_dir: str) -> DataFrame:
    f = cut(document_families(spark, sf_dir))
    return families.roles(f, families.canonical(f, _documents(spark, sf_dir), "doc_id", "text"), "doc_id")


def superseded_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return families.superseded(_documents(spark, sf_dir).select("doc_id"), family_roles(spark, sf_dir), "doc_id")


def family_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return families.family_report(canonical_documents(spark, sf_dir))


def clean_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return texts(spark, sf_dir, "documents", "doc_id", "text").select("doc_id", cleaning.clean(F.col("text")).alias("text"))


def regex_removals(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = cleaning.CleanupRules(regex_removals=REMOVALS)
    return table(spark, sf_dir, "extracts").select("extract_id", cleaning.clean(F.col("content"), rules).alias("text"))


def paragraph_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = cleaning.CleanupRules(deduplicate_paragraphs=True)
    return texts(spark, sf_dir, "documents", "doc_id", "text").select("doc_id", cleaning.clean(F.col("text"), rules).alias("text"))


def rule_review(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What each rule was held for, and on how many extracts."""
    held = cleaning.apply_rules(table(spark, sf_dir, "extracts"), "extract_id", "content", RULES).select(F.explode("held").alias("h"))
    reason = F.regexp_replace("h.reason", r"[ :(].*", "")
    return held.groupBy(F.col("h.pattern").alias("pattern"), reason.alias("reason")).agg(F.count("*").alias("extracts"))


def text_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _documents(spark, sf_dir).select("doc_id", cleaning.sample(F.col("text")).alias("sample"))


def chunk_markdown(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chunking.chunk_markdown(texts(spark, sf_dir, "extracts", "extract_id", "content"), "extract_id", "content")


def page_fill(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The page in force at each line of an extract, from its page comments."""
    lines = table(spark, sf_dir, "extracts").filter("content is not null").select("extract_id", F.posexplode(F.split("content", "\n", -1)).alias("split", "text"))
    out = chunking.number_chunks(lines.withColumns({h: F.lit(None).cast("string") for h in ("h1", "h2", "h3")}), "extract_id")
    return out.groupBy("extract_id", "page_number").agg(F.count("*").alias("lines"), F.max("chunk_index").alias("last_index"))


QUERIES = {
    f.__name__: f
    for f in (exact_dedup, dup_size_gate, shingle_stats, minhash_signature, near_dup_pairs, near_dup_members, document_families, canonical_documents, family_roles, superseded_documents, family_report, clean_text, regex_removals, paragraph_dedup, rule_review, text_sample, chunk_markdown, page_fill)
}

_WORDS = r"regexp_extract_all(lower(text), '[\p{L}\p{N}_]+')"
_SHINGLES = f"""
words AS MATERIALIZED (SELECT doc_id, {_WORDS} AS w FROM documents WHERE text IS NOT NULL),
shingles AS MATERIALIZED (
  SELECT doc_id, unnest(CASE WHEN len(w) = 0 THEN []::VARCHAR[] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i+4], ' ')) END) AS s FROM words)"""
_COEFFICIENTS = ", ".join(f"({i}, {a}, {b})" for i, (a, b) in enumerate(families.coefficients(families.PERMUTATIONS)))
_SIGNED = f"""{_SHINGLES},
hashed AS MATERIALIZED (SELECT DISTINCT doc_id, ('0x' || md5(s)[1:8])::BIGINT % {families.PRIME} AS x FROM shingles),
coef(position, a, b) AS (VALUES {_COEFFICIENTS}),
least_of AS MATERIALIZED (SELECT doc_id, position, min((x * a + b) % {families.PRIME}) AS least FROM hashed, coef GROUP BY ALL),
signed AS MATERIALIZED (SELECT d.doc_id, c.position, coalesce(l.least, 0) AS least FROM documents d CROSS JOIN coef c LEFT JOIN least_of l USING (doc_id, position)),
whole AS MATERIALIZED (SELECT doc_id, list(least ORDER BY position) AS sig FROM signed GROUP BY doc_id),
member AS MATERIALIZED (SELECT doc_id, min(doc_id) OVER (PARTITION BY sig) AS rep FROM whole)"""


def _links(need: int) -> str:
    return f"""{_SIGNED},
reps AS MATERIALIZED (SELECT s.* FROM signed s WHERE doc_id IN (SELECT rep FROM member)),
links AS MATERIALIZED (SELECT a.doc_id AS rep_a, b.doc_id AS rep_b, count(*) AS matches FROM reps a JOIN reps b USING (position, least)
  WHERE a.doc_id < b.doc_id GROUP BY ALL HAVING count(*) >= {need})"""


_FAMILIES = f"""{_links(61)},
edges AS (SELECT rep_a AS u, rep_b AS v FROM links UNION SELECT rep_b, rep_a FROM links UNION SELECT doc_id, rep FROM member UNION SELECT rep, doc_id FROM member),
reach(u, v) AS (SELECT doc_id, doc_id FROM documents UNION SELECT r.u, e.v FROM reach r JOIN edges e ON r.v = e.u),
fam AS MATERIALIZED (SELECT u AS doc_id, min(v) AS family_id FROM reach GROUP BY u)"""
_CANONICAL = f"""{_FAMILIES},
canon AS MATERIALIZED (SELECT family_id, arg_max(doc_id, (coalesce(length(text), 0), doc_id)) AS canonical, count(*) AS members FROM fam JOIN documents USING (doc_id) GROUP BY family_id)"""
_UUID = """(SELECT h[1:8] || '-' || h[9:12] || '-5' || h[14:16] || '-' || translate(h[17:17], '0123456789abcdef', '89ab89ab89ab89ab') || h[18:20] || '-' || h[21:32]
  FROM (SELECT sha1(unhex('6ba7b8119dad11d180b400c04fd430c8') || encode({name})) AS h))"""
_ROLES = f"""{_CANONICAL},
roles AS (SELECT doc_id, {_UUID.format(name="canonical::VARCHAR")} AS family_uuid, CASE WHEN doc_id = canonical THEN 'canonical' ELSE 'variant' END AS role
  FROM fam JOIN canon USING (family_id) WHERE members > 1)"""
_SPACES = r"[\s\x1c-\x1f\x85\p{Z}]"


def _clean_sql(text: str, removals: tuple[str, ...] = ()) -> str:
    out = f"translate({text}, chr(8203) || chr(65279) || chr(8204) || chr(8205), '')"
    out = rf"regexp_replace({out}, '(?m)[ \t\x0b\x0c\r\x1c-\x1f\x85\p{{Z}}]+$', '', 'g')"
    for r in removals:
        out = f"regexp_replace({out}, '(?m){r}', '', 'g')"
    out = rf"regexp_replace({out}, '\n{{3,}}', chr(10) || chr(10), 'g')"
    out = rf"regexp_replace(regexp_replace({out}, '\A{_SPACES}+', ''), '{_SPACES}+\z', '')"
    return f"CASE WHEN {text} = '' THEN '' ELSE {out} END"


def _literal(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


_PUSHED = "list_concat(a, x)"
_COLLAPSED = " ".join(
    f"WHEN len({_PUSHED}) >= {2 * n} AND " + " AND ".join(f"lower({_PUSHED}[-{i}]) = lower({_PUSHED}[-{n + i}])" for i in range(1, n + 1)) + f" THEN {_PUSHED}[1:len({_PUSHED}) - {n}]"
    for n in range(1, cleaning.MAX_SEQUENCE + 1)
)
SQL = {
    "exact_dedup": "SELECT doc_id, CASE WHEN text IS NULL THEN doc_id ELSE min(doc_id) OVER (PARTITION BY text) END AS kept FROM documents",
    "dup_size_gate": "SELECT strlen(text)::INT AS bytes, count(*) AS documents FROM documents WHERE text IS NOT NULL GROUP BY 1 HAVING count(*) > 1",
    "shingle_stats": f"WITH {_SHINGLES} SELECT w.doc_id, count(s)::INT AS shingles, count(DISTINCT s)::INT AS distinct_shingles FROM words w LEFT JOIN shingles USING (doc_id) GROUP BY 1",
    "minhash_signature": f"WITH {_SIGNED} SELECT doc_id, position::INT AS position, least FROM signed",
    "near_dup_pairs": f"WITH {_links(52)} SELECT rep_a, rep_b, matches::INT AS matches FROM links",
    "near_dup_members": f"""WITH {_SIGNED}, near AS (SELECT a.doc_id FROM signed a JOIN signed b USING (position, least) WHERE a.doc_id <> b.doc_id GROUP BY a.doc_id, b.doc_id HAVING count(*) >= 52)
      SELECT m.doc_id, m.rep, count(n.doc_id) AS n_links FROM member m LEFT JOIN near n USING (doc_id) GROUP BY ALL""",
    "document_families": f"WITH RECURSIVE {_FAMILIES} SELECT * FROM fam",
    "canonical_documents": f"WITH RECURSIVE {_CANONICAL} SELECT * FROM canon",
    "family_roles": f"WITH RECURSIVE {_ROLES} SELECT * FROM roles",
    "superseded_documents": f"WITH RECURSIVE {_ROLES} SELECT doc_id, CASE WHEN role = 'variant' THEN 'superseded' ELSE 'current' END AS status FROM documents LEFT JOIN roles USING (doc_id)",
    "family_report": f"WITH RECURSIVE {_CANONICAL} SELECT count_if(members > 1) AS families, count_if(members = 1) AS singletons, coalesce(sum(members), 0)::BIGINT AS rows FROM canon",
    "clean_text": f"SELECT doc_id, {_clean_sql('text')} AS text FROM documents",
    "regex_removals": f"SELECT extract_id, {_clean_sql('content', REMOVALS)} AS text FROM extracts",
    "paragraph_dedup": rf"""WITH cleaned AS (SELECT doc_id, {_clean_sql("text")} AS t FROM documents),
      blocks AS (SELECT doc_id, t, list_filter(list_transform(string_split_regex(t, '\n{{2,}}'), lambda p: regexp_replace(regexp_replace(p, '\A{_SPACES}+', ''), '{_SPACES}+\z', '')), lambda p: p <> '') AS ps FROM cleaned)
      SELECT doc_id, CASE WHEN t IS NOT NULL THEN coalesce(array_to_string(list_reduce(list_concat([[]::VARCHAR[]], list_transform(ps, lambda p: [p])), lambda a, x: CASE {_COLLAPSED} ELSE {_PUSHED} END), chr(10) || chr(10)), '') END AS text FROM blocks""",
    "rule_review": rf"""WITH t AS (SELECT content, regexp_replace(content, '(?m)^\*\*Written by .*\*\*$', '', 'g') AS u FROM extracts),
      s AS (SELECT content, (length(content) - length(u)) * 100.0 / length(content) AS byline, CASE WHEN (length(content) - length(u)) * 100.0 / length(content) > 3 THEN content ELSE u END AS v FROM t WHERE content <> '')
      SELECT '\bIn return\b' AS pattern, 'Low' AS reason, count(*) AS extracts FROM extracts UNION ALL SELECT '(unclosed', 'Invalid', count(*) FROM extracts
      UNION ALL SELECT * FROM (SELECT '^\*\*Written by .*\*\*$', 'Blast', count_if(byline > 3) AS n FROM s) WHERE n > 0
      UNION ALL SELECT * FROM (SELECT '[aeiou]', 'Blast', count_if((length(v) - length(regexp_replace(v, '[aeiou]', '', 'g'))) * 100.0 / length(v) > 3) AS n FROM s) WHERE n > 0""",
    "text_sample": f"""SELECT doc_id, CASE WHEN length(text) < 15000 THEN text ELSE text[1:3000] || {_literal(cleaning.MIDDLE)}
      || substr(text, length(text) // 2 - 1499, 3000) || {_literal(cleaning.END)} || text[-3000:] END AS sample FROM documents""",
    "page_fill": r"""WITH lines AS (SELECT extract_id, unnest(string_split(content, chr(10))) AS t, generate_subscripts(string_split(content, chr(10)), 1) AS n FROM extracts WHERE content IS NOT NULL),
      marked AS (SELECT *, regexp_extract_all(t, '<!-- page_number: (\d+) -->', 1)[-1]::INT AS p,
        regexp_replace(regexp_replace(regexp_replace(t, '<!-- page_number: \d+ -->', '', 'g'), '\A[\s\x1c-\x1f\x85\p{Z}]+', ''), '[\s\x1c-\x1f\x85\p{Z}]+\z', '') AS bare FROM lines),
      filled AS (SELECT *, last_value(p IGNORE NULLS) OVER (PARTITION BY extract_id ORDER BY n) AS page_number FROM marked),
      kept AS (SELECT extract_id, page_number, row_number() OVER (PARTITION BY extract_id ORDER BY n) - 1 AS i FROM filled WHERE bare <> '')
      SELECT extract_id, page_number, count(*) AS lines, max(i)::INT AS last_index FROM kept GROUP BY 1, 2""",
}
