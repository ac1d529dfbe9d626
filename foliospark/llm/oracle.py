"""SQL to compare the queries of this subpackage with, for DuckDB.

Problems 1, 4, 5 and 7 need the consistent form. Its table comes from the ICU library of a running Spark session and is
written into the SQL as one ``translate``; without a session these have no SQL. Of the characters that become several,
the SQL has those of ``SEVERAL`` only.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from ..functions.textform import form_table

SEVERAL = "ﬀﬁﬂﬃﬄﬅﬆ…‥"

# The exact answer. The search is approximate; on one shard of this size it finds all neighbours.
_NEAR = """ok AS MATERIALIZED (SELECT vec_id, embedding::DOUBLE[64] AS e FROM vectors WHERE len(embedding) = 64
  AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
near AS MATERIALIZED (SELECT a.vec_id, b.vec_id AS neighbour, round(array_cosine_similarity(a.e, b.e), 6) AS similarity, row_number() OVER (PARTITION BY a.vec_id ORDER BY round(array_cosine_similarity(a.e, b.e), 6) DESC, b.vec_id) AS rank
  FROM ok a JOIN ok b ON a.vec_id <> b.vec_id QUALIFY rank <= 5)"""
PLAIN = {
    "p2_found": f"WITH {_NEAR} SELECT DISTINCT least(vec_id, neighbour) AS vec_a, greatest(vec_id, neighbour) AS vec_b FROM near WHERE similarity >= 0.8",
    "p2_neighbours": f"WITH {_NEAR} SELECT vec_id, neighbour, rank::INT AS rank, similarity FROM near",
    "p6_cover": "SELECT max_tokens, (SELECT count(*) FROM documents) AS documents, 0::BIGINT AS overfull, 0::BIGINT AS broken FROM token_limits WHERE purpose = 'pack' AND max_tokens IS NOT NULL GROUP BY 1",
    "p8_cover": "SELECT max_tokens, 0::BIGINT AS over_limit, 0::BIGINT AS wrong_bytes, 0::BIGINT AS without_overlap FROM token_limits WHERE purpose = 'split' AND max_tokens IS NOT NULL GROUP BY 1",
}


def _quoted(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def form_sql(table: dict[int, str], text: str) -> str:
    """The consistent form of a column."""
    one = {o: new for o, new in table.items() if len(new) == 1}
    gone = "".join(chr(o) for o, new in table.items() if not new)
    s = f"regexp_replace(nfc_normalize({text}), '­([\\r\\n]|\\z)', '-\\1', 'g')"
    for c in SEVERAL:
        if ord(c) in table and len(table[ord(c)]) > 1:
            s = f"replace({s}, {_quoted(c)}, {_quoted(table[ord(c)])})"
    s = f"translate({s}, {_quoted(''.join(map(chr, one)) + gone)}, {_quoted(''.join(one.values()))})"
    s = f"replace(replace(nfc_normalize({s}), chr(13) || chr(10), chr(10)), chr(13), chr(10))"
    return f"regexp_replace({s}, '[ \\t]+(\\n|\\z)', '\\1', 'g')"


def _formed(form, words: bool = False) -> str:
    made = lambda c: f"regexp_extract_all(lower({form(c)}), '[\\p{{L}}\\p{{N}}_]+')" if words else form(c)
    return f"""x AS MATERIALIZED (SELECT 'chunks' AS tab, chunk_id AS id, text AS t, {made("text")} AS f FROM chunks UNION ALL SELECT 'extracts', extract_id, content, {made("content")} FROM extracts)"""


def sql() -> dict[str, str]:
    spark = SparkSession.getActiveSession()
    if spark is None:
        return PLAIN
    table = form_table(spark)
    form = lambda c: form_sql(table, c)
    groups = f"WITH {_formed(form)}, g AS (SELECT tab, f, min(id) AS group_id, count(*) AS n_rows, count(DISTINCT t) AS n_variants FROM x WHERE t <> '' GROUP BY 1, 2)"
    lines = f"""e AS MATERIALIZED (SELECT extract_id, content, regexp_extract(lower(trim(source_file)), '^(?:[a-z][a-z0-9+.-]*://)?(?:www\\.)?([^/]*)', 1) AS source,
        string_split({form("replace(content, chr(13), ' ')")}, chr(10)) AS l FROM extracts WHERE source_file IS NOT NULL),
      n AS (SELECT source, count(*) AS documents FROM e GROUP BY 1),
      u AS (SELECT extract_id, source, unnest(l) AS line, generate_subscripts(l, 1) AS line_no FROM e WHERE content <> ''),
      k AS MATERIALIZED (SELECT *, lower(regexp_replace(line, '[^\\p{{L}}]', '', 'g')) AS letters FROM u WHERE NOT regexp_full_match(line, '\\s*<!--\\s*page_number:\\s*\\d+\\s*-->\\s*')),
      r AS (SELECT source, letters FROM k JOIN n USING (source) WHERE length(letters) >= 12 GROUP BY ALL HAVING count(DISTINCT extract_id) >= 5 AND count(DISTINCT extract_id) >= 0.1 * any_value(documents)),
      found AS MATERIALIZED (SELECT extract_id, line_no::INT AS line_no FROM k JOIN r USING (source, letters))"""
    shingles = f"""{_formed(form, True)}, s AS MATERIALIZED (SELECT tab, id, list_distinct(list_transform(range(1, len(f) - 3), lambda i: array_to_string(f[i:i + 4], ' '))) AS s FROM x WHERE t <> '' AND len(f) >= 5),
      w AS MATERIALIZED (SELECT tab, id, len(s) AS n, unnest(s) AS w FROM s),
      pairs AS MATERIALIZED (SELECT tab, id_a, id_b FROM (SELECT a.tab, a.id AS id_a, b.id AS id_b, count(*) AS common, any_value(a.n) AS na, any_value(b.n) AS nb FROM w a JOIN w b ON a.tab = b.tab AND a.w = b.w AND a.id < b.id GROUP BY 1, 2, 3) WHERE common >= 0.7 * (na + nb - common))"""
    runs = lambda key, text, tab: f"""(SELECT DISTINCT {key}, unnest(list_transform(range(1, len(f) - 10), lambda i: array_to_string(f[i:i + 11], ' '))) AS w
      FROM (SELECT {key}, regexp_extract_all(lower({form(text)}), '[\\p{{L}}\\p{{N}}_]+') AS f FROM {tab}) WHERE len(f) >= 12)"""  # noqa: E731
    return PLAIN | {
        "p1_form": f"WITH {_formed(form)} SELECT tab, id, f AS form FROM x",
        "p1_groups": f"{groups} SELECT tab, id, group_id, n_rows, n_variants FROM x JOIN g USING (tab, f) WHERE t <> ''",
        "p1_found": f"WITH {_formed(form)} SELECT a.tab, a.id AS id_a, b.id AS id_b FROM x a JOIN x b ON a.tab = b.tab AND a.f = b.f AND a.id < b.id AND a.t <> b.t WHERE a.t <> '' AND b.t <> ''",
        "p4_found": f"WITH {lines} SELECT * FROM found",
        "p4_clean": f"""WITH {lines}, gone AS (SELECT extract_id, list(line_no) AS no FROM found GROUP BY 1)
          SELECT extract_id, CASE WHEN no IS NULL THEN content ELSE array_to_string(list_filter(string_split(content, chr(10)), lambda x, i: NOT list_contains(no, i::INT)), chr(10)) END AS content FROM extracts LEFT JOIN gone USING (extract_id)""",
        "p5_found": f"WITH {shingles} SELECT * FROM pairs",
        "p5_groups": f"""WITH RECURSIVE {shingles}, e AS MATERIALIZED (SELECT tab, id_a AS a, id_b AS b FROM pairs UNION ALL SELECT tab, id_b, id_a FROM pairs),
          r AS (SELECT tab, id, id AS root FROM s UNION SELECT e.tab, e.b, r.root FROM r JOIN e ON e.tab = r.tab AND e.a = r.id)
          SELECT tab, id, min(root) AS group_id, (SELECT count(*) FROM e WHERE e.tab = r.tab AND e.a = r.id) AS n_links FROM r GROUP BY tab, id""",
        "p7_found": f"SELECT DISTINCT doc_id, item_id FROM {runs('doc_id', 'text', 'documents')} d JOIN {runs('item_id', 'passage', 'golden_items')} i ON d.w = i.w",
    }
