import datetime as dt
import re
import uuid
import warnings

import numpy as np
import pytest
from pyspark.sql import functions as F

from foliospark.operators import audit, chunking, cleaning, exact, families, images, retrieval, vectors


def one(df):
    return df.first()[0]


def test_exact_duplicates(spark):
    rows = [(3, "a"), (1, "a"), (2, "b"), (4, None), (5, None), (6, ""), (7, ""), (8, "c")]
    d = spark.createDataFrame(rows, "k long, t string")
    assert {r.k: r.kept for r in exact.exact_duplicates(d, "k", F.col("t")).collect()} == {3: 1, 1: 1, 2: 2, 4: 4, 5: 5, 6: 6, 7: 6, 8: 8}
    assert exact.without_duplicates(d, "k", F.col("t")).count() == 6
    assert exact.exact_duplicates(d.limit(0), "k", F.col("t")).count() == 0


@pytest.mark.parametrize(
    ("text", "rules", "want"),
    [
        ("a​b﻿c‌‍", {}, "abc"),
        ("a \t\nb　\r\nc", {}, "a\nb\nc"),
        ("a\n\n\n\nb", {}, "a\n\nb"),
        ("a\n\n\n\nb", {"collapse_newlines": False}, "a\n\n\n\nb"),
        ("keep\nAD 12\nend", {"regex_removals": (r"^AD \d+$\n",)}, "keep\nend"),
        ("x [1] y", {"regex_removals": (r"\[\d+\]", "(bad")}, "x  y"),
        ("A\n\na\n\nB\n\nC\n\nb\n\nc", {"deduplicate_paragraphs": True}, "A\n\nB\n\nC"),
        ("", {}, ""),
        (None, {}, None),
        ("  \n ", {}, ""),
    ],
)
def test_clean(spark, text, rules, want):
    with warnings.catch_warnings():
        warnings.simplefilter("ignore")
        d = spark.createDataFrame([(text,)], "t string")
        assert one(d.select(cleaning.clean(F.col("t"), cleaning.CleanupRules(**rules)))) == want


def test_rules_are_held(spark):
    d = spark.createDataFrame([(1, "x" * 200 + " ad"), (2, None), (3, "")], "k int, t string")
    rules = [{"pattern": " ad", "confidence": 99}, {"pattern": "x", "confidence": 95}, {"pattern": "y", "confidence": 99}, {"pattern": "x", "confidence": 40}, {"pattern": "(", "confidence": 99}, {"pattern": "z"}]
    got = {r.k: r for r in cleaning.apply_rules(d, "k", "t", rules).collect()}
    assert got[1].text == "x" * 200
    assert [re.sub(r"[ (:].*", "", h.reason) for h in got[1].held] == ["Blast", "Low", "Invalid", "Low"]
    assert got[1].held[0].removed_chars == 200 and got[2].text is None and got[3].text == ""


def test_sample(spark):
    long = "".join(chr(97 + i % 26) for i in range(20001))
    d = spark.createDataFrame([(long,), ("short",), (None,)], "t string")
    got = [r[0] for r in d.select(cleaning.sample(F.col("t"))).collect()]
    assert got[0] == long[:3000] + cleaning.MIDDLE + long[8500:11500] + cleaning.END + long[-3000:]
    assert got[1:] == ["short", None]


def test_chunks_carry_pages_and_are_numbered(spark):
    text = "<!-- page_number: 1 -->\n# One\n\nfirst\n\n<!-- page_number: 2 -->\n## Two\n\nsecond\n\n### Three\nthird\n\n<!-- page_number: 3 -->\n# Four\nlast"
    d = spark.createDataFrame([(1, text), (2, None), (3, " \n"), (4, "plain")], "k int, t string")
    got = chunking.chunk_markdown(d, "k", "t").orderBy("k", "chunk_index").collect()
    assert [(r.k, r.chunk_index, r.page_number, r.section) for r in got] == [(1, 0, 2, "One"), (1, 1, 2, "Two"), (1, 2, 3, "Three"), (1, 3, 3, "Four"), (4, 0, None, None)]
    assert all("page_number" not in r.text and r.text for r in got)
    page = chunking.number_chunks(chunking.split_markdown(d, "k", "t"), "k", F.lit(9)).filter("k = 1").select("page_number").distinct()
    assert [r[0] for r in page.collect()] == [9]


def test_pieces_are_bounded_and_complete():
    text = "\n\n".join(" ".join(f"word{i}x{j}" for j in range(i % 37 + 1)) for i in range(120)) + " " + "y" * 2500
    got = chunking.pieces(text, 300, 60)
    assert max(map(len, got)) <= 300
    assert set(re.findall(r"word\w+", text)) <= set(re.findall(r"word\w+", " ".join(got)))
    assert chunking.pieces("", 10, 2) == [] and chunking.pieces("abc", 10, 2) == ["abc"]
    with pytest.raises(ValueError):
        chunking.pieces("a", 5, 6)


def test_headers_in_code_are_text():
    got = chunking.sections("# A\n```\n# no\n```\ntext\n## B\nx")
    assert [t for _, t in got] == [{1: "A"}, {1: "A", 2: "B"}] and "# no" in got[0][0]


def test_vector_identity_and_upsert(spark):
    d = spark.createDataFrame([("f", None, None, 3), ("f", "chunk", "", 3), ("f", "chunk", "s", 3)], "filename string, level string, section string, i int")
    ids = [r[0] for r in d.select(vectors.vector_id(F.col("filename"), F.col("level"), F.col("section"), F.col("i"))).collect()]
    assert ids[0] == ids[1] == str(uuid.uuid5(uuid.NAMESPACE_URL, "f|chunk||3")) != ids[2]
    old = spark.createDataFrame([("a", "f", 1), ("b", "f", 2), ("c", "g", 3), ("d", None, 4)], "id string, file string, v int")
    new = spark.createDataFrame([("a", "f", 9), ("e", "f", 8)], "id string, file string, v int")
    assert {r.id: r.v for r in vectors.upsert(old, new, "id").collect()} == {"a": 9, "b": 2, "c": 3, "d": 4, "e": 8}
    again = vectors.upsert(vectors.upsert(old, new, "id"), new, "id")
    assert again.count() == 5
    assert {r.id: r.v for r in vectors.upsert(old, new, "id", "file").collect()} == {"a": 9, "c": 3, "d": 4, "e": 8}


def test_search_and_near_copies(spark):
    v = spark.createDataFrame([(1, [1.0, 0.0], "a"), (2, [1.0, 0.01], "b"), (3, [0.0, 1.0], "b"), (4, None, "c"), (5, [0.0, 0.0], "c"), (6, [2.0, 0.0], "")], "id long, e array<double>, file string")
    q = spark.createDataFrame([(10, [1.0, 0.0], "a"), (11, [0.0, 2.0], "b"), (12, None, "b"), (13, [0.0, 3.0], "z")], "q long, e array<double>, file string")
    got = vectors.search(v, "id", "e", q, "q", "e", 2, 2)
    assert sorted((r.q, r["rank"], r.id, r.score) for r in got.collect()) == [(10, 1, 1, 1.0), (10, 2, 6, 1.0), (11, 1, 3, 1.0), (11, 2, 2, 0.01), (13, 1, 3, 1.0), (13, 2, 2, 0.01)]
    dropped = vectors.near_copies(got, v, q, "id", "q", "file", 0.99)
    assert [r.q for r in dropped.collect()] == [13]  # 10 and 11 have their nearest in their own file
    assert vectors.search(v, "id", "e", q.limit(0), "q", "e", 2, 2).count() == 0
    assert one(spark.sql("select array(3.0, 4.0) a, array(4.0, 3.0) b").select(F.round(vectors.cosine(F.col("a"), F.col("b")), 6))) == 0.96


def test_batch_copies_ask_for_every_row_of_the_batch(spark, tmp_path):
    from datetime import datetime

    from foliospark.plans import retrieval

    e = lambda i: [float(j == i) for j in range(64)]
    rows = [(7, "a", e(0), 0, 1), (8, "b", e(1), 1, 1), (101, "b", e(0), 0, 3), (102, "b", e(1), 9, 3), (103, "c", e(2), 0, 3), (104, "c", e(0), 4, 3), (105, "d", e(2), 0, 3)]
    schema = "vec_id long, filename string, embedding array<float>, chunk_index int, indexed_at timestamp_ntz, level string, section string"
    spark.createDataFrame([(i, f, v, n, datetime(2025, m, 1), None, None) for i, f, v, n, m in rows], schema).write.parquet(f"{tmp_path}/vectors.parquet")
    assert sorted(r.query_id for r in retrieval.batch_copies(spark, str(tmp_path)).collect()) == [101, 104]
    assert retrieval.chunk_dedup(spark, str(tmp_path)).count() == 0  # its query set is the search's


def test_search_with_more_queries_than_a_block(spark, monkeypatch):
    monkeypatch.setattr(vectors, "ASKED", 3)
    x = np.random.default_rng(1).normal(size=(40, 4))
    d = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "id long, e array<double>")
    got = {(r.q, r["rank"]): r.id for r in vectors.search(d, "id", "e", d.withColumnRenamed("id", "q"), "q", "e", 2, 4, True).collect()}
    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    s = np.round(u @ u.T, 6) - 9 * np.eye(40)
    assert got == {(i, k + 1): int(j) for i in range(40) for k, j in enumerate(np.argsort(-s[i], kind="stable")[:2])}


def test_similarity_of_stores(spark):
    d = spark.createDataFrame([(0.9, "qdrant"), (0.25, "chroma"), (200.0, "chroma_l2"), (None, "qdrant")], "s double, st string")
    assert [r[0] for r in d.select(vectors.similarity_of(F.col("s"), F.col("st"))).collect()] == [0.9, 0.75, None, None]


def test_recall_with_page_tolerance(spark):
    golden = spark.createDataFrame([(1, "f", 10), (2, "f", 10), (3, "f", None), (4, None, 1), (5, "g", 1)], "item_id long, expected_source string, expected_page int")
    results = spark.createDataFrame([(1, 1, "x", 10), (1, 2, "f", 11), (2, 1, "f", 13), (3, 1, "f", 99), (5, 6, "g", 1), (None, 1, "f", 1)], "item_id long, rank int, filename string, page_number int")
    hits = retrieval.recall_hits(results, golden, "item_id")
    assert {r.item_id: (r.hit, r.hit_rank) for r in hits.collect()} == {1: (True, 2), 2: (False, None), 3: (True, 1), 5: (False, None)}
    assert tuple(retrieval.recall(hits).first()) == (4, 2, 0.5)
    assert retrieval.recall(hits.limit(0)).first().recall is None


def test_prompts(spark):
    d = spark.createDataFrame([(1, "why?", 2, " b ", "f.md", None, "S", None), (1, "why?", 1, "a", None, 3, "", "section"), (2, "q", 1, None, "g", 1, None, "chunk")], "k int, q string, rank int, text string, f string, p int, s string, l string")
    d = d.withColumn("description", retrieval.describe_source(F.col("f"), F.col("p"), F.col("s"), F.col("l")))
    got = {r.k: r.prompt for r in retrieval.prompts(d, ["k"], "q", "rank", "text", "description").collect()}
    assert got[1] == "Context passages:\n\n[1] (unknown file, page 3, section summary)\na\n\n[2] (f.md, page unknown, section: S)\nb\n\nQuestion: why?"
    assert got[2].endswith("[1] (g, page 1)\n\n\nQuestion: q")
    assert one(d.filter("k = 2").select(retrieval.snippet(F.lit("a\n" * 150)))) == "a " * 100 + "..."


def test_section_texts_keep_order_and_limit(spark):
    rows = [("f", "s", i, f"{i:03d}" + "x" * 97) for i in range(200)] + [("f", "", 0, "no"), ("f", None, 0, "no"), ("g", "s", 0, None)]
    d = spark.createDataFrame(rows, "file string, section string, i int, t string")
    r = retrieval.section_texts(d, "file", "section", ["i"], "t").collect()
    assert len(r) == 1 and r[0].chunks == 200 and len(r[0].text) == 8000 and r[0].text == "\n".join(x[3] for x in rows[:200])[:8000]


def test_file_names(spark):
    md5 = "0123456789abcdef0123456789ABCDEF"
    names = [f"A Book -- B. Writer -- 2nd ed., 2022 -- 978-1-4028-9462-6, 0-306-40615-2 -- Press 1999 -- {md5} -- Anna’s Archive.pdf", "plain name.v2.epub", None, "T -- A.pdf", ".hidden"]
    d = spark.createDataFrame([(n,) for n in names], "n string")
    got = [r[0] for r in d.select(audit.parse_name(F.col("n"))).collect()]
    assert got[0].asDict() == {"is_archive_name": True, "title": "A Book", "authors": "B. Writer", "year": 2022, "isbns": ["9781402894626", "0306406152"], "md5": md5.lower(), "other": ["2nd ed., 2022", "Press 1999"]}
    assert (got[1].title, got[1].is_archive_name, got[1].authors) == ("plain name.v2", False, None)
    assert (got[3].title, got[3].authors, got[3].is_archive_name) == ("T", "A", False) and got[4].title == ".hidden"
    assert got[2] is None or got[2].title is None


def test_shared_isbns(spark):
    rows = [("one", "a", ["1"]), ("un", "a", ["1"]), ("un", "b", []), ("yes", "a", ["2", "1"]), ("yes", "b", ["1", "3"]), ("yes", "c", None), ("no", "a", ["1"]), ("no", "b", ["2"])]
    got = audit.shared_isbns(spark.createDataFrame(rows, "t string, n string, i array<string>"), "t", "n", "i")
    assert {r.t: (r.status, r.shared) for r in got.collect()} == {"one": ("single_candidate", []), "un": ("unknown", []), "yes": ("match", ["1"]), "no": ("no_isbn_overlap", [])}


def test_merge_keeps_decisions(spark):
    old = spark.createDataFrame([("a", 1, "mine"), ("b", 2, None)], "k string, v int, decision string")
    new = spark.createDataFrame([("a", 10), ("c", 30)], "k string, v int")
    assert sorted((r.k, r.v, r.decision) for r in audit.merge_preserving(old, new, "k", "decision").collect()) == [("a", 10, "mine"), ("b", 2, None), ("c", 30, None)]


def test_page_metrics(spark):
    body = "word " * 60
    rows = [("d", i, f"{i + 5}\n{body}\nfi-\nﬁne", ["ABC+CMMI10"] if i < 5 else [], i % 2 == 0) for i in range(10)] + [("e", 0, None, None, False)]
    pages = spark.createDataFrame(rows, "d string, i int, text string, fonts array<string>, full boolean")
    pages = pages.withColumns({"width": F.lit(10.0), "height": F.lit(10.0), "images": F.when(F.col("full"), F.expr("array(struct(0.0 as x0, 0.0 as y0, 10.0 as x1, 9.0 as y1))")), "label": F.lit(None).cast("string"), "page_count": F.lit("clash")})
    got = {r.d: r for r in audit.page_metrics(pages, "d").collect()}
    d = got["d"]
    assert (d.pages, d.sampled_pages, d.has_text_layer, d.ligature_chars, d.math_font_page_share, d.latex_font_page_share, d.full_page_image_share, d.page_labels) == (10, 10, True, 10, 0.5, 0.5, 0.5, False)
    assert (d.printed_offset, d.printed_detected, d.printed_agreement) == (-4, True, 0.6) and got["e"].avg_chars_per_page == 0
    assert audit.sampled(spark.range(100).select(F.lit("x").alias("d"), F.col("id").alias("i")), "d", "i").count() == 40


def test_origin(spark):
    rows = [(None, 0.9, 200.0, 0.0), (None, 0.9, 1.0, 0.0), ("ABBYY with calibre", 0.0, 9.0, 0.0), ("Calibre", 0.0, 9.0, 0.0), ("pdfTeX", 0.0, 9.0, 0.0), ("", 0.0, 9.0, 0.6), ("", 0.0, 9.0, 0.1)]
    d = spark.createDataFrame(rows, "p string, f double, a double, l double")
    got = [r[0] for r in d.select(audit.origin(F.col("p"), F.col("f"), F.col("a"), F.col("l"))["origin"]).collect()]
    assert got == ["scan_ocr", "scan_image_only", "scan_ocr", "converted", "typeset", "typeset", "unknown"]


def test_back_matter_ends_before_the_next_top_entry(spark):
    toc = spark.createDataFrame([("d", 0, 1, "Intro", 1), ("d", 1, 1, "Glossary ", 50), ("d", 2, 2, "Index", 51), ("d", 3, 1, "Index", 60)], "d string, o int, level int, title string, page int")
    assert sorted((r.title, r.first_page, r.last_page) for r in audit.back_matter(toc, "d", "o", "level", "title", "page", F.lit(70)).collect()) == [("Glossary", 50, 59), ("Index", 60, 70)]


def test_image_links(spark):
    d = spark.createDataFrame([(1, "a ![x](p (1).png) b\n![](q.png)\nc ![x](p (1).png) b"), (2, None), (3, "none")], "k int, t string").withColumn("_r", F.lit(1))
    got = d.select("k", F.posexplode(images.links(F.col("t"))).alias("n", "l")).select("k", "n", "l.match", "l.path").collect()
    assert [(r.n, r.path) for r in got] == [(0, "p (1).png"), (1, "q.png"), (2, "p (1).png")]
    assets = spark.createDataFrame([(1, "q.png", b"\1")], "k int, path string, content binary")
    kept = images.existing_links(d, "k", "t", assets, "k", "path")
    assert [(r.k, r.n) for r in kept.collect()] == [(1, 1)]
    assert '"data":"AQ=="' in images.requests(kept, "k", assets, "read").first().line
    results = spark.createDataFrame([(1, 0, "![x](p (1).png)", "TEXT"), (1, 5, "![x](p (1).png)", "later")], "k int, n int, match string, result string")
    out = {r.k: r.t for r in images.inject(d, "k", "t", results).collect()}
    assert out[1].count("![x](p (1).png)\n\nTEXT\n\n") == 2 and "later" not in out[1] and out[2] is None and out[3] == "none"
    d = spark.createDataFrame([('{"response": {"candidates": [{"content": {"parts": [{"text": "hi"}]}}]}}',), ("{}",), (None,)], "r string")
    assert [r[0] for r in d.select(images.recognised(F.col("r"))).collect()] == ["hi", images.FAILED, images.FAILED]


def test_latest_prefers_known_times(spark):
    t = dt.datetime(2025, 1, 1)
    d = spark.createDataFrame([("a", 1, t), ("a", 2, None), ("b", 3, None), ("b", 4, None), (None, 5, t)], "id string, n int, at timestamp")
    got = vectors.latest(d, "id", F.col("at").isNotNull(), F.col("at"), F.col("n"))
    assert {r.id: r.n for r in got.collect()} == {"a": 1, "b": 4}


def test_rules_in_answers(spark):
    answers = ['```json\n[{"pattern": "a", "confidence": 90.0}, {"description": "no pattern"}, 3]\n```', '{"x": 1, "rules": [{"pattern": "b", "description": "d"}]}', '{"pattern": "c", "confidence": true}', "no json", "", None, "3", '```\n{"pattern": "e"}\n```  ']
    got = spark.createDataFrame(list(enumerate(answers)), "n int, a string").select("n", cleaning.answered_rules(F.col("a")).alias("r")).orderBy("n").collect()
    plain = [None if r.r is None else [tuple(x) for x in r.r] for r in got]
    assert plain == [[("a", "", 90)], [("b", "d", None)], [("c", "", None)], None, None, None, None, [("e", "", None)]]
    d = spark.createDataFrame([(1, "text"), (2, None), (3, "")], "k int, t string")
    assert [tuple(r) for r in cleaning.propose_rules(d, "k", "t", lambda t: '[{"pattern": "x%d"}]' % len(t)).collect()] == [(1, "x4", "", None)]


def test_fixed_windows_equal_pieces_without_separators(spark):
    texts = ["", None, "short", "x" * 1000, "y" * 1001, "a b " * 700, "z" * 1800, " " * 3000, "w" * 1801]
    d = spark.createDataFrame(list(enumerate(texts)), "k int, t string")
    got = {}
    for r in chunking.split_fixed(d, "k", "t").orderBy("k", "split").collect():
        got.setdefault(r.k, []).append(r.text)
    assert got == {k: p for k, t in enumerate(texts) if t and (p := chunking.pieces(t, 1000, 200, ("",)))}


def test_first_of_md5_and_manifest(spark):
    d = spark.createDataFrame([("t", "b.PDF", 2), ("t", "a.pdf", 2), ("t", "c.epub", 1), ("u", "x.txt", 1), ("v", None, 1)], "title string, name string, at int")
    assert [tuple(r) for r in audit.first_of(d, "title", "name", "pdf", "at").collect()] == [("t", "a.pdf")]
    m = spark.createDataFrame([(None, "x"), ("9DD4E461268C8034F5C8564E155C67A6", "x"), ("0" * 32, "x"), ("0" * 32, None)], "m string, c string")
    assert [r[0] for r in m.select(audit.md5_agrees(F.col("m"), F.col("c"))).collect()] == [None, True, False, None]
    rows = spark.createDataFrame([("Ö", ["a"], 1), ("A", None, 2)], "title string, files array<string>, n int")
    assert audit.manifest_yaml(rows, "title").split("\n", 2)[2] == "A:\n  files: null\n  n: 2\nÖ:\n  files:\n  - a\n  n: 1\n"


def test_exact_similarity_of_pairs(spark):
    d = spark.createDataFrame([(1, "a b c d e f"), (2, "a b c d e g"), (3, None), (4, ""), (5, "a b c d e f")], "k long, t string")
    pairs = spark.createDataFrame([(1, 2), (1, 5), (3, 4), (1, 3)], "rep_a long, rep_b long")
    got = {(r.rep_a, r.rep_b): r.jaccard for r in families.exact_similarity(pairs, d, "k", "t").collect()}
    assert got == {(1, 2): 0.333333, (1, 5): 1.0, (3, 4): 0.0, (1, 3): 0.0}


def test_search_in_several_blocks_of_queries(spark, monkeypatch):
    monkeypatch.setattr(vectors, "QUERY_BLOCK_FLOATS", 64 * 3)
    rows = [(i, [float((i * j) % 7 + 1) for j in range(64)]) for i in range(20)]
    d = spark.createDataFrame(rows, "v long, e array<float>")
    q = d.withColumnRenamed("v", "q")
    many = sorted(map(tuple, vectors.search(d, "v", "e", q, "q", "e", 2).collect()))
    monkeypatch.setattr(vectors, "QUERY_BLOCK_FLOATS", 10**6)
    assert many == sorted(map(tuple, vectors.search(d, "v", "e", q, "q", "e", 2).collect())) and len(many) == 40
