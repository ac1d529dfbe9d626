import random
import re
from collections import defaultdict

import pyarrow.parquet as pq
import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from foliospark.functions.textform import text_form
from foliospark.functions.words import words_of
from foliospark.llm import leaks, lookalike, packing, scanlines, scans, site_lines, splitting
from foliospark.llm.tokens import tokenizer

DATA = "/root/testdata/sf0.001"


def test_consistent_form_passes_other_columns_through(spark):
    d = spark.createDataFrame([(1, "Ａ b", "x"), (2, None, "y"), (3, "", "z")], "id int, text string, form string")
    got = {r.id: r for r in lookalike.consistent_form(d.withColumn("form_key", F.lit(1)), "text").collect()}
    assert [got[i].form for i in (1, 2, 3)] == ["A b", None, ""] and got[1].form_key == 1


def test_look_alike_pairs_and_groups(spark):
    rows = [(1, "peace"), (2, "реасе"), (3, "peace"), (4, "Peace"), (5, "pea​ce"), (6, None), (7, ""), (8, "x"), (None, "peace")]
    d = spark.createDataFrame(rows, "k long, t string").withColumns({"tab": F.lit("q"), "id": F.lit(0), "raw_key": F.lit(0)})
    keys = lookalike.look_alike_keys(d, "x", "k", "t").union(lookalike.look_alike_keys(d, "y", "k", "t").filter("id = 2"))
    pairs = sorted((r.tab, r.id_a, r.id_b) for r in lookalike.look_alike_pairs(keys).collect())
    assert pairs == [("x", 1, 2), ("x", 1, 5), ("x", 2, 3), ("x", 2, 5), ("x", 3, 5)]
    groups = {r.id: (r.group_id, r.n_rows, r.n_variants) for r in lookalike.look_alike_groups(keys).filter("tab = 'x'").collect()}
    assert groups == {1: (1, 4, 3), 2: (1, 4, 3), 3: (1, 4, 3), 5: (1, 4, 3), 4: (4, 1, 1), 8: (8, 1, 1)}
    empty = lookalike.look_alike_keys(d.limit(0), "x", "k", "t")
    assert lookalike.look_alike_pairs(empty).count() == lookalike.look_alike_groups(empty).count() == 0


def test_look_alike_hot_group(spark):
    d = spark.range(3000).select(F.col("id").alias("k"), F.when(F.col("id") < 1000, "same text").when(F.col("id") < 1002, "ѕame text").otherwise(F.concat(F.lit("t"), "id")).alias("t"))
    assert lookalike.look_alike_pairs(lookalike.look_alike_keys(d, "x", "k", "t")).count() == 2000


def site_truth(rows, form):
    total, have, at = defaultdict(int), defaultdict(set), []
    for i, f, t in rows:
        if f is None:
            continue
        s = re.sub(r"^www\.", "", re.sub(r"^[a-z]+://", "", f.lower())).split("/")[0]
        total[s] += 1
        for n, line in enumerate((t or "").split("\n"), 1):
            k = "".join(c for c in form(line) if c.isalpha()).lower()
            if len(k) >= 12:
                have[s, k].add(i)
                at.append((s, k, i, n))
    return {(i, n) for s, k, i, n in at if len(have[s, k]) >= 5 and len(have[s, k]) >= total[s] / 10}


def test_site_lines_equal_brute_force(spark):
    r = random.Random(4)
    lines = ["Share this page: {} times", "© All rights reserved by us", "short", "Once only line number {} of many"]
    rows = []
    for i in range(160):
        site = r.choice(["http://www.A.example/x", "a.example/y", "HTTPS://B.EXAMPLE/z", "c.example/q", None])
        body = [r.choice(lines).format(r.randrange(99)) for _ in range(r.randint(0, 5))] + [f"unique words here {'abcdefghij'[i % 10]} {'klmnopqrst'[i // 10 % 10]} {'uvw'[i // 100]} tail"]
        rows.append((i * 40_000, site, r.choice(["\n".join(body).replace("a", "а"), "\n".join(body), None, ""])))
    rows += [(7_000_000 + i, "c.example/q", None) for i in range(500)]
    d = spark.createDataFrame(rows, "k long, f string, t string").withColumns({"source": F.lit(1), "_lines": F.lit(2), "line_no": F.lit(3)})
    got = {(x.k, x.line_no) for x in site_lines.site_lines(d, "k", "f", "t").collect()}
    want = site_truth(rows, text_form(spark))
    assert got == want and want
    clean = {x.k: x for x in site_lines.without_site_lines(d, "k", "f", "t").collect()}
    assert len(clean) == len(rows) and clean[rows[0][0]]._lines == 2
    for i, _, t in rows:
        assert clean[i].t == (t if not t else "\n".join(x for n, x in enumerate(t.split("\n"), 1) if (i, n) not in want))


def test_site_line_bitmaps_turn_dense(spark):
    d = spark.range(9000).select(F.col("id").alias("k"), F.lit("a.example/x").alias("f"), F.when(F.col("id") % 2 == 0, "the very same line").otherwise("The very. same line 7").alias("t"))
    lines = site_lines.line_keys(d, "k", site_lines.source_of(F.col("f")), "t")
    boxes = site_lines.site_line_bitmaps(lines, spark.createDataFrame([("a.example", 9000)], "source string, documents long")).collect()
    assert len(boxes) == 1 and boxes[0].few is None and len(boxes[0].bits) == 4096
    assert site_lines.site_lines(d, "k", "f", "t").count() == 9000
    assert site_lines.site_lines(d.limit(0), "k", "f", "t").count() == 0


def check_plan(counts, capacity):
    plan = packing.Plan(counts, capacity)
    fill, seen = defaultdict(int), defaultdict(int)
    for size, first, n, per, box in plan.rows:
        assert first == seen[size]
        seen[size] += n
        for i in range(n):
            fill[box + i // per] += size
    assert dict(seen) == {s: n for s, n in counts.items() if n}
    assert sorted(fill) == list(range(plan.boxes)) and max(fill.values(), default=0) <= capacity
    return plan


@settings(max_examples=120, deadline=None)
@given(st.integers(1, 60).flatmap(lambda c: st.tuples(st.just(c), st.dictionaries(st.integers(1, c), st.integers(0, 40), max_size=20))))
def test_plans_hold_every_text_once(case):
    capacity, counts = case
    plan = check_plan(counts, capacity)
    least = -(-sum(s * n for s, n in counts.items()) // capacity)
    assert least <= plan.boxes <= 2 * least + 1


def test_plan_finds_the_optimum_where_it_is_known():
    assert check_plan({6: 3, 4: 3}, 10).boxes == 3
    assert check_plan({7: 2, 5: 2, 3: 2, 4: 1}, 10).boxes == 4
    assert check_plan({51: 10, 27: 10, 26: 10, 23: 20, 25: 2}, 100).boxes <= 11 / 9 * 16 + 6 / 9  # best-fit decreasing is never worse; 16 is optimal
    assert check_plan({}, 5).boxes == 0
    with pytest.raises(ValueError):
        packing.Plan({6: 1}, 5)


def test_packing_of_a_table(spark):
    rows = [(i, (i * 37) % 130) for i in range(2000)] + [(5000 + i, 64) for i in range(1500)] + [(9000, 1000), (9001, 0)]
    sizes = spark.createDataFrame(rows, "doc long, tokens long").withColumn("salt", F.lit("x"))
    got = packing.pack(sizes, "doc", 64).collect()
    per, boxes, oversized = defaultdict(int), defaultdict(int), set()
    for r in got:
        per[r.doc] += r.tokens
        if r.tokens:
            boxes[r.container] += r.tokens
        assert r.first_token == r.part * 64 and (r.container is None) == (r.tokens == 0)
        if r.part:
            oversized.add(r.doc)
    assert per == dict(rows) and max(boxes.values()) <= 64
    assert oversized == {i for i, n in rows if n > 64}
    assert sum(boxes.values()) / (64 * len(boxes)) > 0.97
    assert packing.pack(sizes.limit(0), "doc", 64).count() == 0


def test_packing_counts_tokens(spark):
    d = spark.createDataFrame([(1, "hello there"), (2, None), (3, ""), (None, "x"), (4, "a b c " * 300)], "k long, text string").withColumn("tokens", F.lit(9))
    got = {(r.max_tokens, r.k, r.part): r.tokens for r in packing.pack_all(d, "k", "text", [512, 2048]).collect()}
    assert got[512, 1, 0] == 2 and got[512, 2, 0] == got[512, 3, 0] == 0 and got[2048, 4, 0] == tokenizer().count("a b c " * 300) == got[512, 4, 0] + got[512, 4, 1]


ODD = ["x" * 5000, "日本語のテキスト" * 300, "a " * 3000, "\n" * 4000, " " * 5000, "# H\n\n" + "word. " * 900, "```\ncode\n" * 300, "| a | b |\n" * 400, "- item one\n" * 400, "é̂😀" * 900, "one\r\ntwo\r\n\r\n" * 300, "\x0c" * 3000, "don't can't won't I'll " * 300]


def check_pieces(text, limit, overlap):
    tok = tokenizer()
    p = splitting.Splitter(tok)
    prepared = p.prepare(text)
    raw, end, before = prepared[0], 0, None
    got = p.split(prepared, limit, overlap)
    if tok.count(raw.decode()) <= limit:
        assert got == []
        return
    for s, e, n, o in got:
        piece = raw[s:e].decode()
        assert tok.count(piece) == n <= limit
        assert s <= end < e and (before is None or s >= before)
        if before is not None and overlap:
            assert overlap <= o <= overlap + 3 or s == 0
        end, before = e, s
    assert end == len(raw)


@pytest.mark.parametrize("text", ODD)
@pytest.mark.parametrize(("limit", "overlap"), [(256, 32), (64, 0), (1024, 0), (40, 8)])
def test_pieces_of_odd_texts(text, limit, overlap):
    check_pieces(text, limit, overlap)


@settings(max_examples=60, deadline=None)
@given(st.text(min_size=200, max_size=600), st.sampled_from([(32, 4), (60, 10), (100, 0)]))
def test_pieces_of_any_text(text, limits):
    check_pieces(text, *limits)


def test_pieces_of_the_documents():
    for t in pq.read_table(f"{DATA}/documents.parquet")["text"].to_pylist():
        if t:
            check_pieces(t, 256, 32)
            check_pieces(t, 512, 64)


def test_splitting_prefers_headings(spark):
    part = "# Head {}\n\n" + "Some words go here. " * 40 + "\n\n"
    text = "".join(part.format(i) for i in range(6))
    d = spark.createDataFrame([(1, text), (2, None), (3, ""), (4, "short")], "k long, text string").withColumns({"piece": F.lit(1), "tokens": F.lit(1)})
    got = splitting.split_texts(d, "k", "text", [(256, 0), (180, 20)]).orderBy("max_tokens", "piece").collect()
    assert {r.k for r in got} == {1}
    assert all(r.text.startswith("# Head") for r in got if r.max_tokens == 256) and "".join(r.text for r in got if r.max_tokens == 256) == text
    assert splitting.split_texts(d.limit(0), "k", "text", [(256, 0)]).count() == 0


STRUCTURED = ["# A\n\n" + "".join(f"Paragraph {i} of the part says this and that, and then more of it.\n\n" for i in range(7)) + "# B\n\nOne line.\n\n# C\n\nAnother.\n",
              "Title\n=====\n\n- one of many items\n  - nested in it\n    - and deeper, with words\n  - nested too\n- two of them\n\n" * 8 + "Part\n----\n" + "text of the part. " * 60 + "\n<h2>Html</h2>\n" + "more text. " * 90]


@pytest.mark.parametrize("limit", [40, 100, 230])
def test_pieces_are_whole_siblings(limit):
    splitter = splitting.Splitter(tokenizer())
    for text in STRUCTURED + clean_texts(40):
        prepared = splitter.prepare(text)
        raw, ends, _, _, t, depth = prepared
        level = {int(ends[i]): int(d) for i, d in zip(t[::-1], depth[::-1])}  # of several places at one token, the first
        pieces = splitter.split(prepared, limit, 0)
        assert not pieces or (pieces[0][0] == 0 and pieces[-1][1] == len(raw) and all(a[1] == b[0] for a, b in zip(pieces, pieces[1:])))
        for s, e, n, _ in pieces:
            assert n <= limit
            within = [d for p, d in level.items() if s < p < e]
            if s in level and e in level and within:
                assert min(within) >= max(level[s], level[e]), raw[s:e]


def test_structure_has_nested_items_and_all_kinds_of_headings():
    raw = STRUCTURED[1].encode()
    depth = dict(zip(*splitting.boundaries(raw)))
    kind = lambda x: depth[raw.index(x)]
    assert kind(b"Part\n---") == 2 and kind(b"<h2>") == 2 and depth[raw.index(b"Title", 5)] == 1
    assert kind(b"- nested in") == splitting.ITEM + 1 and kind(b"- and deeper") == splitting.ITEM + 2 and kind(b"- nested too") == splitting.ITEM + 1 and kind(b"- two") == splitting.ITEM


def leak_truth(docs, items, run, form):
    runs = defaultdict(set)
    for i, p in items:
        w = words_of(form(p))
        for s in range(len(w) - run + 1):
            runs[tuple(w[s : s + run])].add(i)
    out = set()
    for d, t in docs:
        w = words_of(form(t))
        for s in range(len(w) - run + 1):
            out |= {(d, i) for i in runs.get(tuple(w[s : s + run]), ()) if d is not None and i is not None}
    return out


@pytest.mark.parametrize("portion", [10**6, 50])
def test_leaks_equal_brute_force(spark, monkeypatch, portion):
    monkeypatch.setattr(leaks, "MOST_INDEX_WORDS", portion)
    r = random.Random(8)
    vocabulary = [f"w{i}" for i in range(60)]
    items = [(i, " ".join(r.choice(vocabulary) for _ in range(r.randint(5, 40)))) for i in range(30)]
    items += [(90, items[0][1]), (91, None), (92, ""), (None, "a b"), (93, "same " * 30)]
    docs = [(99, None), (98, ""), (97, "same, same; " * 20), (96, "same " * 11)]
    for d in range(60):
        w = [r.choice(vocabulary) for _ in range(r.randint(0, 60))]
        for _ in range(r.randint(0, 2)):
            p = (r.choice(items)[1] or "").split()
            s = r.randrange(max(len(p), 1))
            w[5:5] = p[s : s + r.randint(6, 20)]
        docs.append((d, ", ".join(w).upper().replace("W1", "Ｗ1")))
    a = spark.createDataFrame(docs, "doc_id long, text string").withColumns({"item": F.lit(1), "_text": F.lit(1)})
    b = spark.createDataFrame(items, "item_id long, passage string").withColumn("item", F.lit(1))
    got = [(x.doc_id, x.item_id) for x in leaks.leaks(a, "doc_id", "text", b, "item_id", "passage").collect()]
    assert len(got) == len(set(got)) and set(got) == leak_truth(docs, items, 12, text_form(spark))
    assert leaks.leaks(a, "doc_id", "text", b.limit(0), "item_id", "passage").count() == 0
    assert leaks.leaks(a.limit(0), "doc_id", "text", b, "item_id", "passage").count() == 0


@pytest.mark.parametrize("portion", [10**6, 20])
def test_overlap_of_question_and_passage(spark, monkeypatch, portion):
    monkeypatch.setattr(leaks, "MOST_INDEX_WORDS", portion)
    passage = [f"p{i}" for i in range(20)]
    items = [(1, " ".join(passage), "who keeps the key of the gate"), (2, " ".join(passage[3:]), None), (3, "q " * 12, "never")]
    docs = [(10, "The key of: the GATE and " + ", ".join(passage[2:17])), (11, " ".join(passage[:11])), (12, None), (13, " ".join(passage))]
    a, b = spark.createDataFrame(docs, "d long, t string"), spark.createDataFrame(items, "i long, p string, q string")
    got = {(r.d, r.i): (r.passage_run, r.question_run, r.question_share) for r in leaks.leaks(a, "d", "t", b, "i", "p", "q").collect()}
    assert got == {(10, 1): (15, 5, round(4 / 6, 6)), (10, 2): (14, 0, None), (13, 1): (20, 0, 0.0), (13, 2): (17, 0, None)}


def test_wand_finds_what_a_full_scan_finds():
    r = random.Random(3)
    vocabulary = [f"w{i}" for i in range(40)]
    index = leaks.ItemIndex([(i, [r.choice(vocabulary) for _ in range(r.randint(12, 30))]) for i in range(300)])
    for _ in range(200):
        terms = sorted({index.terms[r.choice(vocabulary)] for _ in range(r.randint(1, 14))})
        score = defaultdict(float)
        for t in terms:
            for d, s in zip(index.docs[t], index.scores[t]):
                score[d] += s
        assert set(index.search(terms)) == {d for d, s in score.items() if s >= 1}


def clean_texts(n):
    rows = pq.read_table("/root/testdata/sf0.01/extracts.parquet", columns=["source_file", "content"]).to_pylist()
    return [r["content"] for r in rows if r["content"] and not r["source_file"].endswith(".pdf")][:n]


def test_line_model_on_held_out_pages():
    texts = clean_texts(230)
    model = scanlines.trained_model(texts[:120])
    maker, right, all_ = scanlines.PageMaker(77), 0, 0
    hits, wrong, missed = 0, 0, 0
    prose = [" ".join(b.split()) for t in texts[120:] for b in re.split(r"\n\s*\n", t) if len(b) > 150 and b[:1].isalpha() and "|" not in b]
    titles = ["The lantern and the bridge", "How to measure a river", "Regeln für den Turm"]
    for i in range(0, len(prose), 4):
        lines, title, labels = maker.document(prose[i : i + 6], maker.rng.choice(titles), maker.rng.choice(titles))
        got = model.label(lines, title)
        right += sum(a == b for a, b in zip(labels, got))
        all_ += len(labels)
        for a, b in zip(labels, got):
            hits += a == b and a in "hp"
            wrong += a != b and b in "hp"
            missed += a != b and a in "hp"
    assert right / all_ > 0.99 and hits / (hits + wrong) > 0.93 and hits / (hits + missed) > 0.93


def test_line_model_of_nothing():
    model = scanlines.trained_model([])
    assert model.label([""]) == " " and len(model.label(["a", "", "\x0c", "<!-- page_number: 3 -->"])) == 4


PAGE = """The bridge and the tower

Each workshop costs 67 marks, or 53 if the house mea-
sured the gate that season. The wbich is here in the iron-
bound furnace of the garden and the
12
The bridge and the tower
gate was found by a clerk of the cele¬
brated house that season."""


def scan_rows():
    clean = "The house measured the gate which is in the iron-bound furnace of the garden. The gate was found by a clerk of the celebrated house, which costs marks each season.\n\n"
    rows = [(i, "site.example/a.html", clean * 4) for i in range(12)] + [(2000 + i, "site.example/b.html", t) for i, t in enumerate(clean_texts(150))]
    return rows + [(100, "scans/b.PDF", PAGE), (101, "scans/c.pdf", None), (102, "scans/d.pdf", ""), (103, None, "x"), (104, "scans/e.pdf", "\n\n\x0c\n"), (None, "s/f.pdf", "x")]


def test_scan_noise_and_repair(spark):
    d = spark.createDataFrame(scan_rows(), "k long, f string, t string").withColumns({"id": F.lit(1), "words": F.lit(1), "scan": F.lit("x")})
    pages = scans.scanned_pages(d, "k", "f", "t").cache()
    found = {(r.k, r.line_no, r.kind) for r in scans.noise_lines(pages, "k").collect()}
    assert found == {(100, 3, "hyphen"), (100, 4, "ocr"), (100, 6, "page_no"), (100, 7, "header"), (100, 8, "hyphen")}
    text = {r.k: r.text for r in scans.repaired(pages, "k").collect()}
    assert text[100] == "The bridge and the tower\n\nEach workshop costs 67 marks, or 53 if the house measured the gate that season. The which is here in the iron-bound furnace of the garden and the gate was found by a clerk of the celebrated house that season."
    assert text[104] == ""
    assert scans.noise_lines(scans.scanned_pages(d.limit(0), "k", "f", "t"), "k").count() == 0


def test_misreadings_are_learned_by_alignment():
    common = ["gather", "kingdom", "picture", "village", "thunder", "ghost"]
    rare = [w.replace("g", "q", 1) for w in ("gather", "kingdom", "village", "ghost")] + ["piclure", "mountqin", "qather"]
    good = [(w, 100) for w in [*common, "mountain"]]
    assert scans.aligned_misreadings([(w, 1) for w in rare], good, 4) == [("q", "g")]
    assert scans.aligned_misreadings([(w, 50) for w in rare], good, 4) == [] == scans.aligned_misreadings([], [], 1)
    assert "village" in scans.undone("villaqe", [("q", "g")]) and "village" not in scans.undone("villaqe")


def test_all_words_show_misreadings(spark):
    good = [(f"{a}g{b}ing", 100 + i) for i, (a, b) in enumerate((a, b) for a in "abcdefghk" for b in "aeiou")] + [("other", 500), ("plain", 7)]
    rare = [(w.replace("g", "q", 1), 1 + n % 40) for w, n in good] + [("zzzz", 1)]
    found = scans.aligned(spark.createDataFrame(rare, "word string, n long"), spark.createDataFrame(good, "maybe string, times long"), 3)
    assert sorted(map(tuple, found.collect())) == scans.aligned_misreadings(rare, good, 3) != []


def test_line_model_comes_from_all_clean_texts(spark, monkeypatch):
    monkeypatch.setattr(scans, "TOGETHER", 8)
    prose = [r.text for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").filter("length(text) > 300").orderBy("doc_id").limit(30).collect()]
    texts = spark.createDataFrame([(i, t, i % 10 == 0) for i, t in enumerate(prose)], "id long, text string, scan boolean")
    dealt: dict[int, list[str]] = {}
    for r in texts.filter("not scan").selectExpr("cast(pmod(xxhash64(id, text), 4) as int) as part", "text").collect():
        dealt.setdefault(r.part, []).append(r.text)
    assert sum(map(len, dealt.values())) == 27 and len(dealt) > 1
    mean = np.mean([scanlines.trained_model(sorted(t), 1 + part).numbers() for part, t in dealt.items()], 0)
    model = scans._model(texts.repartition(3))
    assert np.allclose(model.numbers(), mean, atol=1e-6) and (model.numbers() == scans._model(texts.coalesce(1)).numbers()).all()


def test_labels_found_in_training_are_the_best():
    maker, model = scanlines.PageMaker(5), scanlines.LineModel()
    rng = np.random.default_rng(1)
    model.weights, model.pairs = rng.integers(-3, 4, model.weights.shape).astype(float), rng.integers(-3, 4, model.pairs.shape).astype(float)
    for _ in range(20):
        feats = scanlines.features(maker.document(["Some words of a paragraph that is long enough. " * 20] * 3, "A title", "Other")[0])
        each = [model._which(f) for f in feats]
        starts = np.cumsum([0, *(len(f) for f in each[:-1])])
        assert model._path(np.array(sum(each, [])), starts, [scanlines.BREAK_AT in f for f in each]) == model.best([feats])[0]


def test_misreadings_are_undone():
    assert {"which", "turn", "time"} <= {w for x in ("wbich", "tum", "tirne") for w in scans.undone(x)} and scans.undone("xyz") == []


def test_roman_and_decorated_page_numbers():
    assert [scanlines.page_value(x) for x in ("12", " - 7 -", "[33]", "p. 5", "Page 53 of 412", "xiv", "cccx.", "S. 9", "ixx", "12 dice", "mill", "")] == [12, 7, 33, 5, 53, 14, 310, 9, None, None, None, None]


@pytest.mark.parametrize(
    "text",
    [
        "a b\n - c d\n - e f\n" * 60,
        "- outer item of a list\n" + "    - inner item of it\n  * another one here\n" * 60,
        "def f(x):\n    if x:\n        return x + 1\n\n    # a remark\n    y = 2\n\treturn y\n" * 40,
    ],
)
def test_indented_lines_begin_pieces(text):
    check_pieces(text, 64, 0)
    p = splitting.Splitter(tokenizer())
    prepared = p.prepare(text)
    raw, ends, t = prepared[0], prepared[1], prepared[4]
    lines = {i + 1 for i, c in enumerate(raw[:-1]) if raw[i : i + 1] == b"\n" and raw[i + 1 : i + 2] != b"\n"}
    assert lines <= {int(ends[i]) for i in t}
    pieces = [raw[s:e] for s, e, _, _ in p.split(prepared, 64, 0)]
    assert len(pieces) > 3 and all(x.endswith(b"\n") for x in pieces)


def test_indented_remarks_are_no_headings():
    places, depth = splitting.boundaries(b"   # Head\nx = 1\n    # a remark\n\t# another\n  ## Second\n")
    assert [d for d in depth if d < splitting.BLOCK] == [2]


def test_queries_keep_their_invariants(spark):
    from foliospark.llm import queries

    data = "/root/testdata/sf0.001"
    run = lambda name: queries.QUERIES[name](spark, data).cache()
    noise = run("p3_found")
    assert noise.count() == noise.distinct().count() > 0 and {r.kind for r in noise.select("kind").distinct().collect()} <= {"header", "page_no", "hyphen", "ocr"}
    alone = noise.filter("kind in ('header', 'page_no')").join(noise.withColumnRenamed("kind", "other"), ["extract_id", "line_no"]).filter("kind <> other")
    assert alone.count() == 0
    assert noise.select("extract_id").distinct().join(run("p3_text"), "extract_id", "left_anti").count() == 0
    fill = run("p6_fill").collect()
    assert all(r.least <= r.containers <= 1.05 * r.least + 1 and r.fullest <= r.max_tokens for r in fill) and len(fill) == 2
    leaks_ = run("p7_overlap")
    assert {(r.doc_id, r.item_id) for r in leaks_.collect()} == {tuple(r) for r in run("p7_found").collect()} and leaks_.filter("passage_run < 12 or question_share > 1").count() == 0
    pieces = run("p8_split")
    assert pieces.select("doc_id", "max_tokens", "piece").distinct().count() == pieces.count() and pieces.filter("tokens > max_tokens").count() == 0
