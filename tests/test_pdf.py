import pytest

from foliospark.operators import audit
from foliospark.plans import readers
from foliospark.sources import files, formats, make, pdf

LINES = ["Erste Zeile (mit Klammern)", "second line, naïve Ω 你", "third"]


@pytest.mark.parametrize("packed", [True, False])
def test_text_layer_round_trip(packed):
    data = make.pdf(LINES, pages=2, packed=packed, outline=("One", "Two"))
    got = formats.READERS["pdf_text"]("a.pdf", data, {})
    assert got.content == "<!-- page_number: 1 -->\nErste Zeile (mit Klammern)\nsecond line, naïve Ω 你\n\n<!-- page_number: 2 -->\nthird"
    assert got.metadata == {"pages": "2", "title": "Büch", "producer": "maker"}
    assert pdf.Pdf(data).outline() == [(1, "One"), (1, "Two")]


def test_plain_fonts_kerning_forms_and_escapes():
    content = b"BT /F 10 Tf 50 700 Td [(W\\303\\(a\\)) -20 (ve) -400 (on)] TJ 0 -12 Td (it\\222s) Tj (next) ' ET q 1 0 0 1 0 0 cm /X Do Q"
    form = b"BT /F 10 Tf 50 500 Td <48656C6C6F> Tj ET"
    data = b"%PDF-1.4\n1 0 obj<</Type/Catalog/Pages 2 0 R>>endobj 2 0 obj<</Type/Pages/Kids[3 0 R]>>endobj 3 0 obj<</Type/Page/Contents 4 0 R/Resources<</Font<</F 5 0 R>>/XObject<</X 6 0 R>>>>>>endobj\n"
    data += b"4 0 obj<</Length %d>>stream\n%s\nendstream endobj 5 0 obj<</Type/Font/BaseFont/ABCDEF+CMR10>>endobj 6 0 obj<</Subtype/Form/Length %d>>stream\n%s\nendstream endobj\ntrailer<</Root 1 0 R>>" % (len(content), content, len(form), form)
    page = next(pdf.pages(pdf.Pdf(data)))
    assert page.text == "WÃ(a)ve on\nit’snext\nHello" and page.fonts == ["ABCDEF+CMR10"] and page.width == 612


def test_routing_by_density():
    formats.register("fake_ocr", lambda n, d, p: formats.Extracted("recognised"))
    dense, sparse = make.pdf(["word " * 40]), make.pdf(["x"])
    assert formats.READERS["pdf"]("a.pdf", dense, {}).metadata["route"] == "text"
    assert formats.READERS["pdf"]("a.pdf", sparse, {"ocr_reader": "fake_ocr"}).content == "recognised"
    assert formats.READERS["pdf"]("a.pdf", b"junk", {"ocr_reader": "fake_ocr"}).content == "recognised"
    assert formats.READERS["pdf"]("a.pdf", sparse, {"min_avg_chars_per_page": 1}).metadata == {"pages": "1", "title": "Büch", "producer": "maker", "route": "text", "avg_chars_per_page": "1.0", "threshold": "1"}
    with pytest.raises(ValueError, match="no text layer"):
        formats.READERS["pdf"]("a.pdf", sparse, {})


def test_pages_of_files_are_measured(spark):
    locked = make.pdf(LINES, packed=False).replace(b"trailer <<", b"trailer << /Encrypt 9 0 R")
    rows = [("scan", make.pdf([], pages=3, covered=True)), ("tex", make.pdf(["a " * 100], fonts=("ABCDEF+CMR10", "CMMI7"), label="x")), ("bad", b"junk"), ("none", None), ("locked", locked)]
    found = pdf.pdf_pages(spark.createDataFrame(rows, "path string, content binary")).cache()
    assert {r.path for r in found.filter("error is not null").collect()} == {"bad", "none", "locked"}
    m = {r.path: r for r in audit.page_metrics(found.filter("error is null"), "path").collect()}
    assert (m["scan"].pages, m["scan"].full_page_image_share, m["scan"].image_only_page_share, m["scan"].page_labels) == (3, 1.0, 1.0, False)
    assert (m["tex"].full_page_image_share, m["tex"].latex_font_page_share, m["tex"].math_font_page_share, m["tex"].page_labels) == (0.0, 1.0, 1.0, True)
    assert pdf.pdf_outline(spark.createDataFrame(rows, "path string, content binary")).count() == 0
    docs = files.extract(spark.createDataFrame(rows, "path string, content binary").selectExpr("concat(path, '.pdf') as path", "content"))
    assert {r.path: bool(r.error) for r in docs.collect()} == {"scan.pdf": True, "tex.pdf": False, "bad.pdf": True, "none.pdf": True, "locked.pdf": True}


def test_audited_pdfs_are_made_and_read_once(spark, tmp_path, monkeypatch):
    spark.createDataFrame([(1, "one\ntwo"), (2, None)], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    scans = []
    read = readers.texts
    monkeypatch.setattr(readers, "texts", lambda *a: scans.append(a) or read(*a))
    out = readers.pdf_audit(spark, str(tmp_path))
    assert {(r.doc, r.origin) for r in out.collect()} == {(f"{k}:{i}", o) for k, o in (("latex", "typeset"), ("scan", "scan_image_only"), ("plain", "converted")) for i in (1, 2)}
    assert len(scans) == 1 and out._jdf.queryExecution().optimizedPlan().toString().count("MapInArrow") == 2  # one makes, one reads


def test_pages_with_their_number_take_no_window(spark):
    found = pdf.pdf_pages(spark.createDataFrame([("a", make.pdf(["x"] * 90, pages=90))], "path string, content binary"))
    assert {r.page_count for r in found.collect()} == {90}
    m = audit.page_metrics(found, "path", keep=("producer",), count="page_count")
    assert m.select("pages", "sampled_pages", "producer").collect() == [(90, 40, "maker")] and "Window" not in m._jdf.queryExecution().optimizedPlan().toString()


def test_odd_values_are_parsed():
    assert pdf.parse(b" % ] x\n[<4 1> (a(b)\\051) /A#20b 3 0 R -.5 true <</K [1]>> ]", 0)[0] == [b"A", b"a(b))", "A b", pdf.Ref(3), -0.5, b"true", {"K": [1.0]}]
    assert pdf.parse(b"<</A [1 2", 0)[0] == {"A": [1.0, 2.0]} and pdf.parse(b"<4>", 0)[0] == b"@"
