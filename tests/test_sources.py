import datetime as dt
import io
import json
import zipfile

import pytest
from pyspark.sql import functions as F

from foliospark.sources import epub, files, formats, markdown
from foliospark.streaming import ingest


def zipped(**members):
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        for name, text in members.items():
            z.writestr(name.replace("__", "/"), text)
    return out.getvalue()


def archive(items):
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        for name, text in items.items():
            z.writestr(name, text)
    return out.getvalue()


HTML = """<html><head><title>no</title><script>x()</script></head><body><header>top</header><nav>menu</nav><h1>Title</h1><p>Some <b>bold</b> and
<a href="u">link</a>.</p><ul><li>one</li><li>two<ul><li>deep</li></ul></li></ul><ol><li>first</li></ol><table><tr><th>a</th><th>b</th></tr><tr><td>1</td><td>x<br>y</td></tr></table>
<pre>code  here</pre><img src="data:image/png;base64,AQID" alt="pic"><img src="far.png"><footer>end</footer></body></html>"""

W = 'xmlns:w="http://schemas.openxmlformats.org/wordprocessingml/2006/main" xmlns:r="http://schemas.openxmlformats.org/officeDocument/2006/relationships" xmlns:a="http://schemas.openxmlformats.org/drawingml/2006/main"'
DOCX = {
    "word/document.xml": f'<w:document {W}><w:body><w:p><w:r><w:t>Hello </w:t></w:r><w:r><w:t>there</w:t></w:r></w:p><w:p><w:r><w:drawing><a:blip r:embed="r1"/></w:drawing></w:r></w:p>'
    "<w:tbl><w:tr><w:tc><w:p><w:r><w:t>A</w:t></w:r></w:p></w:tc><w:tc><w:p><w:r><w:t>B</w:t></w:r></w:p></w:tc></w:tr><w:tr><w:tc><w:p><w:r><w:t>1</w:t></w:r></w:p></w:tc><w:tc><w:p/></w:tc></w:tr></w:tbl></w:body></w:document>",
    "word/_rels/document.xml.rels": '<Relationships><Relationship Id="r1" Type="http://x/image" Target="media/i.png"/></Relationships>',
    "word/media/i.png": "png",
}
XLSX = {
    "xl/workbook.xml": '<workbook xmlns:r="r"><sheets><sheet name="S1" r:id="a"/><sheet name="Empty" r:id="b"/></sheets></workbook>',
    "xl/_rels/workbook.xml.rels": '<Relationships><Relationship Id="a" Target="worksheets/sheet1.xml"/><Relationship Id="b" Target="/xl/worksheets/sheet2.xml"/></Relationships>',
    "xl/sharedStrings.xml": "<sst><si><t>name</t></si><si><r><t>a</t></r><r><t>nn</t></r></si></sst>",
    "xl/worksheets/sheet1.xml": '<worksheet><sheetData><row><c r="A1" t="s"><v>0</v></c><c r="C1" t="inlineStr"><is><t>n</t></is></c></row><row><c r="A2" t="s"><v>1</v></c><c r="C2"><v>5</v></c></row></sheetData></worksheet>',
    "xl/worksheets/sheet2.xml": "<worksheet><sheetData/></worksheet>",
}
PPTX = {
    "ppt/slides/slide2.xml": "<s><p><t>second</t></p></s>",
    "ppt/slides/slide1.xml": "<s><p><t>fir</t><t>st</t></p></s>",
    "ppt/slides/_rels/slide1.xml.rels": '<R><r Type="x/notesSlide" Target="../notesSlides/n1.xml"/></R>',
    "ppt/notesSlides/n1.xml": "<n><p><t>say this</t></p><p><t>1</t></p></n>",
}
ODT = {"content.xml": '<d xmlns:text="t" xmlns:table="b" xmlns:office="o"><office:body><office:text><text:h text:outline-level="2">Head</text:h><text:p>a<text:s text:c="2"/>b</text:p><table:table><table:table-row><table:table-cell><text:p>x</text:p></table:table-cell></table:table-row></table:table></office:text></office:body></d>'}
OPF = """<package xmlns="http://www.idpf.org/2007/opf" version="3.0"><metadata xmlns:dc="http://purl.org/dc/elements/1.1/"><dc:title>Book</dc:title><dc:creator>Me</dc:creator><dc:publisher>Press</dc:publisher>
<dc:identifier>urn:isbn:978-1-4028-9462-6</dc:identifier><dc:identifier>urn:uuid:1234567890123</dc:identifier>{meta}</metadata><manifest><item id="nav" href="nav.xhtml" properties="nav"/><item id="a" href="html/ch1.xhtml"/><item id="b" href="html/index.xhtml"/></manifest>
<spine><itemref idref="a"/><itemref idref="b" linear="no"/><itemref idref="gone"/></spine></package>"""


def book(meta="", **more):
    return archive({
        "META-INF/container.xml": '<c:container xmlns:c="urn:oasis:names:tc:opendocument:xmlns:container"><c:rootfile full-path="OEBPS/p.opf"/></c:container>', "OEBPS/p.opf": OPF.format(meta=meta),
        "OEBPS/nav.xhtml": '<html xmlns:epub="e"><nav epub:type="toc"><ol><li>a<ol><li>b</li></ol></li></ol></nav><nav epub:type="page-list"><ol><li>1</li></ol></nav></html>',
        "OEBPS/html/ch1.xhtml": '<html><body><h1>One</h1><p>text</p><img src="x_Equ3_HTML.png" alt="$x$"/><div class="equation"><span><img src="y.png"/></span></div><span role="doc-pagebreak"/></body></html>',
        "OEBPS/html/index.xhtml": "<html><body><p>words</p></body></html>", **{k.replace("__", "/").replace("_DOT_", "."): v for k, v in more.items()},
    })


def test_html():
    got = formats.read_html("p.html", HTML.encode(), {})
    assert got.content == (
        "# Title\n\nSome **bold** and [link](u).\n\n- one\n- two\n  - deep\n\n1. first\n\n| a | b |\n|---|---|\n| 1 | x y |\n\n```\ncode  here\n```\n\n![pic](../assets/p/image_0.png)![](far.png)"
    )
    assert got.assets == [("image_0.png", b"\1\2\3")]
    assert "menu" in formats.read_html("p.html", HTML.encode(), {"strict_content": False}).content


def test_office_formats():
    d = formats.read_docx("w.docx", archive(DOCX), {})
    assert d.content == "Hello there\n\n\n![Image](../assets/w/i.png)\n\n\n\n\n\n| A | B |\n\n|---|---|\n\n| 1 |  |\n\n\n" and d.assets == [("i.png", b"png")]
    assert formats.read_xlsx("x.xlsx", archive(XLSX), {}).content == "## Sheet: S1\n\n| name |  | n |\n|---|---|---|\n| ann |  | 5 |\n\n---\n"
    assert formats.read_xlsx("x.xlsx", archive(XLSX), {"skip_empty_sheets": False}).content.count("## Sheet") == 2
    assert formats.read_pptx("p.pptx", archive(PPTX), {}).content == "<!-- Slide number: 1 -->\nfirst\n\n### Notes:\nsay this\n\n<!-- Slide number: 2 -->\nsecond"
    assert formats.read_odf("o.odt", archive(ODT), {}).content == "## Head\n\na  b\n\n| x |\n|---|"
    assert formats.read_text("t.csv", "a,b\n1,\"x\ny\"".encode(), {}).content == "| a | b |\n|---|---|\n| 1 | x y |"
    assert formats.read_image("d/i.png", b"x", {}).content == "![i](../assets/i/i.png)\n"


def test_zip_members_must_be_safe():
    assert formats.read_zip("z.zip", archive({"a/b.txt": "x"}), {}).content.endswith("Extracted 1 files to `z_unpacked`:\n- a/b.txt\n")
    for bad in ("../x", "/x", "a/../../x", "C:/x"):
        with pytest.raises(ValueError, match="unsafe"):
            formats.members(archive({bad: "x"}))


def test_epub():
    assert formats.read_epub("b.epub", book(), {}).content.startswith("# One\n\ntext")
    m = epub.audit(book())
    assert {k: m[k] for k in ("title", "origin", "drm", "layout", "spine_documents", "linear_documents_with_text", "documents_with_headings", "toc_entries", "toc_depth", "page_list_entries", "page_breaks", "equation_images", "tex_alt_images", "maths_mode", "latex_alt_coverage", "isbns", "back_matter")} == {
        "title": "Book", "origin": "publisher", "drm": False, "layout": "reflowable", "spine_documents": 2, "linear_documents_with_text": 1, "documents_with_headings": 1, "toc_entries": 2, "toc_depth": 2, "page_list_entries": 1,
        "page_breaks": 1, "equation_images": 2, "tex_alt_images": 1, "maths_mode": "latex_alt_text", "latex_alt_coverage": 0.5, "isbns": ["9781402894626"], "back_matter": ["OEBPS/html/index.xhtml"],
    }
    assert epub.audit(book('<meta name="calibre:series" content="x"/>'))["origin"] == "converted"
    assert epub.audit(book('<meta property="rendition:layout">pre-paginated</meta>'))["layout"] == "fixed"
    lock = '<e xmlns="http://www.w3.org/2001/04/xmlenc#"><EncryptedData><EncryptionMethod Algorithm="{}"/><CipherData><CipherReference URI="x"/></CipherData></EncryptedData></e>'
    assert not epub.audit(book(**{"META-INF__encryption_DOT_xml": lock.format(epub.FONT_OBFUSCATION[0])}))["drm"]
    assert epub.audit(book(**{"META-INF__encryption_DOT_xml": lock.format("aes")}))["drm"]
    assert epub.audit(book(**{"META-INF__rights_DOT_xml": "<r/>"}))["drm"]


def test_epub_facts_aggregate_to_the_same_measures(spark):
    lock = '<e xmlns="http://www.w3.org/2001/04/xmlenc#"><EncryptedData><EncryptionMethod Algorithm="aes"/><CipherData><CipherReference URI="x"/></CipherData></EncryptedData></e>'
    books = [("a", book()), ("b", book(**{"META-INF__encryption_DOT_xml": lock})), ("c", b"no zip")]
    facts = files.epub_facts(spark.createDataFrame(books, "path string, content binary"))
    assert facts.filter("path = 'c'").first().fact == "error"
    got = {r.path: r.asDict() for r in epub.measured(facts.filter("path <> 'c'"), "path").collect()}
    for path, data in books[:2]:
        want = epub.audit(data)
        assert {k: v for k, v in got[path].items() if k != "path"} == {k: want[k] for k in got[path] if k != "path"}


def test_single_files_go_to_mounted_folders_and_never_share_one(spark, tmp_path):
    kind = "path string, assets array<struct<name string, content binary>>"
    two = spark.createDataFrame([("x/a.html", [("i.png", b"1")]), ("y/a.docx", [("i.png", b"2")])], kind)
    with pytest.raises(ValueError, match="share"):
        files.write_assets(two, str(tmp_path))
    with pytest.raises(ValueError, match="mounted"):
        files.write_assets(two.limit(1), "s3a://bucket/x")


def test_files_are_found_routed_and_extracted(spark, tmp_path):
    (tmp_path / "sub").mkdir()
    for name, data in {"a.HTML": HTML.encode(), "sub/w.docx": archive(DOCX), "sub/bad.docx": b"no zip", "n.txt": "plain é".encode(), "skip.xyz": b"", "b.epub": book()}.items():
        (tmp_path / name).write_bytes(data)
    found = files.discover(spark, [str(tmp_path), str(tmp_path / "none"), str(tmp_path / "sub")])
    assert found.count() == 5
    docs = files.extract(found).cache()
    got = {r.source_file: r for r in docs.collect()}
    assert got["n.txt"].content == "plain é" and got["a.HTML"].content.startswith("# Title") and got["a.HTML"].reader == "html"
    assert got["bad.docx"].content == "" and "BadZipFile" in got["bad.docx"].error and got["bad.docx"].pipeline_phases == []
    assert {r.name for r in files.assets_of(docs).collect()} == {"image_0.png", "i.png"}
    files.write_assets(docs, str(tmp_path / "assets"))
    assert (tmp_path / "assets/a/image_0.png").read_bytes() == b"\1\2\3"
    assert files.only_titles(docs, "source_file", ["n.txt"]).count() == 1 and files.only_titles(docs, "source_file", []).count() == 5
    with pytest.raises(ValueError, match="nope"):
        files.only_titles(docs, "source_file", ["nope", "n.txt"])
    assert files.unfinished(found, docs.filter("error is null")).count() == 1
    m = {r.path.rsplit("/", 1)[1]: r for r in files.epub_metrics(found.filter("extension in ('epub', 'docx')")).collect()}
    assert json.loads(m["b.epub"].metrics)["title"] == "Book" and m["bad.docx"].error
    assert files.discover(spark, [str(tmp_path / "none")]).count() == 0


def test_routing_rules():
    assert files.route([files.Rule("a", "nope", "text"), files.Rule(".B", "html")]) == {"a": ("text", {}), "b": ("html", {})}
    for bad in ([files.Rule("a", "nope")], [files.Rule("a", "html"), files.Rule("a", "text")]):
        with pytest.raises(ValueError):
            files.route(bad)
    formats.register("upper", lambda n, d, p: formats.Extracted(d.decode().upper()))
    assert files.route([files.Rule("q", "upper")]) == {"q": ("upper", {})}


def test_front_matter(spark, tmp_path):
    rows = [(1, "---\ntitle: A\npage_number: 3\npipeline_phases: [extract, ocr]\n---\n\n body --- x "), (2, "no front"), (3, "---\n: [bad\n---\nx"), (4, None), (5, "---\n---\nonly"), (6, "--- broken")]
    d = spark.createDataFrame(rows, "k int, raw string").withColumn("_p", F.lit(0))
    got = {r.k: r for r in markdown.split_front_matter(d, "raw").collect()}
    assert got[1].metadata == {"title": "A", "page_number": "3", "pipeline_phases": '["extract", "ocr"]'} and got[1].pipeline_phases == ["extract", "ocr"] and got[1].content == "body --- x "
    assert [got[k].content for k in (2, 3, 4, 5, 6)] == ["no front", rows[2][1], None, "only", "--- broken"] and got[2].metadata == {} and got[1]._p == 0
    out = spark.createDataFrame([("a b", "text", {"k": 'q"x', "n": None})], "n string, c string, m map<string,string>")
    markdown.write_markdown(out, str(tmp_path), "n", "c", "m")
    assert (tmp_path / "a b.md").read_text() == '---\nk: "q\\"x"\nn: null\n---\n\ntext'
    back = markdown.read_markdown(spark, str(tmp_path)).first()
    assert (back.stem, back.content, back.metadata) == ("a b", "text", {"k": 'q"x', "n": None})


def test_stream_equals_batch_and_runs_once(spark, tmp_path):
    t = dt.datetime(2025, 1, 1)
    src = str(tmp_path / "in")
    rows = [("a", "x  \n\n\n\ny", ["extract"], t), ("b", "z ", ["extract", "clean"], t), ("c", None, None, t)]
    schema = "source_file string, content string, pipeline_phases array<string>, extracted_at timestamp"
    spark.createDataFrame(rows, schema).write.parquet(src)
    run = lambda: ingest.ingest(spark, src, spark.createDataFrame([], schema).schema, str(tmp_path / "out"), str(tmp_path / "cp")).awaitTermination()
    run()
    first = {r.source_file: (r.content, r.pipeline_phases) for r in ingest.current(spark, str(tmp_path / "out")).collect()}
    assert first == {"a": ("x\n\ny", ["extract", "clean"]), "b": ("z ", ["extract", "clean"]), "c": (None, ["clean"])}
    spark.createDataFrame([("a", "newer", ["extract"], t + dt.timedelta(1)), ("b", "older", [], t - dt.timedelta(1))], schema).write.mode("append").parquet(src)
    run()
    run()
    rows = ingest.current(spark, str(tmp_path / "out")).collect()
    assert {r.source_file: r.content for r in rows} == {"a": "newer", "b": "z ", "c": None}
    assert spark.read.parquet(str(tmp_path / "out")).count() == 5
    assert ingest.pending(spark.createDataFrame([("a", None), ("b", ["clean"])], "f string, pipeline_phases array<string>"), "clean").count() == 1
