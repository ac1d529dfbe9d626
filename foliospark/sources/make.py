"""Small files of each format from lines of text, so that readers can be tried by a round trip on any table."""

from __future__ import annotations

import csv
import io
import zipfile
import zlib
from collections.abc import Callable
from functools import lru_cache
from html import escape

PNG = b"\x89PNG\r\n\x1a\n"


def _zipped(items: dict[str, str | bytes]) -> bytes:
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        for name, content in items.items():
            z.writestr(zipfile.ZipInfo(name), content)
    return out.getvalue()


def html(lines: list[str]) -> bytes:
    """A page with noise around its text; a line that begins with number signs is a heading."""
    body = []
    for x in lines:
        level = len(x) - len(x.lstrip("#"))
        head = 0 < level <= 6 and x[level : level + 1] == " "
        body.append(f"<h{level}>{escape(x[level + 1 :])}</h{level}>" if head else f"<p>{escape(x)}</p>")
    return f"<html><head><title>t</title><script>var a = '<p>no</p>';</script></head><body><nav>menu</nav>{''.join(body)}<footer>end</footer></body></html>".encode()


def docx(lines: list[str]) -> bytes:
    body = "".join(f"<w:p><w:r><w:t>{escape(x)}</w:t></w:r></w:p>" for x in lines)
    return _zipped({"word/document.xml": f'<w:document xmlns:w="http://schemas.openxmlformats.org/wordprocessingml/2006/main"><w:body>{body}</w:body></w:document>'})


def xlsx(lines: list[str]) -> bytes:
    """A sheet with the number and the text of each line; texts are shared strings."""
    strings = "".join(f"<si><t>{escape(x)}</t></si>" for x in ["n", "text", *lines])
    rows = '<row><c r="A1" t="s"><v>0</v></c><c r="B1" t="s"><v>1</v></c></row>'
    rows += "".join(f'<row><c r="A{i + 2}"><v>{i + 1}</v></c><c r="B{i + 2}" t="s"><v>{i + 2}</v></c></row>' for i in range(len(lines)))
    return _zipped({
        "xl/workbook.xml": '<workbook xmlns:r="r"><sheets><sheet name="lines" r:id="a"/></sheets></workbook>', "xl/_rels/workbook.xml.rels": '<Relationships><Relationship Id="a" Target="worksheets/sheet1.xml"/></Relationships>',
        "xl/sharedStrings.xml": f"<sst>{strings}</sst>", "xl/worksheets/sheet1.xml": f"<worksheet><sheetData>{rows}</sheetData></worksheet>",
    })


def pptx(lines: list[str]) -> bytes:
    return _zipped({"ppt/slides/slide1.xml": "<s>" + "".join(f"<p><t>{escape(x)}</t></p>" for x in lines) + "</s>"})


def odt(lines: list[str]) -> bytes:
    body = "".join(f"<text:p>{escape(x)}</text:p>" for x in lines)
    return _zipped({"content.xml": f'<d xmlns:text="t" xmlns:office="o"><office:body><office:text><text:h text:outline-level="2">Head</text:h>{body}</office:text></office:body></d>'})


def epub(lines: list[str]) -> bytes:
    """A book of one chapter, with an entry in its contents for each line."""
    entries = "".join("<li>x</li>" for _ in lines)
    return _zipped({
        "META-INF/container.xml": '<c><rootfile full-path="O/p.opf"/></c>',
        "O/p.opf": '<package version="3.0"><metadata xmlns:dc="http://purl.org/dc/elements/1.1/"><dc:title>Book</dc:title><dc:publisher>Press</dc:publisher></metadata><manifest><item id="nav" href="nav.xhtml" properties="nav"/><item id="a" href="ch.xhtml"/></manifest><spine><itemref idref="a"/></spine></package>',
        "O/nav.xhtml": f'<html xmlns:epub="e"><nav epub:type="toc"><ol>{entries}</ol></nav></html>', "O/ch.xhtml": "<html><body>" + "".join(f"<p>{escape(x)}</p>" for x in lines) + "</body></html>",
    })


def text(lines: list[str]) -> bytes:
    return "\n".join(lines).encode()


def table(lines: list[str]) -> bytes:
    out = io.StringIO()
    csv.writer(out).writerows([["n", "text"], *([i + 1, x] for i, x in enumerate(lines))])
    return out.getvalue().encode()


def archive(lines: list[str]) -> bytes:
    return _zipped({"lines.txt": "\n".join(lines), "sub/more.txt": "more"})


def image(lines: list[str]) -> bytes:
    return PNG


@lru_cache(1)
def _coded(lines: tuple[str, ...]) -> tuple[bytes, list[str]]:
    """A map to Unicode of the characters of some lines, numbered in order, and each line's codes in hexadecimal digits."""
    code = {c: i + 1 for i, c in enumerate(sorted(set("".join(lines))))}
    cmap = "beginbfchar " + " ".join(f"<{n:04x}> <{c.encode('utf-16-be', 'surrogatepass').hex()}>" for c, n in code.items()) + " endbfchar"
    numbers = {ord(c): n for c, n in code.items()}
    return cmap.encode(), [x.translate(numbers).encode("utf-16-be", "surrogatepass").hex() for x in lines]


@lru_cache(16)  # files of the same lines have streams in common
def _deflated(raw: bytes) -> bytes:
    return zlib.compress(raw, 1)


def pdf(lines: list[str], pages: int = 1, fonts: tuple[str, ...] = ("Body",), covered: bool = False, label: str = "", outline: tuple[str, ...] = (), producer: str = "maker", packed: bool = True) -> bytes:
    """A PDF of pages of lines. Text goes through a font with a map to Unicode; ``covered`` pages have an image over
    all; ``packed`` ones keep their objects in an object stream."""
    cmap, shown = _coded(tuple(lines))
    per = -(-len(lines) // pages) if lines else 0
    objects: dict[int, str] = {}
    streams: dict[int, tuple[str, bytes]] = {}
    streams[4] = "", cmap
    streams[5] = "/Type /XObject /Subtype /Image /Width 1 /Height 1 ", b"\0"
    names = " ".join(f"/F{i} {10 + i} 0 R" for i in range(len(fonts)))
    for i, f in enumerate(fonts):
        objects[10 + i] = f"<< /Type /Font /Subtype /Type0 /BaseFont /{f} /Encoding /Identity-H /ToUnicode 4 0 R >>"
    first = 30
    for p in range(pages):
        here = shown[p * per : (p + 1) * per]
        drawn = "BT /F0 9 Tf 1 0 0 1 50 750 Tm 11 TL " + " ".join(f"<{x}> Tj T*" for x in here) + " ET"
        streams[first + 2 * p + 1] = "", (drawn + (" q 612 0 0 792 0 0 cm /I Do Q" if covered else "")).encode()
        objects[first + 2 * p] = f"<< /Type /Page /Parent 2 0 R /Contents {first + 2 * p + 1} 0 R >>"
    kids = " ".join(f"{first + 2 * p} 0 R" for p in range(pages))
    labels = f" /PageLabels << /Nums [0 << /P ({label}) >>] >>" if label else ""
    objects[1] = f"<< /Type /Catalog /Pages 2 0 R{labels}{' /Outlines 6 0 R' if outline else ''} >>"
    objects[2] = f"<< /Type /Pages /Kids [{kids}] /Count {pages} /MediaBox [0 0 612 792] /Resources << /Font << {names} >> /XObject << /I 5 0 R >> >> >>"
    objects[3] = f"<< /Producer ({producer}) /Title <feff{'Büch'.encode('utf-16-be').hex()}> >>"
    if outline:
        at = first + 2 * pages
        objects[6] = f"<< /First {at} 0 R >>"
        for i, t in enumerate(outline):
            objects[at + i] = f"<< /Title ({t})" + (f" /Next {at + i + 1} 0 R" if i + 1 < len(outline) else "") + " >>"
    if packed:
        inner, table_ = "", ""
        for n, o in objects.items():
            table_ += f"{n} {len(inner)} "
            inner += o + "\n"
        streams[7] = f"/Type /ObjStm /N {len(objects)} /First {len(table_)} ", (table_ + inner).encode("latin-1")
        objects = {}
    out = b"%PDF-1.5\n"
    for n, o in objects.items():
        out += f"{n} 0 obj\n{o}\nendobj\n".encode("latin-1")
    for n, (head, raw) in streams.items():
        body = _deflated(raw)
        out += f"{n} 0 obj\n<< {head}/Filter /FlateDecode /Length {len(body)} >>\nstream\n".encode() + body + b"\nendstream\nendobj\n"
    return out + b"trailer << /Root 1 0 R /Info 3 0 R >>\n%%EOF\n"


KINDS: dict[str, Callable[[list[str]], bytes]] = {"html": html, "docx": docx, "xlsx": xlsx, "pptx": pptx, "odt": odt, "epub": epub, "txt": text, "csv": table, "zip": archive, "png": image, "pdf": pdf}
