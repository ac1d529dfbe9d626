"""Readers of file formats: bytes in, Markdown out. They run inside executors and use the standard library only.

A reader takes (name, bytes, params) and returns an ``Extracted``; what it can't read it raises. ``register`` adds one.
"""

from __future__ import annotations

import base64
import csv
import io
import json
import posixpath
import re
import zipfile
from collections.abc import Callable
from dataclasses import dataclass, field
from html.parser import HTMLParser
from xml.etree import ElementTree as ET

MOST_MEMBER_BYTES, MOST_TOTAL_BYTES = 256 << 20, 1 << 30


@dataclass
class Extracted:
    content: str
    metadata: dict[str, str] = field(default_factory=dict)
    assets: list[tuple[str, bytes]] = field(default_factory=list)


Reader = Callable[[str, bytes, dict], Extracted]
READERS: dict[str, Reader] = {}


def register(name: str, reader: Reader) -> None:
    READERS[name] = reader


def reader(name: str):
    def add(f: Reader) -> Reader:
        register(name, f)
        return f

    return add


def stem(name: str) -> str:
    base = posixpath.basename(name)
    return base.rsplit(".", 1)[0] if "." in base[1:] else base


def members(data: bytes) -> dict[str, bytes]:
    """A zip's files by name. Absolute names, names with ``..`` and oversized members raise."""
    out, total = {}, 0
    with zipfile.ZipFile(io.BytesIO(data)) as z:
        for i in z.infolist():
            if i.is_dir():
                continue
            if i.filename.startswith(("/", "\\")) or ".." in re.split(r"[/\\]", i.filename) or re.match(r"^[A-Za-z]:", i.filename):
                raise ValueError(f"unsafe member name: {i.filename!r}")
            total += i.file_size
            if i.file_size > MOST_MEMBER_BYTES or total > MOST_TOTAL_BYTES:
                raise ValueError(f"member too large: {i.filename!r}")
            out[i.filename] = z.read(i)
    return out


def _tag(e: ET.Element) -> str:
    return e.tag.rsplit("}", 1)[-1] if isinstance(e.tag, str) else ""


def _attr(e: ET.Element, name: str) -> str | None:
    return next((v for k, v in e.attrib.items() if k.rsplit("}", 1)[-1] == name), None)


def pipe_table(rows: list[list[str]]) -> list[str]:
    """A Markdown table; the first row is its head. Line ends within cells become blanks."""
    if not rows:
        return []
    width = max(map(len, rows))
    line = lambda r: "| " + " | ".join(x.replace("\n", " ").strip() for x in [*r, *[""] * (width - len(r))]) + " |"
    return [line(rows[0]), "|" + "|".join(["---"] * width) + "|", *map(line, rows[1:])]


class _Markdown(HTMLParser):
    """HTML events to Markdown: ATX headings, ``-`` bullets, pipe tables; noise subtrees are skipped."""

    # Tags whose content is no text of the page.
    NOISE = {"nav", "footer", "aside", "script", "style", "noscript", "iframe", "header"}
    ALWAYS = {"script", "style", "head", "title", "template"}
    VOID = {"br", "hr", "img", "input", "meta", "link", "col", "area", "base", "embed", "source", "track", "wbr"}
    BLOCK = {"p", "div", "section", "article", "main", "figure", "figcaption", "blockquote", "ul", "ol", "table", "pre", "dl", "dt", "dd", "address", "form", "body", "html"}

    def __init__(self, strict: bool, image: Callable[[str], str | None]):
        super().__init__(convert_charrefs=True)
        self.drop = self.ALWAYS | (self.NOISE if strict else set())
        self.image = image
        self.out: list[str] = []
        self.skip: list[str] = []
        self.lists: list[list] = []
        self.links: list[str] = []
        self.pre = 0
        self.rows: list[list[list[str]]] = []
        self.cell: list[int] = []
        self.images = 0

    def put(self, s: str) -> None:
        self.out.append(s)

    def block(self) -> None:
        self.put(" " if self.cell else "\n\n")

    def handle_starttag(self, tag, attrs):
        a = dict(attrs)
        if self.skip:
            if tag not in self.VOID:
                self.skip.append(tag)
            return
        if tag in self.drop:
            self.skip.append(tag)
        elif re.fullmatch("h[1-6]", tag):
            self.block()
            self.put("#" * int(tag[1]) + " ")
        elif tag in ("strong", "b"):
            self.put("**")
        elif tag in ("em", "i"):
            self.put("*")
        elif tag == "code" and not self.pre:
            self.put("`")
        elif tag == "pre":
            self.block()
            self.put("```\n")
            self.pre += 1
        elif tag == "br":
            self.put(" " if self.cell else "  \n")
        elif tag == "hr":
            self.put("\n\n---\n\n")
        elif tag == "a":
            self.links.append(a.get("href") or "")
            if self.links[-1]:
                self.put("[")
        elif tag == "img":
            src = a.get("src")
            to = self.image(src) if src else None
            self.put(f"![{a.get('alt') or ''}]({to or src or ''})")
        elif tag in ("ul", "ol"):
            if not self.lists:
                self.block()
            self.lists.append([tag, 0])
        elif tag == "li":
            if self.lists:
                self.lists[-1][1] += 1
            mark = f"{self.lists[-1][1]}. " if self.lists and self.lists[-1][0] == "ol" else "- "
            self.put("\n" + "  " * max(len(self.lists) - 1, 0) + mark)
        elif tag == "table":
            self.block()
            self.rows.append([])
        elif tag == "tr" and self.rows:
            self.rows[-1].append([])
        elif tag in ("td", "th") and self.rows:
            if not self.rows[-1]:
                self.rows[-1].append([])
            self.cell.append(len(self.out))
        elif tag in self.BLOCK and not (self.lists and tag in ("p", "div")):
            self.block()

    def handle_endtag(self, tag):
        if self.skip:
            if tag in self.skip:
                while self.skip.pop() != tag:
                    pass
            return
        if re.fullmatch("h[1-6]", tag):
            self.block()
        elif tag in ("strong", "b"):
            self.put("**")
        elif tag in ("em", "i"):
            self.put("*")
        elif tag == "code" and not self.pre:
            self.put("`")
        elif tag == "pre" and self.pre:
            self.pre -= 1
            self.put("\n```\n\n")
        elif tag == "a" and self.links:
            href = self.links.pop()
            if href:
                self.put(f"]({href})")
        elif tag in ("ul", "ol") and self.lists:
            self.lists.pop()
            if not self.lists:
                self.block()
        elif tag in ("td", "th") and self.cell:
            at = self.cell.pop()
            text = " ".join("".join(self.out[at:]).split())
            del self.out[at:]
            self.rows[-1][-1].append(text)
        elif tag == "table" and self.rows:
            rows = [r for r in self.rows.pop() if r]
            self.put("\n".join(pipe_table(rows)))
            self.block()
        elif tag in self.BLOCK and not (self.lists and tag in ("p", "div")):
            self.block()

    def handle_data(self, data):
        if self.skip or (self.rows and not self.cell and not data.strip()):
            return
        self.put(data if self.pre else re.sub(r"\s+", " ", data))

    def text(self) -> str:
        s = "".join(self.out)
        fenced = re.split(r"(```\n.*?\n```)", s, flags=re.S)
        for i in range(0, len(fenced), 2):
            fenced[i] = re.sub(r"[ \t]+\n(?!\n?  )", "\n", re.sub(r"\n[ \t]+(?=[^\s\-\d])", "\n", fenced[i]))
        return re.sub(r"\n{3,}", "\n\n", "".join(fenced)).strip()


def html_to_markdown(html: str, strict: bool = True, image: Callable[[str], str | None] = lambda src: None) -> str:
    p = _Markdown(strict, image)
    p.feed(html)
    p.close()
    return p.text()


@reader("html")
def read_html(name: str, data: bytes, params: dict) -> Extracted:
    """HTML without navigation and the like unless ``strict_content`` is off. Images in data URIs become assets; no
    image is fetched, so other links stay as they are."""
    assets: list[tuple[str, bytes]] = []

    def image(src: str) -> str | None:
        if not src.startswith("data:image") or "," not in src:
            return None
        try:
            raw = base64.b64decode(src.split(",", 1)[1], validate=False)
        except ValueError:
            return None
        assets.append((f"image_{len(assets)}.png", raw))
        return f"../assets/{stem(name)}/{assets[-1][0]}"

    text = html_to_markdown(data.decode("utf-8"), params.get("strict_content", True), image)
    return Extracted(text, {"images_extracted": str(len(assets))}, assets)


@reader("docx")
def read_docx(name: str, data: bytes, params: dict) -> Extracted:
    """Paragraphs, drawings and tables in body order; media become assets."""
    files = members(data)
    media = {posixpath.basename(n): b for n, b in files.items() if n.startswith("word/media/")}
    rels = {}
    if "word/_rels/document.xml.rels" in files:
        for r in ET.fromstring(files["word/_rels/document.xml.rels"]):
            if "image" in (r.get("Type") or ""):
                rels[r.get("Id")] = posixpath.basename(r.get("Target") or "")
    run_text = lambda e: "".join("\t" if _tag(x) == "tab" else "\n" if _tag(x) in ("br", "cr") else x.text or "" for x in e.iter() if _tag(x) in ("t", "tab", "br", "cr"))
    cell_text = lambda c: "\n".join(run_text(p) for p in c if _tag(p) == "p")
    out = []
    body = next(e for e in ET.fromstring(files["word/document.xml"]) if _tag(e) == "body")
    for e in body:
        if _tag(e) == "p":
            if text := run_text(e).strip():
                out.append(text)
            for x in e.iter():
                file = rels.get(_attr(x, "embed") or "") if _tag(x) == "blip" else rels.get(_attr(x, "id") or "") if _tag(x) == "imagedata" else None
                if file in media:
                    out.append(f"\n![Image](../assets/{stem(name)}/{file})\n")
        elif _tag(e) == "tbl":
            out += ["\n", *pipe_table([[cell_text(c) for c in r if _tag(c) == "tc"] for r in e if _tag(r) == "tr"]), "\n"]
    return Extracted("\n\n".join(out), {"images_extracted": str(len(media))}, sorted(media.items()))


def _column(ref: str) -> int:
    n = 0
    for c in re.match(r"[A-Z]*", ref)[0]:
        n = n * 26 + ord(c) - 64
    return n - 1


@reader("xlsx")
def read_xlsx(name: str, data: bytes, params: dict) -> Extracted:
    """Each sheet as a table under its name; sheets without rows below their head are left out unless
    ``skip_empty_sheets`` is off."""
    files = members(data)
    shared = []
    if "xl/sharedStrings.xml" in files:
        shared = ["".join(t.text or "" for t in si.iter() if _tag(t) == "t") for si in ET.fromstring(files["xl/sharedStrings.xml"])]
    targets = {r.get("Id"): r.get("Target") for r in ET.fromstring(files["xl/_rels/workbook.xml.rels"])}
    out, kept = [], 0
    for sheet in (e for e in ET.fromstring(files["xl/workbook.xml"]).iter() if _tag(e) == "sheet"):
        target = targets[_attr(sheet, "id")]
        path = target.lstrip("/") if target.startswith("/") else posixpath.normpath(f"xl/{target}")
        rows = []
        for r in (e for e in ET.fromstring(files[path]).iter() if _tag(e) == "row"):
            cells: dict[int, str] = {}
            for i, c in enumerate(x for x in r if _tag(x) == "c"):
                value = next((v.text or "" for v in c if _tag(v) == "v"), "")
                if c.get("t") == "s":
                    value = shared[int(value)]
                elif c.get("t") == "inlineStr":
                    value = "".join(t.text or "" for t in c.iter() if _tag(t) == "t")
                elif c.get("t") == "b":
                    value = "TRUE" if value == "1" else "FALSE"
                cells[_column(c.get("r") or "") if c.get("r") else i] = value
            rows.append([cells.get(i, "") for i in range(max(cells, default=-1) + 1)])
        rows = [r for r in rows if any(r)]
        if len(rows) < 2 and params.get("skip_empty_sheets", True):
            continue
        kept += 1
        out += [f"## Sheet: {sheet.get('name')}\n", "\n".join(pipe_table(rows)), "\n---\n"]
    return Extracted("\n".join(out), {"sheets": str(kept)})


@reader("pptx")
def read_pptx(name: str, data: bytes, params: dict) -> Extracted:
    """The text of each slide under a heading, and its notes."""
    files = members(data)
    number = lambda n: int(re.search(r"(\d+)\.xml$", n)[1])
    slides = sorted((n for n in files if re.fullmatch(r"ppt/slides/slide\d+\.xml", n)), key=number)

    def paragraphs(xml: bytes) -> list[str]:
        return [t for p in ET.fromstring(xml).iter() if _tag(p) == "p" if (t := "".join(x.text or "" for x in p.iter() if _tag(x) == "t").strip())]

    out = []
    for i, s in enumerate(slides, 1):
        out.append("\n".join([f"<!-- Slide number: {i} -->", *paragraphs(files[s])]))
        rel = f"ppt/slides/_rels/{posixpath.basename(s)}.rels"
        for r in ET.fromstring(files[rel]) if rel in files else ():
            target = posixpath.normpath(posixpath.join("ppt/slides", r.get("Target") or ""))
            if "notesSlide" in (r.get("Type") or "") and target in files and (notes := [p for p in paragraphs(files[target]) if not p.isdigit()]):
                out.append("### Notes:\n" + "\n".join(notes))
    return Extracted("\n\n".join(out), {"slides": str(len(slides))})


@reader("odf")
def read_odf(name: str, data: bytes, params: dict) -> Extracted:
    """Headings, paragraphs and tables of an OpenDocument text, sheet or presentation."""
    root = ET.fromstring(members(data)["content.xml"])
    out: list[str] = []

    def text(e: ET.Element) -> str:
        s = e.text or ""
        for x in e:
            s += " " * int(_attr(x, "c") or 1) if _tag(x) == "s" else "\t" if _tag(x) == "tab" else "\n" if _tag(x) == "line-break" else text(x)
            s += x.tail or ""
        return s

    def walk(e: ET.Element) -> None:
        kind = _tag(e)
        if kind in ("h", "p"):
            if t := text(e).strip():
                out.append(("#" * int(_attr(e, "outline-level") or 1) + " " if kind == "h" else "") + t)
        elif kind == "table":
            rows = [[" ".join(text(p) for p in c if _tag(p) == "p") for c in r if _tag(c) == "table-cell"] for r in e.iter() if _tag(r) == "table-row"]
            rows = [r for r in rows if any(r)]
            out.append("\n".join(pipe_table(rows)))
        else:
            for x in e:
                walk(x)

    walk(next(e for e in root.iter() if _tag(e) == "body"))
    return Extracted("\n\n".join(out))


@reader("epub")
def read_epub(name: str, data: bytes, params: dict) -> Extracted:
    """The spine's documents in order, as Markdown."""
    from .epub import Package

    book = Package(data)
    parts = [html_to_markdown(book.files[d.href].decode("utf-8", "replace"), False) for d in book.spine if d.linear]
    titles, creators = ([text for tag, text in book.described if tag == wanted] for wanted in ("title", "creator"))
    meta = {k: v for k, v in (("title", titles[0] if titles else None), ("creator", "; ".join(creators))) if v}
    return Extracted("\n\n".join(p for p in parts if p), meta)


@reader("image")
def read_image(name: str, data: bytes, params: dict) -> Extracted:
    """A link to the image, which becomes an asset."""
    base = posixpath.basename(name)
    return Extracted(f"![{stem(name)}](../assets/{stem(name)}/{base})\n", {}, [(base, data)])


@reader("zip")
def read_zip(name: str, data: bytes, params: dict) -> Extracted:
    """A listing; the members become assets. They are not routed again."""
    files = members(data) if name.lower().endswith(".zip") else {}
    target = f"{stem(name)}_unpacked"
    lines = "".join(f"- {n}\n" for n in files)
    return Extracted(f"# Archive Extracted\n\nExtracted {len(files)} files to `{target}`:\n{lines}", {"files_unpacked": str(len(files)), "unpacked_dir": target}, list(files.items()))


@reader("text")
def read_text(name: str, data: bytes, params: dict) -> Extracted:
    """Plain text, Markdown, CSV (as a table) and JSON (fenced)."""
    text = data.decode("utf-8-sig")
    kind = name.rsplit(".", 1)[-1].lower()
    if kind in ("csv", "tsv"):
        rows = [r for r in csv.reader(io.StringIO(text), delimiter="\t" if kind == "tsv" else ",") if r]
        return Extracted("\n".join(pipe_table(rows)))
    if kind == "json":
        return Extracted(f"```json\n{json.dumps(json.loads(text), indent=2, ensure_ascii=False)}\n```")
    return Extracted(text)
