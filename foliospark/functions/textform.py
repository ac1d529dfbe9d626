"""The consistent form of a text: a look-alike skeleton.

The text is decomposed (NFD), each character is replaced by its prototype, and the result is decomposed again and, for
output, composed (NFC). Prototypes come from the Unicode look-alike data inside the ICU library that Spark ships;
they are read once on the driver in two calls and sent along with the function.

Characters of one prototype and one kind (capital, small letter, caseless letter, digit, other sign) are one class. Its
representative is its ASCII character, else that of the most usual script, and replaces all others. So what a reader can
tell apart stays apart: ASCII characters (ICU folds ``I``, ``l``, ``1`` and ``|`` into one), letter case, letters and
digits, raised and lowered characters, and combining marks, which never change. A caseless letter counts as the capital or
small ASCII letter that it looks like.
"""

from __future__ import annotations

import re
import unicodedata as ud
from collections import defaultdict

from pyspark.sql import SparkSession

# Characters that leave no ink.
INVISIBLE = "\u00ad\u180e\u200b\u200c\u200d\u200e\u200f\u2060\u2061\u2062\u2063\u2064\ufeff"
# Hyphens drawn as the ASCII one.
HYPHENS = "‐‑﹣－"
# The small Greek letters that a reader does take for what ICU says; all others are themselves.
GREEK_ALIKE = "νορ"
# Dashes and quotation marks, which differ from the ASCII ones in length or shape.
SHAPED = "‒–—―‘’‛“”„‟′″‴‵‶‷‹›«»´¨¸"
CLICK = "ǃ"  # the one letter that looks like a punctuation mark
LATIN_LIGATURES = range(0xFB00, 0xFB07)
GREEK_SMALL = range(0x3B1, 0x3CA)
USUAL = (range(0x180), range(0x400, 0x460), range(0x370, 0x400))  # scripts that a representative is taken from first
LAST = 0x20000

_tables: dict[int, dict[int, str]] = {}


def _prototypes(spark: SparkSession, texts: list[str]) -> list[str]:
    checker = spark._jvm.com.ibm.icu.text.SpoofChecker.Builder().build()
    return checker.getSkeleton("\n".join(texts)).split("\n")


def _kind(c: str, proto: str) -> str:
    kind = ud.category(c)
    if kind in ("Lo", "Lt", "Nl"):
        return "P" if c == CLICK else ud.category(proto) if len(proto) == 1 and proto.isascii() and proto.isalpha() else "Lo"
    return kind if kind in ("Lu", "Ll", "Nd") else "P"


def _rank(c: str) -> tuple[int, int]:
    return next((i for i, r in enumerate(USUAL) if ord(c) in r), len(USUAL)), ord(c)


def _base_table(spark: SparkSession) -> dict[int, str]:
    """What one decomposed character is replaced by."""
    chars = [chr(o) for o in range(0x21, LAST) if ud.category(chr(o)) not in ("Cn", "Cs", "Co", "Cc")]
    plain = [ud.normalize("NFKC", c) for c in chars]
    out: dict[int, str] = {}
    classes: dict[tuple[str, str], list[str]] = defaultdict(list)
    alike: dict[str, tuple[str, str]] = {}
    for c, compat, proto, same in zip(chars, plain, _prototypes(spark, chars), _prototypes(spark, plain)):
        kind, how = ud.category(c), ud.decomposition(c)
        if c.isascii():
            classes[proto, _kind(c, proto)].append(c)
        elif c in INVISIBLE or not proto:
            out[ord(c)] = ""
        elif c in HYPHENS:
            out[ord(c)] = "-"
        elif kind == "Zs":
            out[ord(c)] = " "
        elif how.startswith(("<wide>", "<narrow>")) or ord(c) in LATIN_LIGATURES:
            out[ord(c)] = compat
        elif kind in ("Mn", "Mc", "Me", "Lm") or how.startswith(("<super>", "<sub>")) or c in SHAPED or (how and how[0] != "<"):
            continue  # marks and what is raised stay; what has a canonical decomposition is replaced part by part
        elif ord(c) in GREEK_SMALL and c not in GREEK_ALIKE:
            continue
        elif how and same == proto and compat != c:
            out[ord(c)] = compat  # drawn as its plain characters
        elif len(proto) == 1 or not proto.isascii():
            alike[c] = proto, _kind(c, proto)
            classes[alike[c]].append(c)
    for c, key in alike.items():
        members = classes[key]
        ascii_ = [m for m in members if m.isascii()]
        first = next((m for m in ascii_ if m == key[0]), ascii_[0]) if ascii_ else min(members, key=_rank)
        if first != c:
            out[ord(c)] = first
    # What was made plain may have a representative in turn.
    return {o: ud.normalize("NFD", new).translate(out) if new else new for o, new in out.items()}


def form_table(spark: SparkSession) -> dict[int, str]:
    """What each composed character is replaced by; characters that stay are left out."""
    key = id(spark._jvm)
    if key not in _tables:
        base, out = _base_table(spark), {}
        for o in range(0x80, LAST):
            c = chr(o)
            new = ud.normalize("NFC", ud.normalize("NFD", ud.normalize("NFD", c).translate(base)))
            if new != c and (o in base or any(ord(x) in base for x in ud.normalize("NFD", c))):
                out[o] = new
        _tables[key] = out
    return _tables[key]


def _charset(points: list[int]) -> str:
    runs: list[list[int]] = []
    for p in sorted(points):
        if runs and runs[-1][1] == p - 1:
            runs[-1][1] = p
        else:
            runs.append([p, p])
    return "".join(f"\\U{a:08x}-\\U{b:08x}" for a, b in runs)


class TextForm:
    """Maps a text to its consistent form; null stays null. Line ends become ``\\n``, blanks at line ends go, and a
    soft hyphen at a line end, where it is drawn, becomes a hyphen."""

    def __init__(self, table: dict[int, str]):
        self.table = table
        self._touch: tuple | None = None

    def __getstate__(self):
        return {"table": self.table, "_touch": None}

    def _touches(self, text: str) -> bool:
        """Whether any character is replaced. The planes are searched one by one: only a class within the basic
        plane is compiled to a bitmap."""
        if self._touch is None:
            basic = [p for p in self.table if p < 0x10000]
            self._touch = (re.compile(f"[{_charset(basic)}]"), re.compile("[\U00010000-\U0010ffff]"))
        return bool(self._touch[0].search(text) or self._touch[1].search(text))

    def __call__(self, text: str | None) -> str | None:
        if text is None:
            return None
        if not text.isascii():
            if not ud.is_normalized("NFC", text):
                text = ud.normalize("NFC", text)
            if self._touches(text):
                if "­" in text:
                    text = re.sub("­(?=[\r\n]|\\Z)", "-", text)
                text = ud.normalize("NFC", text.translate(self.table))
        if "\r" in text:
            text = text.replace("\r\n", "\n").replace("\r", "\n")
        if " \n" in text or "\t\n" in text or text[-1:] in (" ", "\t"):
            text = re.sub(r"[ \t]+(?=\n|\Z)", "", text)
        return text


def text_form(spark: SparkSession) -> TextForm:
    return TextForm(form_table(spark))
