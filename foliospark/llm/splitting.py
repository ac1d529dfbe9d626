"""Problem 8: cutting long texts into pieces at natural boundaries, with overlap.

A text's structure is a tree: sections by heading level (Markdown, underlined or HTML headings), blocks (paragraphs, tables,
fenced code), list items by their nesting, rows and lines, sentences. It is kept as the places where one node ends and the
next begins, each with the depth of the node that begins there. A node that fits is a piece; of one that doesn't, those
children that fit are merged with the siblings beside them while they fit, and only oversized children are descended into. So
a piece is always whole siblings, and what is left over of a node isn't joined to the next one. A sentence larger than a
piece is cut between words, and a word larger than a piece between tokens.

All of it works on one tokenisation of the whole text. Ends of words and of lines are ends of pre-tokens, so pieces cut
there have the same tokens on their own; where a piece begins or ends elsewhere, its first or last word is counted
again, and ``tokens`` is always what the piece's own text has.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .tokens import TOKENIZER, Tokenizer, tokenizer

BLOCK, ITEM, LINE, SENTENCE = 7, 8, 15, 16  # depths below the six levels of headings
NESTED = LINE - ITEM - 1  # levels of items within items; what is nested deeper counts as the deepest
LINES = re.compile(rb"\n[ \t\r\n]*")
HEADING = re.compile(rb"(#{1,6})[ \t\xc2]")
HTML_HEADING = re.compile(rb"<h([1-6])[ \t>]", re.I)
UNDERLINED = re.compile(rb"[^\n|#<>\-*+=][^\n|]*\n(=+|-{2,})[ \t\r]*(?:\n|\Z)")
UNDERLINE = re.compile(rb"(?:=+|-{2,})[ \t\r]*(?:\n|\Z)")
LIST_ITEM = re.compile(rb"[ \t]*(?:[-*+]|\d{1,3}[.)])[ \t]")
SENTENCE_END = re.compile(rb"[.!?]+(?:[\"')\]]|\xe2\x80[\x9c\x9d\x99]|\xc2\xbb)*(?=[ \t\n])")
PAGE_BREAK = b"\x0c"
# White space outside ASCII, in UTF-8.
WIDE_SPACE = re.compile(rb"\xc2[\x85\xa0]|\xe1\x9a\x80|\xe2\x80[\x80-\x8a\xa8\xa9\xaf]|\xe2\x81\x9f|\xe3\x80\x80")
MARGIN = 4  # tokens kept free for counting a piece's first and last word again


def _heading(raw: bytes, p: int) -> int:
    """The level of the heading that begins at a place, or 0."""
    if m := HEADING.match(raw, p):
        return len(m[1])
    if m := HTML_HEADING.match(raw, p):
        return int(m[1])
    m = UNDERLINED.match(raw, p)
    return 0 if m is None else 1 if m[1][:1] == b"=" else 2


def boundaries(raw: bytes) -> tuple[list[int], list[int]]:
    """Where nodes begin, as byte offsets, and their depths."""
    at: dict[int, int] = {}
    fenced = raw.startswith(b"```")
    before = b""
    titled = not fenced and _heading(raw, 0) > 0
    listed = LIST_ITEM.match(raw) is not None
    start = 0
    for m in LINES.finditer(raw):
        line, gap, p = raw[start : m.start()], m.group(), m.end()
        start = p
        nxt = raw[p : p + 12]
        if line.startswith(b"```") and before != b"":
            fenced = not fenced
        before = line or b" "
        blank = gap.count(b"\n") > 1
        indent = gap[gap.rindex(b"\n") + 1 :]
        width = len(indent.expandtabs(4))
        # What is indented by a tab or four blanks is code or within an item, never a heading.
        level = _heading(raw, p) if width < 4 and not fenced else 0
        after_title = titled
        item = not fenced and not level and LIST_ITEM.match(nxt) is not None
        titled = level > 0 or (titled and not blank and UNDERLINE.match(raw, p) is not None)
        if fenced:
            at[p] = LINE
        elif level:
            at[p] = level
        elif after_title:
            at[p] = SENTENCE  # a heading stays with what follows it for as long as anything else can be cut
        elif nxt.startswith(b"```") or PAGE_BREAK in nxt[:1]:
            at[p] = BLOCK
        elif item:
            at[p] = ITEM + min(width // 2, NESTED) if listed or not blank else BLOCK
        elif blank:
            at[p] = ITEM + NESTED if listed and width > 1 else BLOCK
        elif nxt.startswith(b"|"):
            at[p] = ITEM
        else:
            at[p] = LINE
        listed = item or (listed and not level and (width > 1 or not blank))
    for m in SENTENCE_END.finditer(raw):
        at.setdefault(m.end(), SENTENCE)
    at.pop(0, None)
    at.pop(len(raw), None)
    places = sorted(at)
    return places, [at[p] for p in places]


class Splitter:
    """Cuts one text after another; see ``split``."""

    def __init__(self, tok: Tokenizer):
        self.tok = tok
        self.again: dict[bytes, int] = {}

    def _own(self, raw: bytes) -> int:
        n = self.again.get(raw)
        if n is None:
            if len(self.again) > 200_000:
                self.again.clear()
            n = self.again[raw] = self.tok.count(raw.decode("utf-8"))
        return n

    def prepare(self, text: str):
        raw = text.encode("utf-8", "surrogatepass").decode("utf-8", "replace").encode()
        ends = np.concatenate([[0], self.tok.ends(raw.decode())])
        bytes_ = np.frombuffer(raw + b" ", np.uint8)
        starts_char = (bytes_ & 0xC0) != 0x80
        space = (bytes_ == 32) | ((bytes_ >= 9) & (bytes_ <= 13))
        for m in WIDE_SPACE.finditer(raw):
            space[m.start() : m.end()] = True
        ok = starts_char[ends]
        # A place is safe if no pre-token spans it: a blank after ink, or ink after a line end. The former also stays
        # safe when what follows is cut off.
        inner = ends[1:-1]
        closed, safe = np.ones(len(ends), bool), np.ones(len(ends), bool)
        closed[1:-1] = ~space[inner - 1] & space[inner]
        safe[1:-1] = closed[1:-1] | ((bytes_[inner - 1] == 10) & ~space[inner])
        blank_end = np.zeros(len(ends), bool)
        blank_end[1:] = space[ends[1:] - 1]
        places, depth = boundaries(raw)
        # A token may join the last blank of an indentation to what follows, so a line begins at the first token end
        # from its line feed on, its first ink at the latest.
        first = [raw.rindex(b"\n", 0, p) + 1 if raw[p - 1] in b" \t\r" else p for p in places]
        t = np.searchsorted(ends, np.array(first, np.int64))
        exact = ends[t] <= np.array(places, np.int64)
        t, depth = t[exact], np.array(depth, np.int64)[exact]
        return raw, ends, ok, (safe, closed, blank_end), np.concatenate([[0], t, [len(ends) - 1]]), np.concatenate([[0], depth, [0]])

    def _long(self, s: int, e: int, most: int, ok: np.ndarray, safe: np.ndarray) -> list[int]:
        """Cuts inside a node without inner places: between words, else between characters that tokens end at."""
        cuts = []
        good, fair = np.flatnonzero(safe[s : e + 1]) + s, np.flatnonzero(ok[s : e + 1]) + s
        while e - s > most:
            for choice in (good, fair):
                i = np.searchsorted(choice, s + most, side="right") - 1
                if i >= 0 and choice[i] > s:
                    s = int(choice[i])
                    break
            else:  # one character of more tokens than a piece may have
                s = int(fair[np.searchsorted(fair, s, side="right")])
            cuts.append(s)
        return cuts

    def _pack(self, lo: int, hi: int, t: np.ndarray, depth: np.ndarray, most: int, ok: np.ndarray, safe: np.ndarray) -> list[int]:
        """Token places at which the pieces of the node between two places end."""
        s, e = int(t[lo]), int(t[hi])
        if e - s <= most:
            return [e]
        if hi - lo == 1:
            return [*self._long(s, e, most, ok, safe), e]
        inner = depth[lo + 1 : hi]
        children = [lo, *(np.flatnonzero(inner == inner.min()) + lo + 1).tolist(), hi]
        out: list[int] = []
        begin = None  # of the piece that the next child may join
        for a, b in zip(children, children[1:]):
            x, y = int(t[a]), int(t[b])
            if y == x:
                continue
            if y - x > most:
                out += self._pack(a, b, t, depth, most, ok, safe)
                begin = None
            elif begin is not None and y - begin <= most:
                out[-1] = y
            else:
                begin = x
                out.append(y)
        return out

    def split(self, prepared, limit: int, overlap: int) -> list[tuple[int, int, int, int]]:
        """(first byte, end byte, tokens, overlap) of each piece."""
        raw, ends, ok, kinds, t, depth = prepared
        if len(ends) - 1 <= limit:
            return []
        if limit - overlap < 1:
            raise ValueError(f"no room for a piece: limit {limit}, overlap {overlap}")
        margin = MARGIN
        while True:
            most = max(limit - overlap - margin, 1)
            out, s = [], 0
            for e in self._pack(0, len(t) - 1, t, depth, most, ok, kinds[0]):
                begin = max(0, s - overlap) if s else 0
                while not ok[begin]:
                    begin -= 1
                n = e - begin + self._change(raw, ends, kinds, begin, e)
                out.append((int(ends[begin]), int(ends[e]), int(n), s - begin))
                s = e
            if most == 1 or all(n <= limit for _, _, n, _ in out):
                return out
            margin *= 2

    def _change(self, raw: bytes, ends: np.ndarray, kinds: tuple[np.ndarray, ...], begin: int, e: int) -> int:
        """By how many tokens the piece on its own differs from its tokens in the text: its first word is counted again
        if it begins inside a pre-token, its last if it ends inside one or with blanks."""
        safe, closed, blank_end = kinds
        a = b = None
        if not safe[begin]:
            inside = closed[begin + 1 : e]
            a = begin + 1 + int(inside.argmax()) if inside.any() else e
        if not safe[e] or blank_end[e]:
            inside = closed[begin + 1 : e][::-1]
            b = e - 1 - int(inside.argmax()) if inside.any() else begin
        whole = lambda x, y: self._own(raw[ends[x] : ends[y]]) - (y - x)
        if a == e or b == begin or (a is not None and b is not None and a > b):
            return whole(begin, e)
        return (whole(begin, a) if a is not None else 0) + (whole(b, e) if b is not None else 0)


def split_texts(df: DataFrame, key: str, text: str, limits: list[tuple[int, int]], path: str = TOKENIZER) -> DataFrame:
    """(key, max_tokens, piece, first_byte, end_byte, tokens, overlap_tokens, text) of the pieces of every text that
    exceeds a limit, for each (max_tokens, overlap_tokens) of ``limits``.

    Pieces are numbered from 0, follow one another without a gap, and each but the first begins with the last
    ``overlap_tokens`` tokens of the one before, or up to three more where a token ends inside a character. ``tokens``
    counts the piece's own text and is within the limit. Texts within a limit, empty ones and nulls have no pieces.
    Bytes are those of the text in UTF-8. It is one pass without a shuffle.
    """

    def run(batches):
        splitter = Splitter(tokenizer(path))
        least = min(m for m, _ in limits)
        for b in batches:
            rows = [[] for _ in range(8)]
            size = 0
            for k, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                if len(text.encode("utf-8", "replace")) <= least:  # a token has at least one byte
                    continue
                prepared = splitter.prepare(text)
                raw = prepared[0]
                for limit, overlap in limits:
                    for no, (s, e, n, o) in enumerate(splitter.split(prepared, limit, overlap)):
                        for column, value in zip(rows, (k, limit, no, s, e, n, o, raw[s:e].decode())):
                            column.append(value)
                        size += e - s
                if size > 4 << 20:
                    yield _batch(rows, key)
                    rows, size = [[] for _ in range(8)], 0
            yield _batch(rows, key)

    rows = df.select(F.col(key).cast("long").alias(key), F.col(text).alias("_text")).filter(F.col(key).isNotNull() & (F.col("_text") != ""))
    return rows.mapInArrow(run, f"`{key}` long, max_tokens int, piece int, first_byte long, end_byte long, tokens int, overlap_tokens int, text string")


def _batch(rows: list[list], key: str) -> pa.RecordBatch:
    kinds = (pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.string())
    return pa.RecordBatch.from_arrays([pa.array(r, t) for r, t in zip(rows, kinds)], names=[key, "max_tokens", "piece", "first_byte", "end_byte", "tokens", "overlap_tokens", "text"])
