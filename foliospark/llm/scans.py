"""Problem 3: noise in text from scanned pages.

``scanlines`` labels the lines. Broken and misread words are then judged by the words of the whole corpus: each
distinct word is counted once, in clean and in scanned text; a rare word that becomes a common one by undoing a
misreading, one of the usual ones or one that the corpus itself shows, is misread; and a word cut at a line end was broken if the parts form a known word rather than a compound
that is always hyphenated. Counting, finding corrections and looking up each text's words are joins on the word.
"""

from __future__ import annotations

import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators.joins import salted_join
from ..session import cut
from .scanlines import BODY, HYPHENS, MISREAD, LineModel, trained_model

TOGETHER = 600  # texts, about, that one part of the line model is trained on; with fewer clean ones scans are trained on too
FIXED = 1 << 32  # what weights are multiplied by, so that their sums are the same in any order
LEAST_GOOD = 3  # occurrences of a word that another may be a misreading of
LEAST_LETTERS = 2  # of a word that may be misread
RATIO = 8  # times that the right word occurs for once that the misread one does
LEARNED = 5  # rare words that must show a misreading
CLEAN_SHARE = 0.05  # of a misread word's occurrences, those in clean text at most
ENDS = frozenset(HYPHENS)
DIGIT = re.compile(r"\d")
WORD = re.compile(r"[^\W_]+(?:[-‐‑'’][^\W_]+)*")
PIECE = re.compile(r"[^\W_]+")
CUT_END = re.compile(rf"([^\W_]+(?:[-‐‑'’][^\W_]+)*)[{HYPHENS}]\s*\Z")
AT_END = re.compile(rf"[{HYPHENS}][^\S\n]*(?:\n|\Z)")
FIRST_WORD = re.compile(r"(?:(?!\n)[\W_])*[^\W_]+(?:[-‐‑'’][^\W_]+)*")
CUT_START = re.compile(r"\s*([^\W_]+(?:[-‐‑'’][^\W_]+)*)")


def is_scan(source_file: Column) -> Column:
    """Whether a file holds pages, scanned or printed, by its name: a format of pages or of images. Where names don't
    tell, give ``scanned_pages`` a condition of your own."""
    return F.coalesce(F.lower(source_file).rlike(r"\.(pdf|djvu?|tiff?|jp2|jpe?g|png|gif|bmp|webp|ps|xps)$"), F.lit(False))


def undone(word: str, misread: list[tuple[str, str]] = MISREAD) -> list[str]:
    """What a word may have been before something in it was misread, once or everywhere."""
    out = set()
    for read, printed in misread:
        at = word.find(read)
        if at < 0:
            continue
        out.add(word.replace(read, printed))
        while at >= 0:
            out.add(word[:at] + printed + word[at + len(read) :])
            at = word.find(read, at + 1)
    out.discard(word)
    return sorted(out)


def _model(texts: DataFrame) -> LineModel:
    """The line model of all clean texts, of scans too where there are few others. Texts are dealt out by hash into parts
    of about ``TOGETHER``, each of which trains weights of its own; the model has their mean."""
    long = texts.filter(F.length("text") > 300)
    n = {r.scan: r.n for r in long.groupBy("scan").agg(F.count("*").alias("n")).collect()}
    if n.get(False, 0) >= TOGETHER:
        long, n = long.filter("not scan"), {False: n[False]}
    parts = -(-sum(n.values()) // TOGETHER)
    if parts == 0:
        return trained_model([])

    def train(group: pa.Table) -> pa.Table:
        model = trained_model(sorted(group.column("text").to_pylist()), 1 + group.column("part")[0].as_py())
        row = np.rint(model.numbers() * FIXED).astype(np.int64)
        return pa.table({"k": pa.array(np.arange(len(row)), pa.int32()), "w": pa.array(row)})

    dealt = long.select(F.pmod(F.xxhash64("id", "text"), F.lit(parts)).cast("int").alias("part"), "text").repartition(parts, "part")
    trained = dealt.groupBy("part").applyInArrow(train, "k int, w long")
    rows = sorted((r.k, r.w, r.n) for r in trained.groupBy("k").agg(F.sum("w").alias("w"), F.count("*").alias("n")).collect())
    return LineModel.of_numbers(np.array([w / n for _, w, n in rows]) / FIXED)


def _cut_end(line: str) -> re.Match | None:
    """The word at the end of a line that has a hyphen behind it; the costly search is for lines that end with one."""
    return CUT_END.search(line) if line.rstrip()[-1:] in ENDS else None


def _cuts(lines: list[str], labels: str):
    """(line, next line, left part, right part) of each word that may be cut at the end of a body line."""
    body = [i for i, x in enumerate(labels) if x == BODY]
    for i, j in zip(body, body[1:]):
        a = _cut_end(lines[i])
        b = CUT_START.match(lines[j]) if a else None
        if b and not (a[1].isdigit() and b[1].isdigit()):
            yield i, j, a[1].lower(), b[1].lower()


def _labelled(texts: DataFrame, model: LineModel) -> DataFrame:
    """(id, text, labels, words, wanted): of each scanned text its lines' labels, its distinct whole words, and the
    words and compounds that its cut words may be."""

    def run(batches):
        for b in batches:
            words, wanted = [], []
            documents = [(text.split("\n"), title) for text, title in zip(b.column(1).to_pylist(), b.column(2).to_pylist())]
            labels = model.labels(documents)
            for (lines, _), marks in zip(documents, labels):
                cuts = list(_cuts(lines, marks))
                left, right = {i for i, *_ in cuts}, {j for _, j, *_ in cuts}
                have: set[str] = set()
                plain = []
                for i, line in enumerate(lines):
                    if marks[i] == BODY and (i in left or i in right):
                        found = WORD.findall(line.lower())
                        have.update(found[(i in right) : len(found) - (i in left)])
                    elif marks[i] == BODY:
                        plain.append(line)
                have.update(WORD.findall("\n".join(plain).lower()))
                pieces = {p for w in have if not w.isalnum() for p in PIECE.findall(w)}
                words.append(sorted(have | pieces))
                wanted.append(sorted({w for _, _, x, y in cuts for w in (_joined(x, y), f"{x}-{y}", y)}))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(labels, pa.string()), pa.array(words, pa.list_(pa.string())), pa.array(wanted, pa.list_(pa.string()))], names=["id", "text", "labels", "words", "wanted"])

    return texts.filter("scan").select("id", "text", "title").mapInArrow(run, "id long, text string, labels string, words array<string>, wanted array<string>")


def _joined(x: str, y: str) -> str:
    return x + y


def _whole_words(text: str) -> str:
    """A text without the words that are cut at its line ends: the last one of such a line, the first of the next."""
    out, done = [], 0
    for m in AT_END.finditer(text):
        start = max(text.rfind("\n", 0, m.start()) + 1, done)
        last = CUT_END.search(text[start : m.start() + 1])
        if last:
            out.append(text[done : start + last.start()])
            first = FIRST_WORD.match(text, m.end())
            done = first.end() if first else m.end()
    return "\n".join([*out, text[done:]])


def word_counts(texts: DataFrame) -> DataFrame:
    """(word, clean, scanned): in how many texts' lines each word stands whole, in clean and in scanned texts. A
    compound is counted as such, with a plain hyphen, and by its parts."""

    def run(batches):
        for b in batches:
            counts = {False: Counter(), True: Counter()}
            for text, scan in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                counts[scan].update(WORD.findall(_whole_words(text.lower())))
            words, clean, scanned = [], [], []
            for w in counts[False].keys() | counts[True].keys():
                c, s = counts[False][w], counts[True][w]
                for x in {w.replace("‐", "-").replace("‑", "-"), *(PIECE.findall(w) if not w.isalnum() else ())}:
                    words.append(x), clean.append(c), scanned.append(s)
            yield pa.RecordBatch.from_arrays([pa.array(words, pa.string()), pa.array(clean, pa.int64()), pa.array(scanned, pa.int64())], names=["word", "clean", "scanned"])

    rows = texts.select("text", "scan").mapInArrow(run, "word string, clean long, scanned long")
    return rows.groupBy("word").agg(F.sum("clean").alias("clean"), F.sum("scanned").alias("scanned"))


def _gaps(word: str):
    """(what stands around a gap, what was in it) for each gap of one or two letters in a word."""
    for n in (1, 2):
        for i in range(len(word) - n + 1):
            yield (word[:i], word[i + n :]), word[i : i + n]


def aligned_misreadings(rare: list[tuple[str, int]], good: list[tuple[str, int]], least: int = LEARNED) -> list[tuple[str, str]]:
    """(read, printed) pairs of up to two letters that turn at least ``least`` rare words into common ones. Each rare word
    speaks for the word that it differs from in one place and in the fewest letters, the commonest of such, if that is
    ``RATIO`` times as common."""
    times, around = dict(good), defaultdict(list)
    for g in times:
        for gap, printed in _gaps(g):
            around[gap].append((printed, g))
    words: dict[tuple[str, str], set[str]] = defaultdict(set)
    for w, n in rare:
        found = [(len(read + printed), -times[g], g, read, printed) for gap, read in _gaps(w) for printed, g in around.get(gap, ()) if times[g] >= RATIO * n]
        if found:
            *_, read, printed = min(found)
            words[read, printed].add(w)
    return sorted(pair for pair, have in words.items() if len(have) >= least)


def _around(words: DataFrame, word: str, number: str, between: str) -> DataFrame:
    """(gap, word, number, between) of each gap of one or two letters of each word: what is around it and in it."""

    def run(batches):
        for b in batches:
            at, gaps, within = [], [], []
            for i, w in enumerate(b.column(0).to_pylist()):
                for (left, right), inside in _gaps(w):
                    at.append(i), gaps.append(f"{left} {right}"), within.append(inside)
            at = pa.array(at, pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(gaps, pa.string()), b.column(0).take(at), b.column(1).take(at), pa.array(within, pa.string())], names=["gap", word, number, between])

    return words.select(word, number).mapInArrow(run, f"gap string, {word} string, {number} long, {between} string")


def aligned(rare: DataFrame, good: DataFrame, least: int = LEARNED) -> DataFrame:
    """(read, printed) as ``aligned_misreadings`` finds them among ``rare(word, n)`` and ``good(maybe, times)``, all of
    both: words meet that are equal but for a gap."""
    met = _around(rare, "word", "n", "read").join(_around(good, "maybe", "times", "printed").hint("merge"), "gap").filter(F.col("times") >= RATIO * F.col("n"))
    best = met.groupBy("word").agg(F.min(F.struct((F.length("read") + F.length("printed")).alias("letters"), (-F.col("times")).alias("t"), "maybe", "read", "printed")).alias("b"))
    return best.groupBy("b.read", "b.printed").agg(F.count("*").alias("words")).filter(F.col("words") >= least).select("read", "printed")


def _misreadings(rare: DataFrame, good: DataFrame) -> list[tuple[str, str]]:
    """The usual misreadings and those that this corpus shows, in all its rare and common words. The driver holds them
    all, at most one for each two pairs of letters."""
    few = rare.filter((F.col("n") > 0) & F.col("word").rlike(r"^[\p{L}\p{N}]{4,}$"))
    many = good.filter((F.length("maybe") >= 4) & (F.col("times") >= RATIO * LEAST_GOOD))
    learned = sorted((r["read"], r["printed"]) for r in aligned(few, many).collect())
    return [*MISREAD, *(pair for pair in learned if pair not in MISREAD)]


def corrections(counts: DataFrame, asked: DataFrame) -> DataFrame:
    """(word, right): for each misread word of ``asked(word)``, the commonest word that it may have been."""

    def run(batches):
        starting = defaultdict(list)
        for pair in misread:
            starting[pair[0][0]].append(pair)
        for b in batches:
            words, n, maybe = [], [], []
            for w, c in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                if len(w) >= LEAST_LETTERS:
                    for u in undone(w, [pair for c in set(w) for pair in starting.get(c, ())]):
                        words.append(w), n.append(c), maybe.append(u)
            yield pa.RecordBatch.from_arrays([pa.array(words, pa.string()), pa.array(n, pa.int64()), pa.array(maybe, pa.string())], names=["word", "n", "maybe"])

    rare = asked.distinct().join(counts.hint("merge"), "word", "left").na.fill(0, ["clean", "scanned"])
    rare = cut(rare.filter(F.col("clean") <= CLEAN_SHARE * F.col("scanned")).select("word", (F.col("clean") + F.col("scanned")).alias("n")))
    good = counts.select(F.col("word").alias("maybe"), (F.col("clean") + F.col("scanned")).alias("times")).filter(F.col("times") >= LEAST_GOOD)
    misread = _misreadings(rare, good)
    tried = rare.mapInArrow(run, "word string, n long, maybe string")
    met = tried.join(good.hint("merge"), "maybe").filter(F.col("times") >= RATIO * F.col("n"))
    best = F.row_number().over(Window.partitionBy("word").orderBy(F.col("times").desc(), "maybe"))
    return met.withColumn("r", best).filter("r = 1").select("word", F.col("maybe").alias("right"))


def _mixed(word: str) -> bool:
    """Letters with a digit among them, which no word has."""
    return not word.isalpha() and DIGIT.search(word) is not None and sum(c.isalpha() for c in word) >= 3 and re.search(r"[^\W\d_]\d|\d[^\W\d_]{2}", word) is not None and not re.fullmatch(r"\d+[^\W\d_]+", word)


class Page:
    """One scanned text with its lines' labels and what is known of its words."""

    def __init__(self, text: str, labels: str, right: dict[str, str], known: dict[str, int]):
        self.lines, self.labels, self.right, self.known = text.split("\n"), labels, right, known
        self.joined: dict[int, tuple[int, bool]] = {}  # line -> next line, whether the hyphen is part of the word
        self.noise: dict[int, set[str]] = {}
        for i, x in enumerate(labels):
            if x in "hp":
                self.noise[i] = {"header" if x == "h" else "page_no"}
        cuts = list(_cuts(self.lines, labels))
        for i, j, x, y in cuts:
            whole, compound = known.get(_joined(x, y), 0), known.get(f"{x}-{y}", 0)
            kept = compound > whole or (self.lines[i].rstrip()[-1:] in "-‐‑" and whole == 0 and "-" in x and known.get(y, 0) > 0)
            self.joined[i] = (j, kept)
            if not kept:
                self.noise.setdefault(i, set()).add("hyphen")
            fixed = right.get(_joined(x, y))
            if fixed and whole * RATIO < known.get(fixed, LEAST_GOOD) and not kept:
                self.noise.setdefault(i if fixed[: len(x)] != x else j, set()).add("ocr")
        left, rest = {i for i, *_ in cuts}, {j for _, j, *_ in cuts}
        for i, line in enumerate(self.lines):
            if labels[i] == BODY:
                low = line.lower()
                if not DIGIT.search(low) and not any(w in low for w in right):
                    continue  # nothing of the line can be misread
                found = WORD.findall(low)
                whole_words = found[(i in rest) : len(found) - (i in left)]
                if any(self._misread(w) for w in whole_words) or any(_mixed(w) for w in found):
                    self.noise.setdefault(i, set()).add("ocr")

    def _misread(self, word: str) -> bool:
        return word in self.right or (not word.isalnum() and any(p in self.right for p in PIECE.findall(word)))

    def _mend(self, line: str) -> str:
        def swap(m: re.Match) -> str:
            w, new = m[0], self.right.get(m[0].lower())
            if new is None:
                return w
            return new.upper() if w.isupper() and len(w) > 1 else new[:1].upper() + new[1:] if w[:1].isupper() else new

        return PIECE.sub(swap, WORD.sub(swap, line))

    def paragraphs(self) -> str:
        """The body as paragraphs: noise lines left out, broken words and lines joined, misread words mended. A
        paragraph ends at a blank line within a page, or before an indented line that follows the end of a sentence."""
        out, now, glue, blank, noise_between = [], "", None, False, False
        for i, line in enumerate(self.lines):
            x = self.labels[i]
            if x != BODY:
                blank |= x == " " and not line.strip()
                noise_between |= x != " " or bool(line.strip())
                continue
            text = line.strip()
            new = (blank and not noise_between) or (line[:2].isspace() and now[-1:] in ".!?:”\"»’") or (blank and now[-1:] in ".!?:”\"»’")
            if now and new and glue is None:
                out.append(now)
                now = ""
            if glue is not None:
                now += text
            else:
                now += (" " if now else "") + text
            glue, blank, noise_between = None, False, False
            if i in self.joined:
                j, kept = self.joined[i]
                now = now.rstrip()
                now = now[:-1] + "-" if kept else now[:-1]
                glue = j
        if now:
            out.append(now)
        return "\n\n".join(self._mend(p) for p in out)


def _lookups(pages: DataFrame, fixes: DataFrame, counts: DataFrame) -> DataFrame:
    """(id, text, labels, right, known) with the corrections of a text's words and the counts of its cut words."""
    all_words = pages.select("id", F.explode(F.array_union("words", "wanted")).alias("word"))
    right = salted_join(all_words, fixes, ["word"], F.col("id")).groupBy("id").agg(F.map_from_entries(F.collect_list(F.struct("word", "right"))).alias("right"))
    wanted = pages.select("id", F.explode("wanted").alias("word"))
    known = salted_join(wanted, counts.select("word", (F.col("clean") + F.col("scanned")).alias("n")), ["word"], F.col("id")).groupBy("id").agg(F.map_from_entries(F.collect_list(F.struct("word", "n"))).alias("known"))
    return pages.select("id", "text", "labels").join(right, "id", "left").join(known, "id", "left")


def scanned_pages(df: DataFrame, key: str, source_file: str, text: str, title: Column | None = None, scan: Column | None = None) -> DataFrame:
    """(id, text, labels, right, known) of every scanned text of ``df``; see ``noise_lines`` and ``repaired``.

    Keys must be unique; rows without key or text have no row. ``scan`` says which rows are scans; without it
    ``is_scan`` does by the file's name. Texts of other files only serve as clean text for word counts and for the line
    model.
    """
    texts = df.select(F.col(key).cast("long").alias("id"), F.col(text).alias("text"), (is_scan(F.col(source_file)) if scan is None else F.coalesce(scan, F.lit(False))).alias("scan"), (title if title is not None else F.lit(None).cast("string")).alias("title"))
    texts = texts.filter("id is not null and text <> ''")
    pages = cut(_labelled(texts, _model(texts)))
    counts = cut(word_counts(texts))
    asked = pages.select(F.explode(F.array_union("words", "wanted")).alias("word"))
    return _lookups(pages, cut(corrections(counts, asked)), counts)


def noise_lines(pages: DataFrame, key: str) -> DataFrame:
    """(key, line_no, kind) of the lines with noise: header, page_no, hyphen or ocr. Lines are numbered from 1."""

    def run(batches):
        for b in batches:
            ids, no, kinds = [], [], []
            for i, page in zip(b.column(0).to_pylist(), _pages(b)):
                for n, kind in sorted((n, k) for n, ks in page.noise.items() for k in ks):
                    ids.append(i), no.append(n + 1), kinds.append(kind)
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(no, pa.int32()), pa.array(kinds, pa.string())], names=[key, "line_no", "kind"])

    return pages.mapInArrow(run, f"`{key}` long, line_no int, kind string")


def repaired(pages: DataFrame, key: str) -> DataFrame:
    """(key, text) with the text as continuous paragraphs."""

    def run(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([p.paragraphs() for p in _pages(b)], pa.string())], names=[key, "text"])

    return pages.mapInArrow(run, f"`{key}` long, text string")


def _pages(b: pa.RecordBatch):
    for text, labels, right, known in zip(*(b.column(i).to_pylist() for i in range(1, 5))):
        yield Page(text, labels, dict(right or ()), dict(known or ()))
