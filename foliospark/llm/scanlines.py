"""Labels for the lines of scanned pages: a linear-chain conditional model over layout features.

A line is a running header or footer, a page number, body text, or a break (blank, form feed or page comment). The
model scores features of each line together with its label, and pairs of neighbouring labels; the best sequence is
found by Viterbi's algorithm. It is a structured perceptron with averaged weights, trained here on pages that are laid
out from clean prose with every kind of header, number, hyphen and misreading, so no page needs to be labelled by hand.
"""

from __future__ import annotations

import random
import re
from bisect import bisect_left
from collections import Counter

import numpy as np

BODY, HEADER, PAGE, BREAK = "bhp "
LABELS = [BODY, HEADER, PAGE, BREAK]

COMMENT = re.compile(r"\s*<!--\s*page_number:\s*(\d+)\s*-->\s*")
ROMAN = re.compile(r"(?=[ivxlcdm])m{0,3}(?:cm|cd|d?c{0,3})(?:xc|xl|l?x{0,3})(?:ix|iv|v?i{0,3})", re.I)
NUMBER = re.compile(r"[\[(<{|~*·•.\-–—−_ ]*(?:(?:page|pages?|pag\.?|pág\.?|página|seite|s\.|p\.|pp\.|стр\.?|с\.|f\.|fol\.)\s*)?(\d{1,4}|[ivxlcdm]{1,9})(?:\s*(?:of|de|von|sur|/|из)\s*\d{1,5})?[\])>}|~*·•.\-–—−_ ]*", re.I)
WITH_NUMBER = re.compile(r"(?:(\d{1,4})(?:\s{2,}|\s*[|·•—–]\s*)(\S.*?))|(?:(\S.*?)(?:\s{2,}|\s*[|·•—–]\s*)(\d{1,4}))")
HYPHENS = "-‐‑¬­=~⸗"
STOPS, CLOSING = ".!?:;…", "\"'”’»)]"
GAPS = re.compile(r"[^\w\n]+|_+")  # all that is no letter, digit or line feed
GRAMS = 3


def _roman(s: str) -> int | None:
    if not ROMAN.fullmatch(s):
        return None
    values = {"i": 1, "v": 5, "x": 10, "l": 50, "c": 100, "d": 500, "m": 1000}
    n = [values[c] for c in s.lower()]
    return sum(-a if a < b else a for a, b in zip(n, [*n[1:], 0]))


def page_value(line: str) -> int | None:
    """The number that a line gives and nothing else, if it does."""
    m = NUMBER.fullmatch(line.strip())
    if not m:
        return None
    return int(m[1]) if m[1].isdigit() else _roman(m[1])


def split_number(line: str) -> tuple[str, int | None]:
    """A line's words and the number set apart at its start or end."""
    m = WITH_NUMBER.fullmatch(line.strip())
    if not m:
        return line.strip(), None
    return (m[2], int(m[1])) if m[1] else (m[3], int(m[4]))


def _codes(texts: list[str]) -> tuple[np.ndarray, np.ndarray, int]:
    """(text, gram) of every run of GRAMS letters or digits of each text, and the number of different grams, which are
    numbered from 0. Everything else between the letters is left out."""
    flat = GAPS.sub("", "\n".join(t.replace("\n", " ") for t in texts)).lower()
    c = np.frombuffer(flat.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    if len(c) < GRAMS:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), 0
    end = c == 10
    owner = np.cumsum(end) - end
    n = len(c) - GRAMS + 1
    whole = ~np.any([end[i : i + n] for i in range(GRAMS)], axis=0)
    gram = sum((c[i : i + n] << np.uint64(21 * i)) for i in range(GRAMS))[whole]  # a character has at most 21 bits
    if not len(gram):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), 0
    kinds, gram = np.unique(gram, return_inverse=True)
    return owner[:n][whole], gram, len(kinds)


def _likeness(texts: list[str]) -> np.ndarray:
    """The Jaccard similarity of the texts' sets of grams, of each with each; 0 where both are empty."""
    text, gram, n = _codes(texts)
    m = np.zeros((len(texts), max(n, 1)), np.float32)
    m[text, gram] = 1
    both, size = m @ m.T, m.sum(1)
    return both / np.maximum(size[:, None] + size[None, :] - both, 1)


def _nearest(holds: list[bool]) -> list[int | None]:
    """For each place the last earlier one at which it holds."""
    out, last = [], None
    for i, h in enumerate(holds):
        out.append(last)
        if h:
            last = i
    return out


def _terminal(t: str) -> bool:
    """Whether a stripped line ends as a sentence does."""
    return t.rstrip(CLOSING)[-1:] in STOPS if t else False


def _broken(t: str) -> bool:
    """Whether a stripped line ends with a letter and a hyphen."""
    return t[-1:] in HYPHENS and t[-2:-1].isalpha() if t else False


_bits: dict[str, int] = {}


def _bit(name: str) -> int:
    """The bit that stands for a feature in a line's number."""
    if name not in _bits:
        _bits[name] = 1 << len(_bits)
    return _bits[name]


ENDS = {x: _bit("end:" + x) for x in ("stop", "hyphen", "open")}
STARTS = {x: _bit("start:" + x) for x in ("low", "up", "other")}
AMID = {(o, low, e): _bit(f"amid:{o:d}{low:d}:{e}") for o in (False, True) for low in (False, True) for e in ENDS}
LENGTHS = [_bit(f"len:{i}") for i in range(6)]
AGAIN = {x: _bit("again:" + x) for x in ("same", "like", "no")}
BIAS, BREAKS = _bit("bias"), _bit("break")
SIMPLE = {
    x: _bit(x)
    for x in (
        "number", "number:bare", "number:dot", "number:roman", "number:decorated", "dot:open:end", "dot:open:on", "dot:closed:end", "dot:closed:on", "number:runs", "number:comment", "number:near", "number:centred", "number:labelled", "number:amid", "number:after stop", "number:outside", "number:inside",
        "apart", "apart:runs", "apart:comment", "upper", "titled", "not short", "cut:low", "cut:up", "alone", "near", "near:upper", "near:stop", "near:hyphen", "near:open",
        "under number", "under number:runs", "over number", "over number:runs", "indent", "first", "first:upper", "last", "after blank", "before blank",
    )
}


def features(lines: list[str], title: str | None = None) -> list[int]:
    """For each line a number whose bits are the features that hold."""
    n = len(lines)
    text = [x.strip() for x in lines]
    mark = ["\x0c" in x or ("<!--" in x and COMMENT.fullmatch(x) is not None) for x in lines]
    broken = [not t or m for t, m in zip(text, mark)]
    widths = sorted(len(t) for t, b in zip(text, broken) if not b)
    width = max(widths[int(len(widths) * 0.8)] if widths else 1, 1)
    value = [None if b else page_value(t) for t, b in zip(text, broken)]
    apart = [split_number(t) if not b and (t[0].isdigit() or t[-1].isdigit()) else (t, None) for t, b in zip(text, broken)]
    comments = {int(m[1]) for x, k in zip(lines, mark) if k and (m := COMMENT.fullmatch(x))}
    stops, cuts = [_terminal(t) for t in text], [_broken(t) for t in text]
    # Numbers that run on: pages lie some lines apart and count up one by one.
    numbers = [(i, v if v is not None else apart[i][1]) for i, v in enumerate(value) if not broken[i] and (v is not None or apart[i][1] is not None)]
    runs = Counter()
    for k, (i, v) in enumerate(numbers):
        for j, w in numbers[k + 1 : k + 12]:
            if w == v + 1 and j - i >= 3:
                runs[i] += 1
                runs[j] += 1
    counted = [(i, v) for i, v in numbers if runs[i]]
    counted_at = [i for i, _ in counted]
    # Words of short lines that come again, misread letters allowed for.
    first = next((i for i, b in enumerate(broken) if not b), None)
    short = [i for i in range(n) if not broken[i] and value[i] is None and 4 <= len(apart[i][0]) <= 0.98 * width and not _terminal(apart[i][0]) and not cuts[i]]
    if first is not None and (not short or short[0] != first):
        short.insert(0, first)
    again: dict[int, float] = {}
    titled: set[int] = set()
    if short:
        like = _likeness([apart[i][0] for i in short] + ([title] if title else []))
        if title:
            titled = {i for i, x in zip(short, like[-1]) if x >= 0.5}
            like = like[:-1, :-1]
        np.fill_diagonal(like, 0)
        again = dict(zip(short, like.max(1).tolist()))
    # The nearest line before and after each that is no break, and that gives no page number either.
    solid = [not b for b in broken]
    wordy = [not b and v is None for b, v in zip(broken, value)]
    befores, afters, wordy_before, wordy_after = _nearest(solid), _nearest(solid[::-1])[::-1], _nearest(wordy), _nearest(wordy[::-1])[::-1]
    marked = {j for i, m in enumerate(mark) if m for j in range(i - 2, i + 3)}
    has = SIMPLE
    out = []
    for i, t in enumerate(text):
        if broken[i]:
            out.append(BIAS | BREAKS)
            continue
        f = BIAS
        words, number = apart[i]
        before, b2 = befores[i], wordy_before[i]
        after, a2 = (None if x[i] is None else n - 1 - x[i] for x in (afters, wordy_after))
        open_before = b2 is not None and not stops[b2]
        low_after = a2 is not None and text[a2][:1].islower()
        near = i in marked
        if value[i] is not None:
            plain = t.rstrip(".").isdigit()
            f |= has["number"] | has["number:bare" if t.isdigit() else "number:dot" if plain else "number:roman" if not any(c.isdigit() for c in t) else "number:decorated"]
            if plain and not t.isdigit():
                f |= has["dot:" + ("open" if open_before else "closed") + (":end" if after is None or after > i + 1 else ":on")]
            if runs[i]:
                f |= has["number:runs"]
            elif counted:  # between the pages' numbers before and after, or not
                k = bisect_left(counted_at, i)
                above, under = counted[k - 1][1] if k else -1, counted[k][1] if k < len(counted) else 1 << 30
                f |= has["number:inside" if above < value[i] < under else "number:outside"]
            label = i - 1
            alone = label == b2 and label >= 0 and open_before and not cuts[label] and len(text[label]) <= 0.5 * width and text[label][:1].isupper()
            ahead = wordy_before[label] if alone else None
            if alone and (ahead is None or stops[ahead]):  # a short line by itself, which the number may belong to
                f |= has["number:labelled"]
            else:
                f |= has["number:amid" if open_before else "number:after stop"]
            if value[i] in comments:
                f |= has["number:comment"]
            if near:
                f |= has["number:near"]
            if lines[i][:8].isspace():
                f |= has["number:centred"]
        else:
            if number is not None:
                f |= has["apart"]
                if runs[i]:
                    f |= has["apart:runs"]
                if number in comments:
                    f |= has["apart:comment"]
            capitals = sum(map(str.isupper, words))
            upper = capitals > 3 and capitals >= 0.8 * sum(map(str.isalpha, words))
            if upper:
                f |= has["upper"]
            like_ = again.get(i)
            if like_ is None:
                f |= has["not short"]
            else:
                f |= AGAIN["same" if like_ >= 0.75 else "like" if like_ >= 0.45 else "no"]
                if i in titled:
                    f |= has["titled"]
            low = words[:1].islower()
            ends = "stop" if stops[i] else "hyphen" if cuts[i] else "open"
            f |= LENGTHS[min(int(len(t) / width * 5), 5)] | STARTS["low" if low else "up" if words[:1].isupper() else "other"] | ENDS[ends] | AMID[open_before, low_after, ends]
            if b2 is not None and cuts[b2]:
                f |= has["cut:low" if low else "cut:up"]
            if ends == "open" and a2 is not None and not low_after and not lines[a2][:2].isspace() and b2 is not None and not open_before:
                f |= has["alone"]
            if near:
                f |= has["near"] | has["near:upper" if upper else "near:" + ends]
            if before is not None and before >= i - 2 and value[before] is not None:
                f |= has["under number:runs" if runs[before] else "under number"]
            if after is not None and after <= i + 2 and value[after] is not None:
                f |= has["over number:runs" if runs[after] else "over number"]
            if lines[i][:2].isspace():
                f |= has["indent"]
        if i == first or (first is not None and i == first + 1 and value[first] is not None):
            f |= has["first:upper" if f & has["upper"] else "first"]
        if after is None:
            f |= has["last"]
        if i > 0 and broken[i - 1] and not mark[i - 1]:
            f |= has["after blank"]
        if i + 1 < n and broken[i + 1] and not mark[i + 1]:
            f |= has["before blank"]
        out.append(f)
    return out


TOGETHER = 256  # documents whose labels are found together


class LineModel:
    """Weights of features and of neighbouring labels."""

    def __init__(self) -> None:
        self.weights = np.zeros((len(_bits), len(LABELS)))
        self.pairs = np.zeros((len(LABELS), len(LABELS)))
        self._rows: dict[int, int] = {}
        self._scores = np.zeros((0, len(LABELS)))

    @staticmethod
    def _which(f: int) -> list[int]:
        return [i for i in range(f.bit_length()) if f >> i & 1]

    def _score(self, f: int) -> np.ndarray:
        out = self.weights[self._which(f)].sum(0)
        out[LABELS.index(BREAK)] = 1e6 if f & BREAKS else -1e6  # a break can be told for certain
        return out

    def _lookup(self, feats: list[int]) -> np.ndarray:
        """The scores of lines; they repeat, so those of each number are summed up once."""
        at = [self._rows.setdefault(f, len(self._rows)) for f in feats]
        if len(self._rows) > len(self._scores):
            new = list(self._rows)[len(self._scores) :]
            self._scores = np.concatenate([self._scores, [self._score(f) for f in new]])
        return self._scores[at]

    def best(self, documents: list[list[int]]) -> list[list[int]]:
        """The best labels of each document by Viterbi's algorithm, of all documents line by line at once."""
        out: list[list[int]] = [[] for _ in documents]
        order = sorted((i for i, d in enumerate(documents) if d), key=lambda i: -len(documents[i]))
        for s in range(0, len(order), TOGETHER):
            group = order[s : s + TOGETHER]
            sizes = np.array([len(documents[i]) for i in group])
            scores = np.zeros((len(group), sizes[0], len(LABELS)))
            for k, i in enumerate(group):
                scores[k, : sizes[k]] = self._lookup(documents[i])
            back = np.zeros((len(group), sizes[0], len(LABELS)), np.int8)
            total = scores[:, 0].copy()
            for t in range(1, sizes[0]):
                live = int(np.searchsorted(-sizes, -t))  # documents that have this line; the longest come first
                step = total[:live, :, None] + self.pairs
                back[:live, t] = step.argmax(1)
                total[:live] = step.max(1) + scores[:live, t]
            now, path = total.argmax(1), np.zeros((len(group), sizes[0]), np.int8)
            for t in range(sizes[0] - 1, -1, -1):
                live = int(np.searchsorted(-sizes, -t))
                path[:live, t] = now[:live]
                now[:live] = back[np.arange(live), t, now[:live]]
            for k, i in enumerate(group):
                out[i] = path[k, : sizes[k]].tolist()
        return out

    def label(self, lines: list[str], title: str | None = None) -> str:
        """One letter a line."""
        return self.labels([(lines, title)])[0]

    def labels(self, documents: list[tuple[list[str], str | None]]) -> list[str]:
        """One letter a line of each (lines, title)."""
        return ["".join(LABELS[k] for k in path) for path in self.best([features(lines, title) for lines, title in documents])]

    def _path(self, f: np.ndarray, starts: np.ndarray, breaks: list[bool]) -> list[int]:
        """The best labels of one document, of which ``f`` has the features of all lines, each line's from its start on.
        The same as ``best`` gives, faster for one document while weights change."""
        scores = np.add.reduceat(self.weights[f], starts, 0).tolist()
        pairs, last = self.pairs.tolist(), len(LABELS) - 1
        back, total, before = [], [0.0], ()
        for row, is_break in zip(scores, breaks):
            now = (last,) if is_break else range(last)
            if not before:
                total = [1e6 if is_break else row[k] for k in now]
                back.append(None)
            else:
                new, came = [], []
                for k in now:
                    top, at = -np.inf, 0
                    for j, x in enumerate(before):
                        v = total[j] + pairs[x][k]
                        if v > top:
                            top, at = v, j
                    new.append(top + (0.0 if is_break else row[k]))
                    came.append(at)
                total = new
                back.append(came)
            before = now
        at = total.index(max(total)) if total else 0
        path = []
        for is_break, came in zip(reversed(breaks), reversed(back)):
            path.append(last if is_break else at)
            at = came[at] if came else 0
        return path[::-1]

    def train(self, pages: list[tuple[list[str], str | None, str]], rounds: int = 6, seed: int = 3) -> LineModel:
        """Averaged perceptron over (lines, title, labels)."""
        which: dict[int, list[int]] = {}
        data = []
        for lines, title, labels in pages:
            feats = [which.get(f) or which.setdefault(f, self._which(f)) for f in features(lines, title)]
            sizes = [len(f) for f in feats]
            data.append((feats, np.array([i for f in feats for i in f], np.int64), np.cumsum([0, *sizes[:-1]]), [BREAK_AT in f for f in feats], [LABELS.index(x) for x in labels]))
        sums, pair_sums, when = np.zeros_like(self.weights), np.zeros_like(self.pairs), 1
        order = list(range(len(data)))
        rng = random.Random(seed)
        for _ in range(rounds):
            rng.shuffle(order)
            for d in order:
                feats, flat, starts, breaks, gold = data[d]
                got = self._path(flat, starts, breaks) if feats else []
                if got != gold:
                    for f, g, b in zip(feats, gold, got):
                        if g != b:
                            for x in f:
                                self.weights[x, g] += 1
                                self.weights[x, b] -= 1
                                sums[x, g] += when
                                sums[x, b] -= when
                    for path, sign in ((gold, 1), (got, -1)):
                        for a, b in zip(path, path[1:]):
                            self.pairs[a, b] += sign
                            pair_sums[a, b] += sign * when
                when += 1
        self.weights -= sums / when
        self.pairs -= pair_sums / when
        self._rows, self._scores = {}, self._scores[:0]
        return self

    def numbers(self) -> np.ndarray:
        """All weights in one row."""
        return np.concatenate([self.weights.ravel(), self.pairs.ravel()])

    @classmethod
    def of_numbers(cls, row: np.ndarray) -> LineModel:
        out = cls()
        out.weights = row[: out.weights.size].reshape(out.weights.shape)
        out.pairs = row[out.weights.size :].reshape(out.pairs.shape)
        return out


BREAK_AT = BREAKS.bit_length() - 1  # the number of the feature that only breaks have


# What scanners commonly take for what, as (read, printed).
MISREAD = [
    ("c", "e"), ("f", "t"), ("l", "i"), ("5", "s"), ("ri", "n"), ("o", "a"), ("0", "o"), ("cl", "d"), ("1", "l"), ("ii", "u"), ("b", "h"),
    ("rn", "m"), ("vv", "w"), ("9", "g"), ("6", "b"), ("m", "rn"), ("d", "cl"), ("н", "и"), ("щ", "ш"), ("ii", "ü"), ("o", "â"), ("c", "é"), ("6", "é"), ("c", "ê"), ("b", "ß"),
    ("l", "í"), ("l", "î"), ("1", "i"), ("e", "c"), ("h", "b"), ("n", "и"), ("о", "а"), ("с", "е"), ("tl", "d"), ("li", "h"), ("8", "B"), ("3", "з"), ("6", "б"), ("0", "о"), ("іп", "т"), ("п", "л"), ("л", "п"), ("е", "с"),
]


class PageMaker:
    """Lays out clean paragraphs as scanned pages and keeps what each line is."""

    def __init__(self, seed: int = 1):
        self.rng = random.Random(seed)

    def noisy(self, s: str, times: int) -> str:
        for _ in range(times):
            if s:
                i = self.rng.randrange(len(s))
                s = s[:i] + self.rng.choice("eolc1.5a") + s[i + 1 :]
        return s

    def wrap(self, text: str, width: int, indent: str, sign: str, rate: float) -> list[str]:
        out, line = [], indent
        for word in text.split():
            space = "" if not line.strip() else " "
            if len(line) + len(space) + len(word) <= width:
                line += space + word
                continue
            room = width - len(line) - len(space) - len(sign)
            if sign and room >= 2 and len(word) - room >= 2 and word.isalpha() and self.rng.random() < rate:
                out.append(line + space + word[:room] + sign)
                line = word[room:]
            else:
                out.append(line)
                line = word
        return [*out, line] if line.strip() else out

    def document(self, paragraphs: list[str], title: str, other: str) -> tuple[list[str], str | None, str]:
        r = self.rng
        width, per_page = r.randint(38, 76), r.randint(18, 45)
        indent = r.choice(["", "", "    ", "  "])
        sign, rate = r.choice(["-", "-", "‐", "¬", "=", "­", ""]), r.choice([0.3, 0.8])
        body: list[str] = []
        for p in paragraphs:
            lines = self.wrap(p, width, indent, sign, rate)
            body += lines if indent or not body else ["", *lines]
            if r.random() < 0.15:  # a name with its value, as in a table of two lines
                name = " ".join(w for w in p.split()[: r.randint(3, 12)] if w.isalpha())[-18:].strip().capitalize()
                body += r.choice([[], [""]]) + [name or "Number", str(r.randint(1, 400))] + r.choice([[], [""]])
        page, roman = r.randint(1, 400), r.random() < 0.08
        number = r.choice(["{}", "{}", "{}", "{}", "- {} -", "— {} —", "[{}]", "p. {}", "{}.", "Page {}", "Page {} of 412", "S. {}", "·{}·", "{} / 388", ""])
        header = r.choice(["{t}", "{t}", "{t}", "{T}", "{T}", "{t} | {n}", "{n}   {T}", "{T}   {n}", "{n} | {t}", "{t} — {n}", "both", ""])
        mark = r.choice(["", "", "", "\x0c", "comment"])
        below = r.random() < 0.5  # where the number stands
        head_below = r.random() < 0.15
        gap = r.choice([0, 0, 0, 1])
        centred = r.random() < 0.25
        out: list[tuple[str, str]] = [(title, BODY)] if r.random() < 0.9 else []
        if out and r.random() < 0.8:
            out.append(("", BREAK))
        if mark == "comment" and r.random() < 0.6:
            out.insert(0, (f"<!-- page_number: {page} -->", BREAK))

        def shown(n: int) -> str:
            return self._roman(n) if roman else str(n)

        at = r.randint(5, per_page)
        while body:
            here, body, at = body[:at], body[at:], per_page + r.randint(-3, 3)
            out += [(x, BREAK if not x.strip() else BODY) for x in here]
            if not body and r.random() < 0.6:
                break
            foot, top = [], []
            line = (" " * (width // 2 - 2) if centred else "") + number.format(shown(page)) if number else ""
            if header and not (r.random() < 0.1):
                if header == "both":
                    h = f"{page}   {title.upper()}" if page % 2 == 0 else f"{other.upper()}   {page}"
                else:
                    t = title if r.random() < 0.6 else other
                    h = header.format(t=t, T=t.upper(), n=page)
                if r.random() < 0.25:
                    h = self.noisy(h, 1)
                (foot if head_below else top).append((h, HEADER))
            if line and not any(str(page) in h for h, _ in foot + top if header not in ("{t}", "{T}")):
                (foot if below else top).insert(0, (line, PAGE))
            space = [("", BREAK)] * gap
            out += (space + foot if foot else []) + ([("\x0c", BREAK)] if mark == "\x0c" else [(f"<!-- page_number: {page + 1} -->", BREAK)] if mark else [])
            if body:
                out += top + (space if top else [])
            page += 1
        lines = [x for x, _ in out]
        labels = "".join(k for _, k in out)
        return lines, r.choice([title, None, other]), labels

    @staticmethod
    def _roman(n: int) -> str:
        out = ""
        for v, s in ((1000, "m"), (900, "cm"), (500, "d"), (400, "cd"), (100, "c"), (90, "xc"), (50, "l"), (40, "xl"), (10, "x"), (9, "ix"), (5, "v"), (4, "iv"), (1, "i")):
            while n >= v:
                out, n = out + s, n - v
        return out


def trained_model(texts: list[str], seed: int = 1) -> LineModel:
    """A model trained on pages laid out from clean texts with headings and paragraphs."""
    maker = PageMaker(seed)
    prose, titles = [], []
    for t in texts:
        for block in re.split(r"\n\s*\n", t):
            block = block.strip()
            if block.startswith("#"):
                titles.append(block.lstrip("# ").split("\n")[0])
            elif len(block) > 150 and block[:1].isalpha() and "|" not in block:
                prose.append(" ".join(block.split()))
    prose = prose or ["The quick brown fox jumps over the lazy dog near the river bank in the year 1402. " * 4]
    titles = titles or ["A chapter", "Another chapter"]
    pages = []
    for i in range(0, len(prose), 4):
        pages.append(maker.document(prose[i : i + maker.rng.randint(1, 9)], maker.rng.choice(titles), maker.rng.choice(titles)))
    return LineModel().train(pages)
