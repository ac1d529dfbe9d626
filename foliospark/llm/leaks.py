"""Problem 7: evaluation passages inside training text.

The held-out items form a BM25 inverted index whose postings come in blocks with their greatest score. Every training
passage (a window of a document's words) is a query; block-max WAND retrieves all items that score above the threshold,
and the words in sequence are then verified.

The threshold loses nothing. A passage that holds ``run`` consecutive words of an item scores at least the least sum of
the weights of the distinct words in any such run of the item, so each item's weights are divided by that sum and the
threshold is 1 for all of them.
"""

from __future__ import annotations

from bisect import bisect_left
from collections import Counter, defaultdict
from collections.abc import Callable
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.textform import text_form
from ..functions.words import words_of
from ..session import cut

RUN = 12
WINDOW = 2  # runs that a passage is long, at most
BLOCK = 64
K1, B = 1.2, 0.75
MOST_INDEX_WORDS = 2_000_000  # words of items in one index, some 200 MB; more items are indexed and searched in turn


class ItemIndex:
    """BM25 postings of items, ready for block-max WAND."""

    def __init__(self, items: list[tuple[int, list[str]]], run: int = RUN, questions: dict[int, list[str]] | None = None):
        self.run, self.questions = run, questions or {}
        self.items = [(i, w) for i, w in items if len(w) >= run]
        lengths = [len(w) for _, w in self.items]
        mean = sum(lengths) / max(len(lengths), 1)
        df = Counter(t for _, w in self.items for t in set(w))
        self.terms = {t: n for n, t in enumerate(df)}
        idf = np.array([np.log1p((len(self.items) - n + 0.5) / (n + 0.5)) for n in df.values()])
        postings: dict[int, list[tuple[int, float]]] = defaultdict(list)
        self.ids: list[np.ndarray] = []
        for d, (_, w) in enumerate(self.items):
            ids = np.array([self.terms[t] for t in w])
            self.ids.append(ids)
            norm = K1 * (1 - B + B * len(w) / mean)
            weight = {t: idf[t] * n * (K1 + 1) / (n + norm) for t, n in Counter(ids.tolist()).items()}
            least = min(sum(weight[t] for t in set(ids[s : s + run].tolist())) for s in range(len(ids) - run + 1))
            for t, x in weight.items():
                postings[t].append((d, x / least * (1 + 1e-9)))
        self.docs = {t: [d for d, _ in p] for t, p in postings.items()}
        self.scores = {t: [x for _, x in p] for t, p in postings.items()}
        self.block_max = {t: [max(s[i : i + BLOCK]) for i in range(0, len(s), BLOCK)] for t, s in self.scores.items()}
        self.bound = np.zeros(len(self.terms) + 1)  # the last place is for words that no item has
        for t, s in self.scores.items():
            self.bound[t] = max(s)
        self.bounds = self.bound.tolist()
        self.runs: dict[tuple, list[int]] | None = None

    def search(self, terms: list[int]) -> list[int]:
        """The items that score at least 1 for a query of distinct terms: block-max WAND with a fixed threshold."""
        docs, scores, block_max, bounds = self.docs, self.scores, self.block_max, self.bounds
        cursor = dict.fromkeys(terms, 0)
        found = []
        while cursor:
            order = sorted([(docs[t][c], t) for t, c in cursor.items()])
            total, pivot = 0.0, None
            for doc, t in order:
                total += bounds[t]
                if total >= 1:
                    pivot = doc
                    break
            if pivot is None:
                break
            upto = [t for doc, t in order if doc <= pivot]
            place = {t: p for t in upto if (p := bisect_left(docs[t], pivot, cursor[t])) < len(docs[t])}
            if sum([block_max[t][p // BLOCK] for t, p in place.items()]) >= 1:
                if sum([scores[t][p] for t, p in place.items() if docs[t][p] == pivot]) >= 1:
                    found.append(pivot)
                after = pivot + 1
            else:
                # No item up to the first block's end, or the next list's item, can reach the threshold.
                ends = [docs[t][min((p // BLOCK + 1) * BLOCK, len(docs[t])) - 1] + 1 for t, p in place.items()]
                beyond = [doc for doc, _ in order[len(upto) :]][:1]
                after = max(pivot + 1, min([*ends, *beyond], default=0))
            for t in upto:
                c = bisect_left(docs[t], after, cursor[t])
                if c < len(docs[t]):
                    cursor[t] = c
                else:
                    del cursor[t]
        return found

    def holds(self, words: np.ndarray, item: int) -> bool:
        """Whether the words contain a run of the item."""
        if self.runs is None:
            self.runs = {}
            for d, ids in enumerate(self.ids):
                for s in range(len(ids) - self.run + 1):
                    have = self.runs.setdefault(tuple(ids[s : s + self.run].tolist()), [])
                    if not have or have[-1] != d:
                        have.append(d)
        w = words.tolist()
        return any(item in self.runs.get(tuple(w[s : s + self.run]), ()) for s in range(len(w) - self.run + 1))

    def passages(self, ids: np.ndarray) -> list[np.ndarray]:
        """The windows of a document that can score: a run holds only words of the items, and its bounds add up to the
        threshold, so words outside such runs are left out. Each run lies whole within a window."""
        starts = len(ids) - self.run + 1
        if starts < 1:
            return []
        known = np.concatenate([[0], np.cumsum(ids != len(self.terms))])
        sums = np.concatenate([[0.0], np.cumsum(self.bound[ids])])
        may = (known[self.run :] - known[:starts] == self.run) & (sums[self.run :] - sums[:starts] >= 1 - 1e-9)
        out, next_ = [], -1
        for s in np.flatnonzero(may).tolist():
            if s >= next_:
                out.append(ids[s : s + WINDOW * self.run])
                next_ = s + (WINDOW - 1) * self.run + 1
        return out

    def leaks(self, words: list[str]) -> set[int]:
        """The ids of the items of which the words contain a run."""
        none, get = len(self.terms), self.terms.get
        out: set[int] = set()
        for passage in self.passages(np.array([get(w, none) for w in words], np.int64)):
            terms = [t for t in dict.fromkeys(passage.tolist()) if t != none]
            for d in self.search(terms):
                if self.items[d][0] not in out and self.holds(passage, d):
                    out.add(self.items[d][0])
        return out


    def overlap(self, words: list[str], item: int) -> tuple[int, int, float | None]:
        """(longest run of the item's passages that the words contain, longest run of its question, share of the
        question's distinct words that occur); the share of a question without words is null."""
        asked = self.questions.get(item, [])
        kinds = set(asked)
        share = round(len(kinds & set(words)) / len(kinds), 6) if kinds else None
        return max(longest_run(words, w) for i, w in self.items if i == item), longest_run(words, asked), share


def longest_run(words: list[str], of: list[str]) -> int:
    """The length of the longest run of consecutive words that both lists have."""
    places: dict[str, list[int]] = defaultdict(list)
    for p, w in enumerate(of):
        places[w].append(p)
    best, ends = 0, {}
    for w in words:
        ends = {p: ends.get(p - 1, 0) + 1 for p in places.get(w, ())}
        best = max(best, max(ends.values(), default=0))
    return best


def leaks(documents: DataFrame, key: str, text: str, items: DataFrame, item_key: str, passage: str, question: str | None = None, run: int = RUN) -> DataFrame:
    """(key, item_key) of every document that contains at least ``run`` consecutive words of an item's passage. With
    ``question`` also (passage_run, question_run, question_share): how many words of the passage and of the question
    stand there in a run, and what share of the question's distinct words the document has.

    Words are compared in consistent form and lower case, whatever stands between them. Every item with such a run
    counts, also if several share it; an item's id counts once a document. Null, empty and shorter texts and passages
    match nothing; a null question has runs of 0 and no share. The items are the fixed query set: they are read to the
    driver in id order, in portions of a bounded number of words, and each portion's index is searched over all
    documents. If there are several portions, the documents are brought into words once, as a table.
    """
    form = text_form(documents.sparkSession)
    docs = documents.select(F.col(key).cast("long").alias(key), F.col(text).alias("_text")).filter(f"`{key}` is not null and _text <> ''")
    asked = F.col(question) if question else F.lit(None).cast("string")
    rows = items.select(F.col(item_key).cast("long").alias("item"), F.col(passage).alias("passage"), asked.alias("question")).filter("item is not null and passage <> ''")
    schema = f"`{key}` long, `{item_key}` long" + (", passage_run int, question_run int, question_share double" if question else "")
    kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.float64()]
    names = [key, item_key, "passage_run", "question_run", "question_share"]

    def in_words(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([" ".join(words_of(form(t))) for t in b.column(1).to_pylist()], pa.string())], names=[key, "_text"])

    def search(docs: DataFrame, index: ItemIndex, words: Callable[[str], list[str]]) -> DataFrame:
        def run_(batches):
            for b in batches:
                out = []
                for i, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                    have = words(t)
                    out += [(i, item, *(index.overlap(have, item) if question else ())) for item in sorted(index.leaks(have))]
                columns = list(zip(*out)) or [()] * (5 if question else 2)
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=names[: len(columns)])

        return docs.mapInArrow(run_, schema)

    indexes, portion, asks, held = [], [], {}, 0
    for r in rows.orderBy("item").toLocalIterator():
        portion.append((r.item, words_of(form(r.passage))))
        asks[r.item] = words_of(form(r.question))
        held += len(portion[-1][1])
        if held >= MOST_INDEX_WORDS:
            indexes.append(ItemIndex(portion, run, asks))
            portion, asks, held = [], {}, 0
    if portion or not indexes:
        indexes.append(ItemIndex(portion, run, asks))
    if len(indexes) == 1:
        found = search(docs, indexes[0], lambda t: words_of(form(t)))
    else:
        docs = cut(docs.mapInArrow(in_words, f"`{key}` long, _text string"))
        found = reduce(DataFrame.union, [search(docs, x, str.split) for x in indexes])
    return found.groupBy(key, item_key).agg(*[F.max(n).alias(n) for n in names[2:]]) if question else found.distinct()
