"""Problem 5: groups of records that share most of their word shingles.

A record's set of word shingles is summarised by a SetSketch: ``m`` registers, each the exponent, to the base ``b``, of
the least of the exponential values that the shingles have there, truncated to two bytes. Registers of a union are the
maxima of the registers, and equal registers are as likely as the sets are alike. Registers are joined in bands; of
two records that share a band, the similarity is estimated from all registers jointly by maximum likelihood, and what
may reach the threshold is verified with the exact shingle sets.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.textform import text_form
from ..functions.words import WordHash, shingle_hashes
from ..operators.bands import banded_pairs
from ..operators.components import components
from ..operators.joins import grid_join, salted_join
from ..session import cut

BASE = 1.001  # with two bytes: no set is large enough to be cut off, and unlike sets share a register once in 4000
ROWS_PER_BAND = 3
BANDS = 21
REGISTERS = ROWS_PER_BAND * BANDS
RATE = 8.0  # a: the least register of a set of one shingle is well above zero
SLACK = 3.5  # standard deviations below the threshold that an estimate may lie
HOT = 2048  # pairs of one record that are verified in one place


class SetSketch:
    """Registers for batches of hashed sets. ``sketch`` takes all hashes in a row with each set's start."""

    def __init__(self, m: int = REGISTERS, b: float = BASE, rate: float = RATE, seed: int = 7):
        self.m, self.b, self.rate = m, b, rate
        rng = np.random.default_rng(seed)
        self.mul = rng.integers(1, 2**63, m, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        self.add = rng.integers(0, 2**63, m, dtype=np.uint64)

    def sketch(self, hashes: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """A row of registers for each set; an empty set has registers of zero."""
        n = len(starts) - 1
        out = np.zeros((n, self.m), np.uint16)
        full = np.flatnonzero(np.diff(starts) > 0)
        if not len(full):
            return out
        at, log_b = starts[full], np.log(self.b)
        for i in range(self.m):
            # The least exponential value belongs to the least uniform one, so the logarithm is taken once a set.
            least = np.minimum.reduceat((hashes * self.mul[i] + self.add[i]) >> np.uint64(24), at)
            x = -np.log1p(-(least.astype(np.float64) + 0.5) * 2.0**-40) / self.rate
            out[full, i] = np.clip(np.floor(1 - np.log(x) / log_b), 0, 65535).astype(np.uint16)
        return out

    def cardinality(self, regs: np.ndarray) -> np.ndarray:
        total = np.power(self.b, -regs.astype(np.float64)).sum(1)
        return self.m * (1 - 1 / self.b) / (self.rate * np.log(self.b) * total)

    def jaccard(self, a: np.ndarray, b: np.ndarray, grid: int = 48) -> np.ndarray:
        """Maximum likelihood estimates of the Jaccard similarity of pairs of rows of registers."""
        na, nb = self.cardinality(a), self.cardinality(b)
        u, v = na / (na + nb), nb / (na + nb)
        more, less = (a > b).sum(1)[:, None], (a < b).sum(1)[:, None]
        same = self.m - more - less
        top = np.minimum(u / v, v / u)
        j = np.linspace(0, 1, grid)[None, :] * top[:, None] * (1 - 1e-9)
        p = lambda x: -np.log1p(-np.clip(x, 0, 1) * (self.b - 1) / self.b) / np.log(self.b)
        up, down = p(u[:, None] - v[:, None] * j), p(v[:, None] - u[:, None] * j)
        tiny = 1e-12
        like = more * np.log(up + tiny) + less * np.log(down + tiny) + same * np.log(np.maximum(1 - up - down, tiny))
        return j[np.arange(len(j)), like.argmax(1)]


def _sketches(df: DataFrame, k: int, sketch: SetSketch) -> DataFrame:
    """(tab, id, words_key, regs) of each row of (tab, id, text) that has a shingle."""
    form = text_form(df.sparkSession)

    def run(batches):
        cache = WordHash()
        for b in batches:
            for part in _slices(b, 2000):
                hashes, starts, digests = shingle_hashes(part.column(2).to_pylist(), form, k, cache)
                regs = sketch.sketch(hashes, starts)
                keep = np.flatnonzero(np.diff(starts) > 0)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).take(pa.array(keep)), part.column(1).take(pa.array(keep)), pa.array([digests[i] for i in keep], pa.binary()), pa.array([regs[i].tobytes() for i in keep], pa.binary())],
                    names=["tab", "id", "words_key", "regs"],
                )

    return df.mapInArrow(run, "tab string, id long, words_key binary, regs binary")


def _slices(b: pa.RecordBatch, n: int):
    for i in range(0, b.num_rows, n):
        yield b.slice(i, n)


def _verified(pairs: DataFrame, texts: DataFrame, k: int, threshold: float) -> DataFrame:
    """(tab, id_a, id_b, similarity) of the pairs whose exact similarity reaches the threshold."""
    form = text_form(texts.sparkSession)

    def sets(batches):
        cache = WordHash()
        for b in batches:
            for part in _slices(b, 1000):
                hashes, starts, _ = shingle_hashes(part.column(2).to_pylist(), form, k, cache)
                each = [np.unique(hashes[i:j]).view(np.int64) for i, j in zip(starts, starts[1:])]
                flat = np.concatenate(each) if each else np.zeros(0, np.int64)
                offsets = np.concatenate([[0], np.cumsum([len(x) for x in each])]).astype(np.int32)
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat)), part.column(3), part.column(4)], names=["tab", "id", "set", "as_a", "as_b"])

    # A record with many partners is spread: its pairs over several places, its set to each of them.
    degree = pairs.select("tab", F.col("id_a").alias("id"), F.lit(1).alias("as_a"), F.lit(0).alias("as_b")).union(pairs.select("tab", "id_b", F.lit(0), F.lit(1)))
    wanted = degree.groupBy("tab", "id").agg(*[F.ceil(F.greatest(F.sum(c), F.lit(1)) / HOT).cast("int").alias(c) for c in ("as_a", "as_b")])
    full = texts.join(wanted, ["tab", "id"]).select("tab", "id", "text", "as_a", "as_b")
    full = cut(full.mapInArrow(sets, "tab string, id long, set array<long>, as_a int, as_b int"))
    out = pairs
    for side, other in (("a", "id_b"), ("b", "id_a")):
        places, key = f"as_{side}", f"id_{side}"
        hot = wanted.filter(F.col(places) > 1).select("tab", F.col("id").alias(key), places)
        out = out.join(hot.hint("merge"), ["tab", key], "left").withColumn("place", F.pmod(F.xxhash64(other), F.coalesce(places, F.lit(1))).cast("int")).drop(places)
        spread = full.select("tab", F.col("id").alias(key), F.col("set").alias(side), F.explode(F.sequence(F.lit(0), F.col(places) - 1)).alias("place"))
        out = out.join(spread.hint("merge"), ["tab", key, "place"]).drop("place")
    both = F.size(F.array_intersect("a", "b"))
    out = out.select("tab", "id_a", "id_b", (both / (F.size("a") + F.size("b") - both)).alias("similarity"))
    return out.filter(F.col("similarity") >= threshold)


class NearDuplicates:
    """Near-duplicate search over ``texts(tab, id, text)``; ``id`` is unique within ``tab``, and only rows of one
    ``tab`` are compared.

    ``threshold`` is the least similarity: shared distinct runs of ``k`` words over those in either text, both in
    consistent form. Null, empty and shorter texts take no part. Records with the same words are one class,
    represented by the least id; only representatives are sketched into buckets and compared.

    * ``classes``: (tab, words_key, rep, copies); ``members``: (tab, id, rep).
    * ``links``: (tab, id_a, id_b, similarity) between representatives.
    * ``pairs()``: every pair of rows, classes spelt out. Its size is that of the result.
    * ``groups()``: one row a record with its group and its number of links.
    """

    def __init__(self, texts: DataFrame, threshold: float = 0.8, k: int = 5):
        self.texts = texts.filter("text <> '' and id is not null")
        sketch = SetSketch()
        sketches = cut(_sketches(self.texts.select("tab", "id", "text"), k, sketch))
        self.classes = sketches.groupBy("tab", "words_key").agg(F.min("id").alias("rep"), F.count("*").alias("copies"), F.min("regs").alias("regs"))
        self.classes = cut(self.classes)
        self.members = salted_join(sketches.select("tab", "id", "words_key"), self.classes.select("tab", "words_key", "rep"), ["tab", "words_key"], F.col("id")).select("tab", "id", "rep")
        reps = self.classes.select("tab", F.col("rep").alias("id"), F.col("regs").alias("signature"))
        least = threshold - SLACK * (threshold * (1 - threshold) / sketch.m) ** 0.5

        def likely(a: np.ndarray, b: np.ndarray) -> np.ndarray:
            out = (a == b).sum(1) >= 0.5 * least * sketch.m
            out[out] = sketch.jaccard(a[out], b[out]) >= least
            return out

        likely_pairs = cut(banded_pairs(reps, list(range(0, sketch.m + 1, ROWS_PER_BAND)), "uint16", likely))
        self.links = cut(_verified(likely_pairs, self.texts, k, threshold))

    def pairs(self) -> DataFrame:
        a = self.members.select("tab", F.col("rep").alias("id_a"), F.col("id").alias("x"))
        b = self.members.select("tab", F.col("rep").alias("id_b"), F.col("id").alias("y"))
        between = salted_join(a, self.links.select("tab", "id_a", "id_b"), ["tab", "id_a"], F.col("x"))
        between = grid_join(between, b, ["tab", "id_b"], F.col("x"), F.col("y"))
        several = self.classes.filter("copies > 1").select("tab", F.col("rep").alias("id_a"))
        same = salted_join(a, several, ["tab", "id_a"], F.col("x"), how="left_semi")
        within = grid_join(same, same.select("tab", "id_a", F.col("x").alias("y")), ["tab", "id_a"], F.col("x"), F.col("y")).filter("x < y")
        every = between.select("tab", "x", "y").union(within.select("tab", "x", "y"))
        return every.select("tab", F.least("x", "y").alias("id_a"), F.greatest("x", "y").alias("id_b"))

    def groups(self) -> DataFrame:
        """(tab, id, group_id, n_links) of every record that takes part; a group is named by its least id, and a
        record's links are the other records that it is alike to, exact copies included."""
        node = lambda c: F.concat_ws(":", "tab", F.lpad(F.col(c).cast("string"), 20, "0"))
        roots = components(self.links.select(node("id_a").alias("a"), node("id_b").alias("b")))
        copies = self.classes.select("tab", F.col("rep").alias("id"), "copies")
        both = self.links.select("tab", F.col("id_a").alias("rep"), F.col("id_b").alias("id")).union(self.links.select("tab", F.col("id_b").alias("rep"), F.col("id_a").alias("id")))
        near = salted_join(both, copies, ["tab", "id"], F.col("rep"), 4).groupBy("tab", "rep").agg(F.sum("copies").alias("near"))
        of = copies.withColumnRenamed("id", "rep").withColumn("node", node("rep")).join(roots.hint("merge"), "node", "left").join(near.hint("merge"), ["tab", "rep"], "left")
        group = F.coalesce(F.element_at(F.split("root", ":"), -1).cast("long"), F.col("rep"))
        of = of.select("tab", "rep", group.alias("group_id"), (F.col("copies") - 1 + F.coalesce("near", F.lit(0))).alias("n_links"))
        return salted_join(self.members, of, ["tab", "rep"], F.col("id")).select("tab", "id", "group_id", "n_links")
