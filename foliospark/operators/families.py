"""Document families: MinHash signatures over word shingles, similar pairs, connected families, canonical members."""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import expressions as X
from ..functions.words import words_of
from ..session import cut
from .bands import banded_pairs
from .components import components
from .joins import salted_join

PRIME = 2_147_483_647
SHINGLE, PERMUTATIONS, THRESHOLD = 5, 64, 0.95


def coefficients(n: int, seed: int = 0) -> list[tuple[int, int]]:
    """(a, b) of the n hash functions x -> (a x + b) mod PRIME, by a rule that SQL can follow too."""
    return [((1_103_515_245 * (2 * (i + seed) + 1) + 12_345) % (PRIME - 1) + 1, (69_069 * (i + seed + 1) + 362_437) % PRIME) for i in range(n)]


def shingles(df: DataFrame, key: str, text: str, k: int = SHINGLE) -> DataFrame:
    """(key, shingle): each distinct run of ``k`` words in lower case; all words as one if there are fewer; no row for
    a text without words or a null."""
    return df.select(key, F.explode(F.array_distinct(X.shingles(F.col(text), k))).alias("shingle"))


def signatures(df: DataFrame, key: str, text: str, k: int = SHINGLE, n: int = PERMUTATIONS, seed: int = 0, family: str = "linear") -> DataFrame:
    """(key, signature ARRAY<BIGINT>) of every row: the least hash of its shingles under each of n functions.

    Texts without words, empty ones and nulls have zeros throughout, so that they are alike at 1.0. ``family`` is
    ``linear`` (one 31-bit hash a shingle, from its MD5, then n linear functions, which SQL can follow) or ``murmur3``
    (MurmurHash3 x86 32 with the seeds from ``seed`` on, for signatures that equal other tools'). A document is a row,
    so its signature is made where the row is, without a shuffle.
    """
    if family not in ("linear", "murmur3"):
        raise ValueError(f"unknown hash family: {family}")
    kind = df.schema[key].dataType.simpleString()

    def run(batches):
        seeds = np.arange(seed, seed + n, dtype=np.uint64)
        a, b = (np.array(x, np.int64) for x in zip(*coefficients(n, seed)))
        for batch in batches:
            rows = []
            for t in batch.column(1).to_pylist():
                w = words_of(t)
                data = sorted({" ".join(w[i : i + k]).encode() for i in range(max(len(w) - k + 1, 1))}) if w else []
                least = np.full(n, 2**32, np.int64)
                for i in range(0, len(data), 5_000):
                    part = data[i : i + 5_000]
                    if family == "murmur3":
                        hashed = murmur3(part, seeds).astype(np.int64)
                    else:
                        x = np.array([int.from_bytes(hashlib.md5(s).digest()[:4], "big") % PRIME for s in part], np.int64)
                        hashed = (x[:, None] * a + b) % PRIME
                    least = np.minimum(least, hashed.min(0))
                rows.append(least if data else np.zeros(n, np.int64))
            flat = pa.array(np.concatenate(rows) if rows else np.zeros(0, np.int64))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.ListArray.from_arrays(pa.array(np.arange(len(rows) + 1, dtype=np.int32) * n), flat)], names=[key, "signature"])

    return df.select(key, F.col(text).alias("_t")).mapInArrow(run, f"`{key}` {kind}, signature array<long>")


def murmur3(words: list[bytes], seeds: np.ndarray) -> np.ndarray:
    """MurmurHash3 x86 32 of each byte string under each seed, unsigned; computed for all seeds at once."""
    c1, c2, five = np.uint32(0xCC9E2D51), np.uint32(0x1B873593), np.uint32(5)
    rotl = lambda x, r: (x << np.uint32(r)) | (x >> np.uint32(32 - r))
    out = np.empty((len(words), len(seeds)), np.uint32)
    by_length: dict[int, list[int]] = {}
    for i, w in enumerate(words):
        by_length.setdefault(len(w), []).append(i)
    for length, at in by_length.items():
        padded = -(-length // 4) * 4
        raw = np.frombuffer(b"".join(words[i].ljust(padded, b"\0") for i in at), "<u4").reshape(len(at), padded // 4).astype(np.uint32)
        h = np.broadcast_to(seeds.astype(np.uint32), (len(at), len(seeds))).copy()
        for j in range(padded // 4):
            k = rotl(raw[:, j] * c1, 15) * c2
            h ^= k[:, None]
            if (j + 1) * 4 <= length:
                h = rotl(h, 13) * five + np.uint32(0xE6546B64)
        h ^= np.uint32(length)
        for shift, mul in ((16, 0x85EBCA6B), (13, 0xC2B2AE35), (16, 1)):
            h = (h ^ (h >> np.uint32(shift))) * np.uint32(mul)
        out[at] = h
    return out


def matches(a: Column, b: Column) -> Column:
    """The number of equal places of two signatures."""
    return F.size(F.filter(F.zip_with(a, b, lambda x, y: x == y), lambda t: t))


def estimate(a: Column, b: Column) -> Column:
    """The share of equal places; 0 for empty signatures or unequal lengths, null for null."""
    return F.when((F.size(a) == F.size(b)) & (F.size(a) > 0), matches(a, b) / F.size(a)).when(a.isNotNull() & b.isNotNull(), F.lit(0.0))


class Families:
    """Families of rows whose signatures agree in at least ``threshold`` of their places, directly or through others.

    ``signed`` has (key BIGINT, signature), every signature of ``n`` places, and unique keys; null keys take no part.
    Rows with equal signatures are one class. A qualifying pair has at most ``n - need`` unequal places, so of
    ``n - need + 1`` bands it shares at least one whole: joining on bands loses no pair.

    * ``classes``: (rep, copies) and ``members``: (key, rep); ``links``: (rep_a, rep_b, matches) between classes.
    """

    def __init__(self, signed: DataFrame, key: str, threshold: float = THRESHOLD, n: int = PERMUTATIONS):
        need = next(k for k in range(n + 1) if k / n >= threshold)
        if need == 0:
            raise ValueError("the threshold must be above 0")
        self.key = key

        def packed(batches):
            for b in batches:
                raw = b.column(1).flatten().to_numpy(zero_copy_only=False).astype("<u4").reshape(b.num_rows, n)
                yield pa.RecordBatch.from_arrays([b.column(0), pa.array([r.tobytes() for r in raw], pa.binary())], names=["id", "signature"])

        rows = cut(signed.filter(F.col(key).isNotNull()).select(F.col(key).cast("long").alias("id"), "signature").mapInArrow(packed, "id long, signature binary"))
        self.classes = cut(rows.groupBy("signature").agg(F.min("id").alias("rep"), F.count("*").alias("copies")))
        self.members = salted_join(rows, self.classes.select("signature", "rep"), ["signature"], F.col("id")).select(F.col("id").alias(key), "rep")
        reps = self.classes.select(F.lit("").alias("tab"), F.col("rep").alias("id"), "signature")
        edges = np.linspace(0, n, n - need + 2).astype(int).tolist()
        pairs = banded_pairs(reps, edges, "uint32", lambda a, b: (a == b).sum(1) >= need)
        self.links = cut(pairs.select(F.col("id_a").alias("rep_a"), F.col("id_b").alias("rep_b"), F.col("score").alias("matches")))

    def membership(self) -> DataFrame:
        """(key, rep, n_links) of every row: its class, named by its least key, and with how many other rows it
        agrees, those of its own class included."""
        copies = self.classes.select("rep", "copies")
        ends = self.links.select(F.col("rep_a").alias("rep"), F.col("rep_b").alias("other")).union(self.links.select(F.col("rep_b").alias("rep"), F.col("rep_a").alias("other")))
        met = salted_join(ends, copies.withColumnRenamed("rep", "other"), ["other"], F.col("rep")).groupBy("rep").agg(F.sum("copies").alias("_n"))
        n = copies.join(met, "rep", "left").select("rep", (F.col("copies") - 1 + F.coalesce("_n", F.lit(0))).alias("n_links"))
        return salted_join(self.members, n, ["rep"], F.col(self.key)).select(self.key, "rep", "n_links")

    def families(self) -> DataFrame:
        """(key, family_id) of every row; a family is named by its least key, and a row alone is its own family."""
        roots = components(self.links.select(F.col("rep_a").alias("a"), F.col("rep_b").alias("b")))
        of = self.classes.select("rep").join(roots.withColumnRenamed("node", "rep"), "rep", "left").select("rep", F.coalesce("root", "rep").alias("family_id"))
        return salted_join(self.members, of, ["rep"], F.col(self.key)).select(self.key, "family_id")


def exact_similarity(pairs: DataFrame, texts: DataFrame, key: str, text: str, k: int = 5) -> DataFrame:
    """``pairs(rep_a, rep_b)`` with ``jaccard``: the share of their texts' runs of ``k`` words that both have, exactly, in
    six decimals. A null text has no runs; two texts without runs have 0."""
    sets = texts.select(F.col(key), F.array_distinct(F.coalesce(X.shingles(F.col(text), k), F.array().cast("array<string>"))).alias("_s"))
    wanted = pairs.select(F.col("rep_a").alias(key)).union(pairs.select("rep_b")).distinct()
    sets = sets.join(wanted, key, "left_semi")
    out = salted_join(pairs.select("rep_a", "rep_b"), sets.select(F.col(key).alias("rep_a"), F.col("_s").alias("_a")), ["rep_a"], F.col("rep_b"), 4)
    out = salted_join(out, sets.select(F.col(key).alias("rep_b"), F.col("_s").alias("_b")), ["rep_b"], F.col("rep_a"), 4)
    both = F.size(F.array_intersect("_a", "_b"))
    return out.select("rep_a", "rep_b", F.round(F.coalesce(F.try_divide(both, F.size("_a") + F.size("_b") - both), F.lit(0.0)), 6).alias("jaccard"))


def canonical(families: DataFrame, documents: DataFrame, key: str, text: str) -> DataFrame:
    """(family_id, canonical, members): the longest text's row; of equal lengths, the one with the largest key. A null
    text has length 0."""
    sized = families.join(documents.select(key, F.coalesce(F.length(text), F.lit(0)).alias("_n")), key)
    return sized.groupBy("family_id").agg(F.max(F.struct("_n", key)).getField(key).alias("canonical"), F.count("*").alias("members"))


def roles(families: DataFrame, canonicals: DataFrame, key: str) -> DataFrame:
    """(key, family_uuid, role) of the rows of families with several members: canonical or variant; the UUID is the
    version 5 one of the canonical's name in the URL namespace."""
    several = canonicals.filter("members > 1").withColumnRenamed("members", "_m")
    out = salted_join(families, several, ["family_id"], F.col(key))
    role = F.when(F.col(key) == F.col("canonical"), "canonical").otherwise("variant")
    return out.select(key, X.uuid5(F.col("canonical").cast("string")).alias("family_uuid"), role.alias("role"))


def superseded(documents: DataFrame, roles_: DataFrame, key: str) -> DataFrame:
    """``documents`` with ``status``, in place of one it may have: superseded for variants, else current."""
    mark = X.fresh(documents.columns, "_s")
    variant = roles_.filter("role = 'variant'").select(key, F.lit("superseded").alias(mark))
    return documents.join(variant, key, "left").withColumn("status", F.coalesce(mark, F.lit("current"))).drop(mark)


def family_report(canonicals: DataFrame) -> DataFrame:
    """(families, singletons, rows): families of several members, rows alone, and all rows."""
    return canonicals.agg(F.count_if(F.col("members") > 1).alias("families"), F.count_if(F.col("members") == 1).alias("singletons"), F.coalesce(F.sum("members"), F.lit(0)).alias("rows"))
