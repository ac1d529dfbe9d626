"""Pairs of records that share a band of their signature, compared in blocks of bounded size.

A signature is a row of ``m`` unsigned numbers stored as binary. Bands are given by their edges. All records with the
same numbers in a band form a bucket; a bucket of many members is cut into blocks, every pair of blocks meets in one
group of bounded size, and a pair is looked at in the first band that it shares and nowhere else. So a bucket with a
third of all records is spread over many tasks, and only pairs that pass the test are ever written.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut
from .joins import salted_join

BLOCK = 512  # members of one bucket that are compared in one place

Test = Callable[[np.ndarray, np.ndarray], np.ndarray]


def _key(part: bytes, band: int, tab: str) -> int:
    return xxhash.xxh3_64_intdigest(part, band + (len(tab) << 16) + (xxhash.xxh32_intdigest(tab) << 24)) - 2**63


def _buckets(reps: DataFrame, edges: list[int], width: int) -> DataFrame:
    """(bucket, tab, id) for each band of each record."""

    def run(batches):
        bands = list(zip(edges, edges[1:]))
        for b in batches:
            n = b.num_rows
            keys = [_key(r[s * width : e * width], j, t) for t, r in zip(b.column(0).to_pylist(), b.column(2).to_pylist()) for j, (s, e) in enumerate(bands)]
            at = pa.array(np.repeat(np.arange(n), len(bands)))
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), b.column(0).take(at), b.column(1).take(at)], names=["bucket", "tab", "id"])

    return reps.select("tab", "id", "signature").mapInArrow(run, "bucket long, tab string, id long")


def _row_pairs(starts: np.ndarray, side: np.ndarray):
    """Row numbers of the pairs within all groups, in pieces of a bounded size."""
    size = np.diff(starts)
    some_a, some_b, held = [], [], 0
    for s in np.unique(size[size > 1]):
        at = starts[:-1][size == s]
        x, y = np.triu_indices(s, 1)
        step = max(1, 400_000 // len(x))
        for g in range(0, len(at), step):
            a, b = (at[g : g + step, None] + x).ravel(), (at[g : g + step, None] + y).ravel()
            ok = (side[a] + side[b]) % 3 == 0  # two rows of one block, or one each of two; see where sides are made
            some_a.append(a[ok]), some_b.append(b[ok])
            held += int(ok.sum())
            if held >= 200_000:
                yield np.concatenate(some_a), np.concatenate(some_b)
                some_a, some_b, held = [], [], 0
    if held:
        yield np.concatenate(some_a), np.concatenate(some_b)


def _group_edges(t: pa.Table) -> np.ndarray:
    key = [t.column(c).to_numpy() for c in ("bucket", "i", "j")]
    change = np.flatnonzero(np.any([k[1:] != k[:-1] for k in key], axis=0)) + 1
    return np.concatenate([[0], change, [t.num_rows]])


def _compared(t: pa.Table, edges: list[int], dtype: np.dtype, test: Test, score: Test):
    n, m = t.num_rows, edges[-1]
    bucket = t.column("bucket").to_numpy()
    rows = np.frombuffer(b"".join(t.column("signature").to_pylist()), dtype).reshape(n, m)
    ids, side, tabs = t.column("id").to_numpy(), t.column("side").to_numpy(), np.array(t.column("tab").to_pylist(), object)
    for a, b in _row_pairs(_group_edges(t), side):
        same = rows[a] == rows[b]
        shared = np.logical_and.reduceat(same, edges[:-1], axis=1)
        first = shared.argmax(1)
        good = test(rows[a], rows[b])
        a, b, first = a[good], b[good], first[good]
        keys = [_key(rows[x, edges[f] : edges[f + 1]].tobytes(), int(f), tabs[x]) for x, f in zip(a, first)]
        here = np.array(keys, np.int64) == bucket[a]
        a, b = a[here], b[here]
        if len(a):
            value = pa.array(score(rows[a], rows[b]).astype(np.int32))
            yield pa.RecordBatch.from_arrays([pa.array(tabs[a], pa.string()), pa.array(np.minimum(ids[a], ids[b])), pa.array(np.maximum(ids[a], ids[b])), value], names=["tab", "id_a", "id_b", "score"])


def equal_places(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return (a == b).sum(1)


def banded_pairs(reps: DataFrame, edges: list[int], dtype: str, test: Test, score: Test = equal_places) -> DataFrame:
    """(tab, id_a, id_b, score) of the pairs of ``reps(tab, id, signature)`` that share a band and pass ``test``.

    ``test`` gets the signatures of both sides as two matrices and returns which pairs pass, ``score`` a whole number for
    each pair that did, so that no signature has to be fetched again. Ids are unique within a
    ``tab``, and only records of one ``tab`` are compared. Each pair comes out once.
    """
    kind = np.dtype(dtype)
    buckets = cut(_buckets(reps, edges, kind.itemsize))
    sizes = buckets.groupBy("bucket").agg(F.count("*").alias("n")).filter("n > 1")
    shared = salted_join(buckets, sizes, ["bucket"], F.col("id"), 4)
    blocks = F.ceil(F.col("n") / BLOCK).cast("int")
    shared = shared.withColumn("blocks", blocks).withColumn("block", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int"))
    shared = shared.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    side = F.when(F.col("block") == F.col("other"), 0).when(F.col("block") < F.col("other"), 1).otherwise(2)
    shared = shared.select("bucket", "tab", "id", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), side.alias("side"))
    shared = shared.join(reps.select("tab", "id", "signature").hint("merge"), ["tab", "id"])
    shared = shared.repartition("bucket", "i", "j").sortWithinPartitions("bucket", "i", "j")

    def run(batches):
        rest = None
        for b in batches:
            t = pa.Table.from_batches([b])
            if rest is not None:
                t = pa.concat_tables([rest, t])
            ends = _group_edges(t)
            if t.num_rows < 4 * BLOCK or len(ends) < 3:
                rest = t
                continue
            rest = t.slice(int(ends[-2]))
            yield from _compared(t.slice(0, int(ends[-2])).combine_chunks(), edges, kind, test, score)
        if rest is not None and rest.num_rows:
            yield from _compared(rest.combine_chunks(), edges, kind, test, score)

    return shared.mapInArrow(run, "tab string, id_a long, id_b long, score int")
