"""Vector tables: identities, keyed upsert, exact search, and dropping of chunks that another file has already."""

from __future__ import annotations

from functools import reduce
from itertools import product

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import expressions as X
from ..session import cut

TOP_K = 5
QUERY_BLOCK_FLOATS = 8_000_000  # numbers of queries held by a task at once, 64 MB
ASKED = 512  # queries that are held against 2,048 vectors at once


def usable(embedding: Column, width: int) -> Column:
    """Whether an embedding has exactly ``width`` finite numbers that are not all zero; false for null."""
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    return F.coalesce((F.size(embedding) == width) & F.forall(embedding, finite) & F.exists(embedding, lambda x: x != 0), F.lit(False))


def vector_id(filename: Column, level: Column, section: Column, index: Column) -> Column:
    """The identity of a chunk's vector: the version 5 UUID of its place, whatever its text is."""
    empty = lambda c, d: F.coalesce(c.cast("string"), F.lit(d))
    return X.uuid5(F.concat_ws("|", empty(filename, ""), empty(level, "chunk"), empty(section, ""), empty(index, "")))


def latest(rows: DataFrame, id_: str, *order: Column) -> DataFrame:
    """One row an id: the last by ``order``, which should end in a unique column. Rows without id are left out."""
    fields = F.struct(*[o.alias(f"_o{i}") for i, o in enumerate(order)])
    cols = rows.columns
    best = rows.filter(F.col(id_).isNotNull()).groupBy(id_).agg(F.max_by(F.struct(*cols), fields).alias("_r"))
    return best.select(*[F.col("_r")[c].alias(c) for c in cols])


def upsert(stored: DataFrame, new: DataFrame, id_: str, replace_by: str | None = None) -> DataFrame:
    """``stored`` with the rows of ``new``: those with a known id replace it, others are added. With ``replace_by``,
    all stored rows of a file that ``new`` has rows of are removed first, so that none goes stale. Ids of ``new`` must
    be unique. A null ``replace_by`` removes nothing."""
    kept = stored.join(new.select(id_), id_, "left_anti")
    if replace_by:
        kept = kept.join(new.select(replace_by).filter(F.col(replace_by).isNotNull()).distinct(), replace_by, "left_anti")
    return kept.unionByName(new.select(stored.columns))


def cosine(a: Column, b: Column) -> Column:
    """The cosine of two arrays of one length; null for null, unequal lengths or a zero vector."""
    dot = lambda x, y: F.aggregate(F.zip_with(x, y, lambda p, q: p.cast("double") * q.cast("double")), F.lit(0.0), lambda s, v: s + v)
    return F.when(F.size(a) == F.size(b), F.try_divide(dot(a, b), F.sqrt(dot(a, a)) * F.sqrt(dot(b, b))))


def search(vectors: DataFrame, key: str, embedding: str, queries: DataFrame, query_key: str, query_embedding: str, k: int = TOP_K, width: int = 64, exclude_self: bool = False) -> DataFrame:
    """(query_key, rank, key, score): the ``k`` best of all vectors for each query, by cosine rounded to six decimals,
    ties to the smaller key.

    An exact search of a stated query set against all rows: the queries are read to the driver in blocks of bounded
    size, each block is held against every partition of vectors by matrix products, and only each partition's best
    are shuffled. Unusable vectors and queries (null, wrong width, not finite, all zero) take no part.
    """
    rows = vectors.select(F.col(key).cast("long").alias("v"), F.col(embedding).cast("array<double>").alias("e")).filter(usable(F.col("e"), width))
    asked = queries.select(F.col(query_key).cast("long").alias("q"), F.col(query_embedding).cast("array<double>").alias("e")).filter("q is not null").filter(usable(F.col("e"), width))
    step = max(1, QUERY_BLOCK_FLOATS // width)
    unit = lambda x: x / np.linalg.norm(x, axis=1, keepdims=True)

    def part(ids: np.ndarray, q: np.ndarray) -> DataFrame:
        def run(batches):
            best_s = np.full((len(ids), k), -np.inf)
            best_v = np.zeros((len(ids), k), np.int64)
            for b in batches:
                v, x = b.column(0).to_numpy(), unit(b.column(1).flatten().to_numpy(zero_copy_only=False).reshape(-1, width))
                for i, j in product(range(0, len(v), 2048), range(0, len(ids), ASKED)):
                    here = slice(j, j + ASKED)
                    s = np.round(q[here] @ x[i : i + 2048].T, 6)
                    own = np.broadcast_to(v[i : i + 2048], s.shape)
                    if exclude_self:
                        s = np.where(own == ids[here, None], -np.inf, s)
                    s, own = np.concatenate([best_s[here], s], 1), np.concatenate([best_v[here], own], 1)
                    order = np.lexsort((own, -s), axis=1)[:, :k]
                    best_s[here], best_v[here] = np.take_along_axis(s, order, 1), np.take_along_axis(own, order, 1)
            r, c = np.nonzero(np.isfinite(best_s))
            for i in range(0, len(r), 50_000):
                a, d = r[i : i + 50_000], c[i : i + 50_000]
                yield pa.RecordBatch.from_arrays([pa.array(ids[a]), pa.array(best_v[a, d]), pa.array(best_s[a, d])], names=["q", "v", "score"])

        return rows.mapInArrow(run, "q long, v long, score double")

    done: list[DataFrame] = []
    ids: list[int] = []
    vec: list[list[float]] = []
    for r in asked.orderBy("q").toLocalIterator():
        if len(ids) >= step:  # the results of all blocks but the last are written, so the driver holds one block
            done.append(cut(part(np.array(ids, np.int64), unit(np.array(vec, float)))))
            ids, vec = [], []
        ids.append(r.q), vec.append(r.e)
    last = part(np.array(ids, np.int64), unit(np.array(vec, float)) if vec else np.zeros((0, width)))
    out = reduce(DataFrame.union, [*done, last])
    rank = F.row_number().over(Window.partitionBy("q").orderBy(F.col("score").desc(), "v"))
    ranked = out.withColumn("rank", rank).filter(F.col("rank") <= k)
    return ranked.select(F.col("q").alias(query_key), "rank", F.col("v").alias(key), "score")


def similarity_of(score: Column, store: Column) -> Column:
    """A store's score as a similarity: cosine similarity itself, or one less a cosine distance; null for stores on
    another scale."""
    return F.when(store == "qdrant", score).when(store == "chroma", 1 - score)


def near_copies(nearest: DataFrame, stored: DataFrame, new: DataFrame, key: str, new_key: str, file: str, threshold: float) -> DataFrame:
    """The keys of new chunks whose single nearest stored vector, in ``nearest(new_key, rank, key, score)``, is from
    another, named file and at least ``threshold`` alike. If the nearest is of the same file, the chunk is kept,
    whatever comes next."""
    first = nearest.filter("rank = 1")
    met = first.join(stored.select(key, F.col(file).alias("_old")), key).join(new.select(F.col(new_key), F.col(file).alias("_new")), new_key)
    return met.filter((F.col("score") >= threshold) & (F.coalesce("_old", F.lit("")) != "") & ~F.col("_old").eqNullSafe(F.col("_new"))).select(new_key)
