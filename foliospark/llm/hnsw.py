"""Problem 2: the most similar vectors for every vector.

Vectors are routed to shards by coarse centroids. Each shard is a hierarchical navigable small-world graph whose layers are
flat arrays of neighbours. A vector asks the graphs of all shards whose centroid is nearly as similar to it as the nearest
one is, and the shards' results are merged.

Queries walk a graph in groups that start close together: what one of them reaches is scored for all of them by one
matrix product. What the walk finds is computed again in double precision; where its list may be too short for all that
ties with the last neighbour at six decimals, the query is held against the whole shard instead.

Vectors that are equal bit by bit are one class, of which only one is indexed, with the least ids of the class.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..operators.joins import salted_join
from ..session import cut

M = 10  # links that a row makes when it is inserted; the lowest layer keeps twice as many
EF_BUILD, EF_SEARCH = 24, 16
TOP = 1024  # rows of the highest layer, at most; a search begins with all of them
GROUP = 64  # queries that walk together
INSERT = 4096  # rows that are inserted together
SHARD, SHARDS, LARGEST = 16_384, 32, 1_000_000  # rows of a shard are a table's by SHARDS, but within these bounds
GAP = 0.2  # a shard is asked if its centroid's cosine is at most that below the nearest centroid's; see also _fewest
SAMPLE = 20_000  # vectors that the centroids are fitted on, or eight for each centroid if that is more
SLACK = 5e-6  # by which a float32 score may be too small, for errors of the product and the width of the rounding
SCAN = 512  # queries that are held against a whole shard together


def _greatest(s: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Places and values of the ``k`` greatest of each row, greatest first."""
    n = s.shape[1]
    at = np.argpartition(s, n - k, axis=1)[:, n - k :] if n > k else np.broadcast_to(np.arange(n), s.shape)
    value = np.take_along_axis(s, at, 1)
    order = np.argsort(-value, axis=1, kind="stable")
    return np.take_along_axis(at, order, 1), np.take_along_axis(value, order, 1)


class Hnsw:
    """Graph over the rows of a float32 matrix of unit vectors; similarity is the inner product.

    Rows are put in a random order once, and a layer is the first rows of it: layer 0 all, each higher one the ``m``-th
    part, down to at most ``TOP``. ``near[layer]`` has the neighbours of each row, -1 where there are fewer.
    """

    def __init__(self, x: np.ndarray, m: int = M, ef: int = EF_BUILD, seed: int = 11):
        n = len(x)
        self.m, self.ef = m, ef
        self.order = np.random.default_rng(seed).permutation(n)
        self.x = np.ascontiguousarray(x[self.order], np.float32)
        self.sizes = [n]
        while self.sizes[-1] > TOP:
            self.sizes.append(-(-self.sizes[-1] // m))
        self.near: list[np.ndarray] = [np.zeros((0, 0), np.int32)] * (len(self.sizes) - 1)
        # Marks by row that each walk clears again; the last place takes what is no row.
        self._mark, self._seen, self._open = (np.zeros(n + 1, bool) for _ in range(3))
        for layer in range(len(self.sizes) - 2, -1, -1):
            self.near[layer] = np.full((self.sizes[layer], m if layer else 2 * m), -1, np.int32)
            done = 0
            while done < self.sizes[layer]:
                end = min(self.sizes[layer], done + INSERT if done else max(INSERT, self.sizes[layer + 1]))
                self._insert(layer, done, end)
                done = end

    def _insert(self, layer: int, start: int, end: int) -> None:
        """Links rows to what the layer has, by searching it, and to each other, by products."""
        q, near = self.x[start:end], self.near[layer]
        ids, sim = self._find(q, layer, self.ef) if start else (np.zeros((len(q), 0), np.int32), np.zeros((len(q), 0), np.float32))
        for i in range(0, len(q), SCAN):
            s = q[i : i + SCAN] @ q.T
            s[np.arange(len(s)), np.arange(i, i + len(s))] = -np.inf
            at, value = _greatest(s, self.ef)
            all_ids = np.concatenate([ids[i : i + SCAN], (at + start).astype(np.int32)], 1)
            at, value = _greatest(np.concatenate([sim[i : i + SCAN], value], 1), self.ef)
            all_ids = np.where(np.isfinite(value), np.take_along_axis(all_ids, at, 1), -1)
            near[start + i : start + i + len(s), : self.m] = self._choose(all_ids, value, self.m)
        self._link_back(near, start, end)

    def _link_back(self, near: np.ndarray, start: int, end: int) -> None:
        """Adds the links of the rows from ``start`` on in the other direction; overfull rows choose again."""
        width, to = near.shape[1], near[start:end, : self.m].ravel()
        source = np.repeat(np.arange(start, end, dtype=np.int32), self.m)[to >= 0]
        to = to[to >= 0]
        order = np.argsort(to, kind="stable")
        source, to = source[order], to[order]
        rows, first, count = np.unique(to, return_index=True, return_counts=True)
        place = np.arange(len(to)) - np.repeat(first, count)
        for i in range(0, len(rows), 1024):
            row, n = rows[i : i + 1024], count[i : i + 1024]
            links = slice(first[i], first[i] + n.sum())
            new = np.full((len(row), n.max()), -1, np.int32)
            new[np.repeat(np.arange(len(row)), n), place[links]] = source[links]
            new[(new[:, :, None] == near[row][:, None, :]).any(2)] = -1
            ids = np.concatenate([near[row], new], 1)
            s = np.matmul(self.x[np.maximum(ids, 0)], self.x[row][:, :, None])[:, :, 0]
            s[ids < 0] = -np.inf
            at, s = _greatest(s, min(width + self.ef, ids.shape[1]))
            ids = np.where(np.isfinite(s), np.take_along_axis(ids, at, 1), -1)
            full = (ids >= 0).sum(1) > width
            near[row[~full]] = ids[~full][:, :width]
            if full.any():
                near[row[full]] = self._choose(ids[full], s[full], width)

    def _choose(self, ids: np.ndarray, sim: np.ndarray, width: int) -> np.ndarray:
        """The neighbours kept of candidates sorted best first: one that is nearer to a kept one than to the row
        itself is left for the places that stay free."""
        n, c = ids.shape
        vec = self.x[np.maximum(ids, 0)]
        among = np.matmul(vec, vec.transpose(0, 2, 1))
        real, kept = ids >= 0, np.zeros((n, c), bool)
        nearest, count = np.full((n, c), -np.inf, np.float32), np.zeros(n, int)
        for i in range(c):
            take = real[:, i] & (nearest[:, i] <= sim[:, i]) & (count < width)
            kept[:, i] = take
            count += take
            np.maximum(nearest, np.where(take[:, None], among[:, i, :], -np.inf), out=nearest)
        rank = np.where(kept, 0, c) + np.arange(c) + np.where(real, 0, 4 * c)
        order = np.argsort(rank, axis=1, kind="stable")[:, :width]
        out = np.take_along_axis(np.where(real, ids, -1), order, 1)
        return np.pad(out, ((0, 0), (0, width - out.shape[1])), constant_values=-1)

    def _find(self, q: np.ndarray, layer: int, ef: int) -> tuple[np.ndarray, np.ndarray]:
        """For each query the ``ef`` best rows that the walk down to ``layer`` finds, -1 where there are fewer."""
        top = len(self.sizes) - 1
        ids, sim = np.empty((len(q), ef), np.int32), np.empty((len(q), ef), np.float32)
        s = q @ self.x[: self.sizes[top]].T
        enter, _ = _greatest(s, min(4, s.shape[1]))
        order = np.lexsort((enter[:, 0], s[:, :32].argmax(1)))  # those that start close together are neighbours
        for i in range(0, len(q), GROUP):
            group = order[i : i + GROUP]
            start = enter[group]
            for at in range(top - 1, layer, -1):
                start = np.maximum(self._walk(q[group], start, at, 4)[0], 0)
            ids[group], sim[group] = self._walk(q[group], start, layer, ef)
        return ids, sim

    def _walk(self, q: np.ndarray, start: np.ndarray, layer: int, ef: int) -> tuple[np.ndarray, np.ndarray]:
        """One beam search for a group of queries: the rows in any query's list are opened, and their neighbours
        scored for every query, until no list has a row that isn't open."""
        near, n = self.near[layer], self.sizes[layer]
        mark, seen, open_ = self._mark, self._seen, self._open
        ids, sim = np.full((len(q), ef), n, np.int64), np.full((len(q), ef), -np.inf, np.float32)
        own, trail, opened = np.arange(len(q)), [], []
        new = np.unique(start)
        while len(new):
            seen[new] = True
            trail.append(new)
            s = q @ self.x[new].T
            some = np.flatnonzero((s > sim[:, -1:]).any(0))
            if len(some):
                both = np.concatenate([sim, s[:, some]], 1)
                at = np.argpartition(both, len(some), axis=1)[:, len(some) :]
                sim = np.take_along_axis(both, at, 1)
                ids = np.where(at < ef, np.take_along_axis(ids, np.minimum(at, ef - 1), 1), new[some][np.maximum(at - ef, 0)])
                least = sim.argmin(1)  # goes last, where the next round finds it
                for a in (ids, sim):
                    a[own, least], a[:, -1] = a[:, -1].copy(), a[own, least]
            mark[ids] = True
            next_ = np.flatnonzero(mark[:n] & ~open_[:n])
            mark[ids] = False
            if not len(next_):
                break
            open_[next_] = True
            opened.append(next_)
            to = near[next_]
            mark[to] = True
            new = np.flatnonzero(mark[:n] & ~seen[:n])
            mark[to] = False
        for marks, rows in ((seen, trail), (open_, opened)):
            for r in rows:
                marks[r] = False
        order = np.argsort(-sim, axis=1, kind="stable")
        ids, sim = np.take_along_axis(ids, order, 1), np.take_along_axis(sim, order, 1)
        return np.where(np.isfinite(sim), ids, -1).astype(np.int32), sim

    def search(self, q: np.ndarray, k: int, ef: int = EF_SEARCH) -> tuple[np.ndarray, np.ndarray]:
        """The ``k`` best rows for each query: their numbers, -1 where there are fewer, and scores."""
        q = np.ascontiguousarray(q, np.float32)
        ids, sim = np.full((len(q), k), -1, np.int64), np.full((len(q), k), -np.inf, np.float32)
        if not len(self.x) or not len(q):
            return ids, sim
        if len(self.sizes) > 1:
            at, s = self._find(q, 0, max(ef, k))
        else:  # the top layer is all there is
            at, s = _greatest(q @ self.x.T, min(k, len(self.x)))
        at, s = at[:, :k], s[:, :k]
        ids[:, : at.shape[1]], sim[:, : at.shape[1]] = np.where(at >= 0, self.order[at], -1), s
        return ids, sim


class Shard:
    """The vectors of one shard with their graph; ``ids`` has the least ids of each vector's class."""

    def __init__(self, raw: np.ndarray, ids: pa.ListArray):
        self.raw, self.size = raw, _lengths(raw)
        self.starts = ids.offsets.to_numpy().astype(np.int64)
        self.ids = ids.values.to_numpy()
        self.unit = _unit(raw, self.size)
        self.graph = Hnsw(self.unit)

    def nearest(self, q: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(row of q, id, similarity in millionths): the ``k`` best ids for each query, by similarity and then id."""
        size = _lengths(q)
        unit, n = _unit(q, size), len(self.raw)
        width = min(max(EF_SEARCH, k), n)
        at, s = self.graph.search(unit, width)
        least = s[:, min(k, width) - 1] - np.float32(SLACK)
        # A list whose last row may still tie, or that isn't full, doesn't tell all: the whole shard is looked at.
        short = np.flatnonzero((s[:, -1] >= least) | ~np.isfinite(s[:, -1])) if n > width else np.zeros(0, np.int64)
        good = s >= least[:, None]
        good[short] = False
        r, c = np.nonzero(good)
        rows, columns = [r], [at[r, c]]
        for i in range(0, len(short), SCAN):
            part = short[i : i + SCAN]
            s = unit[part] @ self.unit.T
            r, c = np.nonzero(s >= np.partition(s, n - k, axis=1)[:, n - k, None] - np.float32(SLACK))
            rows.append(part[r]), columns.append(c)
        r, c = np.concatenate(rows), np.concatenate(columns)
        micro = np.zeros(len(r), np.int64)
        for i in range(0, len(r), 50_000):
            a, b = r[i : i + 50_000], c[i : i + 50_000]
            cosine = np.einsum("nd,nd->n", q[a].astype(np.float64) / size[a], self.raw[b].astype(np.float64) / self.size[b])
            micro[i : i + 50_000] = np.rint(cosine * 1e6)
        # A class counts with each of its ids.
        n_ids = np.diff(self.starts)[c]
        first = np.repeat(self.starts[c] - np.concatenate([[0], np.cumsum(n_ids)[:-1]]), n_ids) if len(c) else np.zeros(0, np.int64)
        r, micro, ids = np.repeat(r, n_ids), np.repeat(micro, n_ids), self.ids[first + np.arange(n_ids.sum())]
        order = np.lexsort((ids, -micro, r))
        r, micro, ids = r[order], micro[order], ids[order]
        best = np.arange(len(r)) - np.searchsorted(r, r) < k
        return r[best], ids[best], micro[best]


def _lengths(raw: np.ndarray) -> np.ndarray:
    """Lengths of the rows in double precision; a float32 can't overflow in it."""
    return np.sqrt(np.einsum("nd,nd->n", raw, raw, dtype=np.float64))[:, None]


def _unit(raw: np.ndarray, size: np.ndarray) -> np.ndarray:
    return (raw / size).astype(np.float32)


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.float32).reshape(-1, width)


def _usable(vectors: DataFrame, key: str, embedding: str, width: int, with_vector: bool) -> DataFrame:
    """(id, digest[, vector]) of the usable rows; a vector is its float32 numbers as bytes."""

    def run(batches):
        for b in batches:
            ids, lists = b.column(0), b.column(1)
            fit = np.flatnonzero(lists.value_lengths().fill_null(-1).to_numpy() == width)
            ids, lists = ids.take(pa.array(fit)), lists.take(pa.array(fit))
            x = lists.flatten().to_numpy(zero_copy_only=False).astype(np.float32).reshape(-1, width) + np.float32(0)  # -0.0 becomes 0.0
            good = np.flatnonzero(np.isfinite(x).all(1) & (x != 0).any(1))
            rows = [r.tobytes() for r in x[good]]
            out = [ids.take(pa.array(good)), pa.array([xxhash.xxh3_128_digest(r) for r in rows], pa.binary())]
            yield pa.RecordBatch.from_arrays([*out, pa.array(rows, pa.binary())] if with_vector else out, names=["id", "digest", "vector"][: 2 + with_vector])

    rows = vectors.select(F.col(key).cast("long").alias("id"), F.col(embedding).cast("array<float>").alias("vector")).filter("id is not null and vector is not null")
    return rows.mapInArrow(run, "id long, digest binary" + (", vector binary" if with_vector else ""))


def _centroids(classes: DataFrame, n: int, width: int, shard: int, seed: int = 5) -> np.ndarray:
    """Unit centroids by spherical k-means over a sample: the classes whose hash falls into the share that about
    SAMPLE of them have, or eight for each centroid. It is the same sample every time."""
    k = -(-n // shard)
    if k <= 1:
        return np.zeros((1, width), np.float32)
    share = int(min(1.0, max(SAMPLE, 8 * k) / n) * 1e9) + 1
    rows = classes.filter(F.pmod(F.xxhash64("class"), F.lit(1_000_000_000)) < share).select("class", "vector").toArrow().sort_by("class")
    raw = _matrix(rows.column(1).combine_chunks(), width)
    x = _unit(raw, _lengths(raw))
    c = x[np.random.default_rng(seed).choice(len(x), min(k, len(x)), replace=False)]
    for _ in range(12):
        at = np.concatenate([(x[i : i + 4096] @ c.T).argmax(1) for i in range(0, len(x), 4096)])
        sums = np.zeros_like(c)
        np.add.at(sums, at, x)
        size = np.linalg.norm(sums, axis=1, keepdims=True)
        c = np.where(size > 0, sums / np.where(size > 0, size, 1), c)
    return c


def _fewest(shards: int) -> int:
    """How many shards each vector asks at least: twice the root of their number less three."""
    return int(np.clip(np.ceil(2 * np.sqrt(shards)) - 3, 1, shards))


def neighbours(vectors: DataFrame, key: str, embedding: str, k: int = 5, width: int = 64) -> DataFrame:
    """(key, neighbour, rank, similarity): the ``k`` most similar other vectors of each usable vector.

    Similarity is the cosine rounded to six decimals; of equal similarities the smaller key comes first. Only
    embeddings of ``width`` finite numbers, not all zero, take part. Every key counts by itself, repeated embeddings
    included; keys must be unique and rows without one are left out. Fewer than ``k`` rows come out where there are
    fewer other vectors. Other columns don't matter, and an empty table gives an empty one. Which shards are asked and
    what a walk finds in them is approximate: recall against brute force is measured in the tests and README.
    """
    most = k + 1  # a vector finds itself
    rows = _usable(vectors, key, embedding, width, True)
    few = rows.withColumn("n", F.row_number().over(Window.partitionBy("digest").orderBy("id"))).filter(F.col("n") <= most)
    classes = few.groupBy("digest").agg(F.sort_array(F.collect_list("id")).alias("ids"), F.first("vector").alias("vector"))
    classes = cut(classes.select(F.col("ids")[0].alias("class"), "ids", "vector", "digest"))
    n = classes.count()
    shard = int(np.clip(n // SHARDS, SHARD, max(SHARD, LARGEST)))
    centroids = _centroids(classes, n, width, shard)

    def scored(column: pa.Array):
        raw = _matrix(column, width)
        for i in range(0, len(raw), 2048):
            yield _unit(raw[i : i + 2048], _lengths(raw[i : i + 2048])) @ centroids.T

    def own(batches):
        for b in batches:
            count = np.zeros(len(centroids), np.int64)
            for s in scored(b.column(0)):
                count += np.bincount(s.argmax(1), minlength=len(centroids))
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(count), dtype=np.int32)), pa.array(count)], names=["shard", "n"])

    # A shard that outgrew its size is cut into parts; a query asks all parts of a shard.
    sizes = {r.shard: r.n for r in classes.select("vector").mapInArrow(own, "shard int, n long").groupBy("shard").agg(F.sum("n").alias("n")).collect()}
    parts = np.array([-(-max(sizes.get(i, 0), 1) // (2 * shard)) for i in range(len(centroids))])
    first = np.concatenate([[0], np.cumsum(parts)])
    fewest = _fewest(len(centroids))

    def route(batches):
        for b in batches:
            done = 0
            mix = xxhash.xxh3_64_intdigest
            for s in scored(b.column(2)):
                near = np.minimum(s.max(1, keepdims=True) - np.float32(GAP), np.partition(s, -fewest, axis=1)[:, -fewest, None])
                r, c = np.nonzero(s >= near)
                home, at = s.argmax(1), np.arange(done, done + len(s))
                part = np.array([mix(x.to_bytes(8, "little", signed=True)) % int(p) if p > 1 else 0 for x, p in zip(b.column(0)[done : done + len(s)].to_pylist(), parts[home])], np.int64)
                r, g = np.repeat(r, parts[c]), np.concatenate([np.arange(first[i], first[i + 1]) for i in c])
                other = g != (first[home] + part)[r]
                r, g = np.concatenate([at, at[r[other]]]), np.concatenate([first[home] + part, g[other]])
                asks = np.arange(len(r)) >= len(s)
                take = pa.array(r)
                ids = pa.array([None if a else i for a, i in zip(asks.tolist(), b.column(1).take(take).to_pylist())], pa.list_(pa.int64()))
                yield pa.RecordBatch.from_arrays([pa.array(g.astype(np.int32)), pa.array(asks), b.column(0).take(take), ids, b.column(2).take(take)], names=["shard", "asks", "class", "ids", "vector"])
                done += len(s)

    routed = classes.select("class", "ids", "vector").mapInArrow(route, "shard int, asks boolean, class long, ids array<long>, vector binary")
    sharded = routed.repartitionById(int(first[-1]), F.col("shard")).sortWithinPartitions("asks")

    def search(batches: Iterator[pa.RecordBatch]):
        """A partition is one shard: first come the rows to index, then those that only ask."""
        held, index = [], None

        def answers(classes: np.ndarray, q: np.ndarray):
            for i in range(0, len(q), 4096):
                r, ids, micro = index.nearest(q[i : i + 4096], most)
                ends = np.searchsorted(r, np.arange(len(q[i : i + 4096]) + 1)).astype(np.int32)
                lists = [pa.ListArray.from_arrays(pa.array(ends), pa.array(x)) for x in (ids, -micro)]
                yield pa.RecordBatch.from_arrays([pa.array(classes[i : i + 4096]), *lists], names=["class", "near", "far"])

        def build():
            t = pa.Table.from_batches(held).combine_chunks()
            x = _matrix(t.column("vector"), width)
            ids = t.column("ids").combine_chunks() if t.num_rows else pa.array([], pa.list_(pa.int64()))
            return t.column("class").to_numpy(), x, Shard(x, ids if isinstance(ids, pa.ListArray) else ids.chunk(0))

        for b in batches:
            asks = b.column(1).to_numpy(zero_copy_only=False)
            split = int(len(asks) - asks.sum())
            if split:
                held.append(b.slice(0, split))
            if split < len(asks):
                if index is None:
                    own_classes, own_vectors, index = build()
                    yield from answers(own_classes, own_vectors)
                rest = b.slice(split)
                yield from answers(rest.column(2).to_numpy(), _matrix(rest.column(4), width))
        if index is None and held:
            own_classes, own_vectors, index = build()
            yield from answers(own_classes, own_vectors)

    found = sharded.mapInArrow(search, "class long, near array<long>, far array<long>")
    pair = F.arrays_zip(F.col("far"), F.col("near"))
    merged = found.groupBy("class").agg(F.flatten(F.collect_list(pair)).alias("all"))
    lists = cut(merged.select("class", F.slice(F.sort_array("all"), 1, most).alias("best")))
    # A class of one vector has its id. The others' vectors find their class by its digest.
    several = classes.filter(F.size("ids") > 1).select("class", "digest")
    members = salted_join(_usable(vectors, key, embedding, width, False), several, ["digest"], F.col("id")).select("class", "id")
    copies = salted_join(members, lists.join(several.select("class").hint("merge"), "class", "left_semi"), ["class"], F.col("id")).select("id", "best")
    single = lists.join(several.select("class").hint("merge"), "class", "left_anti").select(F.col("class").alias("id"), "best")
    out = single.union(copies)
    best = F.slice(F.filter("best", lambda p: p["near"] != F.col("id")), 1, k)
    out = out.select("id", F.posexplode(best).alias("rank", "p"))
    return out.select(F.col("id").alias(key), F.col("p.near").alias("neighbour"), (F.col("rank") + 1).alias("rank"), (-F.col("p.far") / 1e6).alias("similarity"))


def similar_pairs(vectors: DataFrame, key: str, embedding: str, least: float, k: int = 5, width: int = 64) -> DataFrame:
    """(vec_a, vec_b) of which at least one is among the ``k`` most similar of the other, the similarity at least
    ``least``; the smaller key comes first and each pair once."""
    near = neighbours(vectors, key, embedding, k, width).filter(F.col("similarity") >= least)
    return near.select(F.least(key, "neighbour").alias("vec_a"), F.greatest(key, "neighbour").alias("vec_b")).distinct()
