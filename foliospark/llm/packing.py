"""Problem 6: filling containers of fixed capacity with texts.

Only sizes matter, and a size is at most the capacity, so the instance is a histogram of at most ``capacity`` numbers
whatever the number of texts. The plan is made on it: the Martello-Toth dominance reduction fixes small sets that
some optimal packing contains, and best-fit decreasing packs what is left. Every step handles all texts of a size at
once, as a run of containers. Texts then find their containers by size and rank within it; the ranks come from
counts over salted groups, so no size's texts are ever gathered in one place.
"""

from __future__ import annotations

from bisect import bisect_right, insort

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..operators.joins import salted_join
from ..session import cut
from .tokens import TOKENIZER, tokenizer

PER_SALT = 100_000  # texts of one size that are ranked in one task, about


class Plan:
    """Runs of containers for a histogram of sizes.

    A row (size, first, n, per, box) puts the texts of that size ranked ``first`` to ``first + n - 1`` into the
    containers from ``box`` on, ``per`` into each.
    """

    def __init__(self, counts: dict[int, int], capacity: int):
        if any(not 0 < s <= capacity for s in counts):
            raise ValueError("sizes lie between 1 and the capacity")
        self.capacity, self.left = capacity, {s: n for s, n in counts.items() if n > 0}
        self.used = dict.fromkeys(self.left, 0)
        self.sizes = sorted(self.left)
        self.rows: list[tuple[int, int, int, int, int]] = []
        self.boxes = 0
        self.reduced = self._reduce()
        self._best_fit()

    def _take(self, size: int, n: int, per: int, box: int) -> None:
        self.rows.append((size, self.used[size], n, per, box))
        self.used[size] += n
        self.left[size] -= n
        if not self.left[size]:
            del self.left[size]
            self.sizes.remove(size)

    def _fix(self, parts: list[int]) -> None:
        """Fixes containers with these sizes, as many as there are texts for."""
        need = {s: parts.count(s) for s in parts}
        times = min(self.left[s] // n for s, n in need.items())
        for s, n in need.items():
            self._take(s, n * times, n, self.boxes)
        self.boxes += times

    def _largest(self, most: int, without: int | None = None) -> int | None:
        """The largest size up to ``most`` of a text other than one of size ``without``."""
        at = bisect_right(self.sizes, most) - 1
        if at >= 0 and self.sizes[at] == without and self.left[without] < 2:
            at -= 1
        return self.sizes[at] if at >= 0 else None

    def _smallest(self, n: int, without: int) -> list[int]:
        out: list[int] = []
        for s in self.sizes:
            out += [s] * min(n, self.left[s] - (s == without))
            if len(out) >= n:
                break
        return out[:n]

    def _dominating(self, size: int) -> list[int] | None:
        """The set with the largest text that Martello and Toth's criteria prove to dominate all others, if any."""
        room = self.capacity - size
        small = np.cumsum(self._smallest(3, size))
        fit = int((small <= room).sum())
        if fit == 0:
            return [size]
        best = self._largest(room, size)
        if fit == 1 or best == room:
            return [size, best]
        if fit > 2:
            return None
        pair = self._best_pair(room, size)
        if pair is None or best >= sum(pair):
            return [size, best]
        if best == pair[0] and self._next_two(pair[1], size) > room:
            return [size, *pair]
        return None

    def _best_pair(self, room: int, without: int) -> tuple[int, int] | None:
        """Two texts of the greatest sum up to ``room``, the larger first."""
        top: tuple[int, int] | None = None
        lo, hi = 0, bisect_right(self.sizes, room) - 1
        while lo <= hi:
            a, b = self.sizes[hi], self.sizes[lo]
            need = {a: 1 + (a == b)} | ({b: 1} if a != b else {})
            free = all(self.left[s] - (s == without) >= n for s, n in need.items())
            if a + b <= room:
                if free and (top is None or a + b > sum(top)):
                    top = (a, b)
                lo += 1
            else:
                hi -= 1
        return top

    def _next_two(self, b: int, without: int) -> int:
        """The sum of the two texts that come just before the smaller of the pair in decreasing order."""
        above = [s for s in self.sizes if s > b][:2]
        more = [s for s in above for _ in range(min(2, self.left[s] - (s == without)))][:2]
        return sum(more) if len(more) == 2 else self.capacity + 1

    def _reduce(self) -> int:
        """Applies the criteria to each size, largest first, until none holds; returns the containers fixed."""
        moved = True
        while moved and self.sizes:
            moved = False
            for size in sorted(self.sizes, reverse=True):
                while size in self.left and (parts := self._dominating(size)):
                    self._fix(parts)
                    moved = True
        return self.boxes

    def _best_fit(self) -> None:
        room: dict[int, list[tuple[int, int]]] = {}  # free tokens -> runs (first container, containers)
        rooms: list[int] = []

        def put(free: int, box: int, n: int) -> None:
            if n and free:
                if free not in room:
                    room[free] = []
                    insort(rooms, free)
                room[free].append((box, n))

        for size in sorted(self.sizes, reverse=True):
            while size in self.left:
                at = bisect_right(rooms, size - 1)
                if at < len(rooms):
                    free = rooms[at]
                    box, n = room[free].pop()
                    if not room[free]:
                        del room[free]
                        rooms.pop(at)
                else:
                    free, per = self.capacity, self.capacity // size
                    box, n = self.boxes, -(-self.left[size] // per)
                    self.boxes += n
                per, have = free // size, self.left[size]
                full = min(n, have // per)
                if full:
                    self._take(size, full * per, per, box)
                    put(free - per * size, box, full)
                rest = have - full * per
                if rest and full < n:  # the last texts of the size share one container
                    self._take(size, rest, rest, box + full)
                    put(free - rest * size, box + full, 1)
                    full += 1
                put(free, box + full, n - full)

    def table(self) -> tuple[np.ndarray, ...]:
        rows = sorted(self.rows)
        return tuple(np.array(c, np.int64) for c in zip(*rows)) if rows else tuple(np.zeros(0, np.int64) for _ in range(5))


def token_sizes(df: DataFrame, key: str, text: str, path: str = TOKENIZER) -> DataFrame:
    """(key, tokens) of every row with a key; null and empty texts have 0."""

    def run(batches):
        count = tokenizer(path).count
        for b in batches:
            sizes = [count(t) if t else 0 for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(sizes, pa.int64())], names=[key, "tokens"])

    rows = df.select(F.col(key).cast("long").alias(key), F.col(text).alias("_text")).filter(F.col(key).isNotNull())
    return rows.mapInArrow(run, f"`{key}` long, tokens long")


def pack(sizes: DataFrame, key: str, capacity: int) -> DataFrame:
    """(key, part, first_token, tokens, container) of every text of ``sizes(key, tokens)``.

    A text within the capacity is one part. A longer one is cut into full containers, which hold nothing else, and a
    rest, which is packed like any other. A text without tokens has one part without a container. Keys must be unique;
    the texts of equal size are taken in the order of a hash of their key, so the result is the same every time.
    """
    whole = F.expr(f"tokens div {capacity}")
    full = sizes.filter(F.col("tokens") >= capacity).withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), whole - 1))).select(key, "part", F.lit(capacity).cast("long").alias("tokens"))
    rest = sizes.withColumn("part", whole).withColumn("tokens", F.col("tokens") % capacity).filter("tokens > 0").select(key, "part", "tokens")
    items = full.union(rest)
    counts = {r.tokens: r.n for r in items.groupBy("tokens").agg(F.count("*").alias("n")).toLocalIterator()}  # at most ``capacity`` rows
    plan = Plan(counts, capacity)
    size, first, n, per, box = plan.table()
    salts = max(1, -(-max(counts.values(), default=0) // PER_SALT))
    salted = items.withColumn("salt", F.pmod(F.xxhash64(key, "part"), F.lit(salts)).cast("int"))
    groups = salted.groupBy("tokens", "salt").agg(F.count("*").alias("n"))
    before = F.coalesce(F.sum("n").over(Window.partitionBy("tokens").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    groups = groups.select("tokens", "salt", before.alias("before"))
    ranked = salted.withColumn("rank", F.row_number().over(Window.partitionBy("tokens", "salt").orderBy(F.xxhash64(key), key, "part")) - 1)
    ranked = ranked.join(groups.hint("merge"), ["tokens", "salt"]).select(key, "part", "tokens", (F.col("rank") + F.col("before")).alias("rank"))

    def place(batches):
        for b in batches:
            s, r = b.column(2).to_numpy(), b.column(3).to_numpy()
            at = np.searchsorted(size * (1 << 40) + first, s * (1 << 40) + r, side="right") - 1
            container = box[at] + (r - first[at]) // per[at] if len(at) else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(b.column(1).to_numpy() * capacity), b.column(2), pa.array(container)], names=[key, "part", "first_token", "tokens", "container"])

    placed = ranked.mapInArrow(place, f"`{key}` long, part long, first_token long, tokens long, container long")
    none = sizes.filter("tokens = 0").select(key, F.lit(0).cast("long").alias("part"), F.lit(0).cast("long").alias("first_token"), F.lit(0).cast("long").alias("tokens"), F.lit(None).cast("long").alias("container"))
    return placed.union(none)


def pack_all(df: DataFrame, key: str, text: str, capacities: list[int], path: str = TOKENIZER) -> DataFrame:
    """``pack`` for each capacity, with column ``max_tokens`` first; texts are tokenised once."""
    sizes = cut(token_sizes(df, key, text, path))
    out = None
    for c in sorted(set(capacities)):
        part = pack(sizes, key, c).select(F.lit(c).alias("max_tokens"), key, "part", "first_token", "tokens", "container")
        out = part if out is None else out.union(part)
    if out is None:
        raise ValueError("no capacity is given")
    return out
