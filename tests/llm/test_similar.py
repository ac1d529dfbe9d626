import random
import zlib
from itertools import combinations

import numpy as np
import pytest
from pyspark.sql import functions as F

from foliospark.llm.hnsw import Hnsw, neighbours, similar_pairs
from foliospark.llm.setsketch import NearDuplicates, SetSketch

WORDS = [f"w{i}" for i in range(400)]


def shingle_set(text, k=5):
    w = text.lower().split()
    return {tuple(w[i : i + k]) for i in range(len(w) - k + 1)}


def texts_with_edits(seed=5):
    r = random.Random(seed)
    out = []
    for _ in range(25):
        base = [r.choice(WORDS) for _ in range(r.randint(8, 90))]
        out.append(" ".join(base))
        for _ in range(r.randint(0, 5)):
            w = base.copy()
            for _ in range(r.randint(0, 4)):
                w[r.randrange(len(w))] = r.choice(WORDS)
            out.append(" ".join(w))
    return out


def test_near_duplicates_equal_brute_force(spark):
    texts = [*texts_with_edits(), "a b c d e", "A b c d e", "a b c d", "", None, "ＡＢ c d e f", "AB c d e f"]
    rows = [("x", i, t, i) for i, t in enumerate(texts)] + [("y", 1, texts[0], 0), ("y", None, texts[0], 0)]
    near = NearDuplicates(spark.createDataFrame(rows, "tab string, id long, text string, rep int"), 0.7)
    got = sorted((r.tab, r.id_a, r.id_b) for r in near.pairs().collect())
    sets = [shingle_set(t.replace("Ａ", "a").replace("Ｂ", "b")) if t else set() for t in texts]
    want = sorted(("x", a, b) for a, b in combinations(range(len(texts)), 2) if sets[a] and sets[b] and len(sets[a] & sets[b]) / len(sets[a] | sets[b]) >= 0.7)
    assert got == want
    links = {}
    for _, a, b in want:
        links[a] = links.get(a, 0) + 1
        links[b] = links.get(b, 0) + 1
    groups = {r.id: r for r in near.groups().filter("tab = 'x'").collect()}
    assert {i: g.n_links for i, g in groups.items() if g.n_links} == links
    assert all(groups[a].group_id == groups[b].group_id for _, a, b in want)


def test_near_duplicates_with_a_hot_group_of_copies_and_of_variants(spark):
    base = "the quick brown fox jumps over the lazy dog and runs far away from here today with all of his good friends".split()
    rows = [("x", i, " ".join(base)) for i in range(40)]
    rows += [("x", 100 + i, " ".join([*base * 3, f"end{i}"])) for i in range(1200)]
    near = NearDuplicates(spark.createDataFrame(rows, "tab string, id long, text string"), 0.8)
    assert near.links.count() == 1200 * 1199 // 2
    g = near.groups().groupBy("group_id").agg(F.count("*").alias("n"), F.min("n_links").alias("k")).collect()
    assert sorted((r.group_id, r.n, r.k) for r in g) == [(0, 40, 39), (100, 1200, 1199)]


def test_near_duplicates_of_an_empty_table(spark):
    near = NearDuplicates(spark.createDataFrame([], "tab string, id long, text string"))
    assert near.pairs().count() == near.groups().count() == 0


def test_sketch_merges_and_estimates():
    s, r = SetSketch(m=512), np.random.default_rng(1)
    a, b = r.integers(0, 2**63, 3000, dtype=np.uint64), r.integers(0, 2**63, 1000, dtype=np.uint64)
    both = np.concatenate([a, b])
    regs = s.sketch(np.concatenate([a, b, both]), np.array([0, 3000, 4000, 8000]))
    assert (np.maximum(regs[0], regs[1]) == regs[2]).all()
    assert s.cardinality(regs)[2] == pytest.approx(4000, rel=0.15)
    assert s.jaccard(regs[:1], regs[2:])[0] == pytest.approx(0.75, abs=0.08)
    assert s.jaccard(regs[:1], regs[1:2])[0] < 0.05


def vectors(n=3000, seed=3):
    r = np.random.default_rng(seed)
    centres = r.normal(size=(40, 64))
    return centres[r.integers(0, 40, n)] + r.normal(size=(n, 64)) * r.choice([0.2, 0.6], n)[:, None]


def truth(ids, x, k=5):
    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    s = np.round(u @ u.T, 6)
    np.fill_diagonal(s, -9)
    return {int(i): [(int(ids[j]), s[n, j]) for j in np.lexsort((ids, -s[n]))[:k]] for n, i in enumerate(ids)}


def test_hnsw_recall_alone():
    x = vectors()
    x = x / np.linalg.norm(x, axis=1, keepdims=True)
    ids, _ = Hnsw(x).search(x, 6)
    want = truth(np.arange(len(x)), x)
    hit = sum(len({j for j in row.tolist() if j != i} & {j for j, _ in want[i]}) for i, row in enumerate(ids))
    assert hit / (5 * len(x)) >= 0.95


def test_neighbours_over_many_shards_with_copies_and_unusable_rows(spark, monkeypatch):
    import foliospark.llm.hnsw as h

    monkeypatch.setattr(h, "SHARD", 300)
    x = vectors(2500).astype(np.float32)
    x[1000:1400] = x[0]  # a hot group of copies
    rows = [(int(zlib.crc32(b"%d" % i)), [float(v) for v in e], "extra", i) for i, e in enumerate(x)]
    bad = [(-1, None, "", 0), (-2, [], "", 0), (-3, [0.0] * 64, "", 0), (-4, [1.0] * 63, "", 0), (-5, [float("nan")] * 64, "", 0), (-6, [float("inf")] * 64, "", 0), (None, [1.0] * 64, "", 0)]
    d = spark.createDataFrame(rows + bad, "vec_id long, embedding array<float>, class string, rank int")
    got = {}
    for r in neighbours(d, "vec_id", "embedding").orderBy("vec_id", "rank").collect():
        got.setdefault(r.vec_id, []).append((r.neighbour, r.similarity))
    want = truth(np.array([r[0] for r in rows]), x.astype(np.float64))
    assert got.keys() == want.keys() and all(len(v) == 5 for v in got.values())
    same = sum(len({j for j, _ in got[i]} & {j for j, _ in want[i]}) for i in want)
    assert same / (5 * len(want)) >= 0.9
    copies = [rows[i][0] for i in (0, *range(1000, 1400))]
    for i in copies[:20]:
        assert [j for j, _ in got[i]] == [j for j in sorted(copies) if j != i][:5]


def test_recall_holds_over_a_hundred_shards(spark, monkeypatch):
    import foliospark.llm.hnsw as h

    monkeypatch.setattr(h, "SHARD", 30)
    r = np.random.default_rng(6)
    x = (r.normal(size=(3000, 12)) @ r.normal(size=(12, 64)) + r.normal(size=(3000, 64)) * 0.2).astype(np.float32)  # no clusters
    d = spark.createDataFrame([(i, [float(v) for v in e]) for i, e in enumerate(x)], "vec_id long, embedding array<float>")
    got = {}
    for row in neighbours(d, "vec_id", "embedding").collect():
        got.setdefault(row.vec_id, set()).add(row.neighbour)
    want = truth(np.arange(len(x)), x.astype(np.float64))
    recall = sum(len(got[i] & {j for j, _ in w}) for i, w in want.items()) / (5 * len(want))
    assert recall >= 0.97, recall


def test_neighbours_of_few_and_no_vectors(spark):
    d = spark.createDataFrame([(1, [1.0] + [0.0] * 63), (2, [0.0, 1.0] + [0.0] * 62)], "vec_id long, embedding array<float>")
    assert sorted((r.vec_id, r.neighbour, r.similarity) for r in neighbours(d, "vec_id", "embedding").collect()) == [(1, 2, 0.0), (2, 1, 0.0)]
    assert similar_pairs(d.limit(0), "vec_id", "embedding", 0.8).count() == 0


@pytest.mark.parametrize("shard", [4096, 40])
def test_neighbours_settle_ties_in_a_group_of_scaled_copies_by_key(spark, monkeypatch, shard):
    import foliospark.llm.hnsw as h

    monkeypatch.setattr(h, "SHARD", shard)
    r = np.random.default_rng(8)
    x = vectors(400, 4)
    x[100:300] = x[0] * r.uniform(0.1, 9, 200)[:, None]  # lengths differ, so the bits of almost all do
    x[300:330] = x[1] + r.normal(size=(30, 64)) * 2e-5  # alike by less than the rounding
    x = x.astype(np.float32)
    ids = r.permutation(400)
    d = spark.createDataFrame([(int(i), [float(v) for v in e]) for i, e in zip(ids, x)], "vec_id long, embedding array<float>")
    got = {}
    for row in neighbours(d, "vec_id", "embedding").orderBy("vec_id", "rank").collect():
        got.setdefault(row.vec_id, []).append((row.neighbour, row.similarity))
    want = truth(ids, x.astype(np.float64))
    group = {int(i) for i in ids[[0, 1, *range(100, 330)]]}
    assert {i: [j for j, _ in v] for i, v in got.items() if shard > 400 or i in group} == {i: [j for j, _ in v] for i, v in want.items() if shard > 400 or i in group}
