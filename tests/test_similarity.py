import random
from itertools import combinations

import numpy as np
import pytest
from pyspark.sql import functions as F

from foliospark.operators.components import components
from foliospark.operators.families import Families, canonical, family_report, murmur3, roles, signatures, superseded
from foliospark.operators.joins import grid_join, salted_join

WORDS = [f"w{i}" for i in range(400)]


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


def test_components_against_union_find(spark):
    r = random.Random(2)
    edges = [(r.randrange(300), r.randrange(300)) for _ in range(220)] + [(i, i + 1) for i in range(1000, 1200)] + [(5, 5), (None, 3)]
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for a, b in edges:
        if a is not None and a != b:
            a, b = find(a), find(b)
            root[max(a, b)] = min(a, b)
    got = {x.node: x.root for x in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {x: find(x) for x in list(root)}


def test_salted_joins_equal_plain_ones(spark):
    a = spark.range(200).select((F.col("id") % 3).alias("k"), F.col("id").alias("x"))
    b = spark.range(50).select((F.col("id") % 5).alias("k"), F.col("id").alias("y"))
    plain = sorted((r.k, r.x, r.y) for r in a.join(b, "k").collect())
    assert sorted((r.k, r.x, r.y) for r in salted_join(a, b, ["k"], F.col("x")).collect()) == plain
    assert sorted((r.k, r.x, r.y) for r in grid_join(a, b, ["k"], F.col("x"), F.col("y")).collect()) == plain
    assert salted_join(a, b.filter("k = 1"), ["k"], F.col("x"), how="left_anti").count() == a.filter("k <> 1").count()


def test_murmur3_known_values():
    got = murmur3([b"", b"a", b"hello", b"hello, world"], np.array([0]))[:, 0].tolist()
    assert got == [0, 0x3C2569B2, 0x248BFA47, 0x149BBB7F]


@pytest.mark.parametrize("family", ["linear", "murmur3"])
def test_families_equal_all_pairs(spark, family):
    texts = [*texts_with_edits(7), "", None, "", "one", "One"]
    d = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    signed = signatures(d, "doc_id", "text", family=family).cache()
    sig = {r.doc_id: r.signature for r in signed.collect()}
    assert sig[len(texts) - 5] == sig[len(texts) - 4] == [0] * 64 and sig[len(texts) - 1] == sig[len(texts) - 2]
    f = Families(signed, "doc_id", 0.5)
    root = {i: i for i in sig}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in combinations(sorted(sig), 2):
        if sum(x == y for x, y in zip(sig[a], sig[b])) / 64 >= 0.5:
            a, b = find(a), find(b)
            root[max(a, b)] = min(a, b)
    families = f.families().cache()
    assert {r.doc_id: r.family_id for r in families.collect()} == {i: find(i) for i in sig}
    c = canonical(families, d, "doc_id", "text")
    best = {}
    for i in sig:
        best[find(i)] = max(best.get(find(i), (-1, -1)), (len(texts[i] or ""), i))
    assert {r.family_id: r.canonical for r in c.collect()} == {k: v[1] for k, v in best.items()}
    assert family_report(c).first().rows == len(texts)
    role = {r.doc_id: r.role for r in roles(families, c, "doc_id").collect()}
    status = {r.doc_id: r.status for r in superseded(d.withColumn("_s", F.lit(1)).withColumn("status", F.lit("x")), roles(families, c, "doc_id"), "doc_id").collect()}
    assert {i for i, s in status.items() if s == "superseded"} == {i for i, s in role.items() if s == "variant"}


def test_membership_gives_every_near_duplicate(spark):
    texts = [*texts_with_edits(9), "", None, "one two", "One, two"]
    signed = signatures(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), "doc_id", "text").cache()
    sig = {r.doc_id: r.signature for r in signed.collect()}
    alike = {(a, b) for a in sig for b in sig if a != b and sum(x == y for x, y in zip(sig[a], sig[b])) / 64 >= 0.8}
    f = Families(signed, "doc_id", 0.8)
    got = {r.doc_id: r for r in f.membership().collect()}
    assert {i: r.n_links for i, r in got.items()} == {i: sum(a == i for a, _ in alike) for i in sig}
    linked = {(r.rep_a, r.rep_b) for r in f.links.collect()}
    reps = {i: r.rep for i, r in got.items()}
    assert {(a, b) for a in sig for b in sig if a < b and (reps[a] == reps[b] or (min(reps[a], reps[b]), max(reps[a], reps[b])) in linked)} == {(a, b) for a, b in alike if a < b}


def test_family_threshold_zero_is_refused(spark):
    with pytest.raises(ValueError):
        Families(spark.createDataFrame([], "doc_id long, signature array<long>"), "doc_id", 0.0)
