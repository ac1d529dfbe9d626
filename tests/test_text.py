import re

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from foliospark.functions import expressions as X
from foliospark.functions.textform import text_form
from foliospark.functions.words import WordHash, shingle_hashes, words_of


@pytest.fixture(scope="module")
def form(spark):
    return text_form(spark)


@pytest.mark.parametrize(
    ("a", "b"),
    [("Ａｂｃ１２！", "Abc12!"), ("café", "café"), ("a​b﻿", "ab"), ("a b　c", "a b c"), ("рeасе", "peace"), ("ΑΒΕ", "ABE"), ("ﬁne oﬃce", "fine office"), ("a\r\nb\rc", "a\nb\nc"), ("І", "I"), ("co­op", "coop"), ("x  \ny", "x\ny"), ("ё", "ё"), ("a‑b", "a-b"), ("ꓮ", "A"), ("a։ b∶ c", "a: b: c"), ("a․ǃ", "a.!"), ("a‚ b", "a, b"), ("1⁄2", "1∕2"), ("𝟏𝟎", "10"), ("Ⅰ Ⅳ", "I IV"), ("5 µ", "5 μ"), ("𝐦𝑚", "mm"), ("…", "..."), ("𝛃", "β")],
)
def test_texts_that_look_the_same_have_one_form(form, a, b):
    assert form(a) == form(b)


@pytest.mark.parametrize(("a", "b"), [("é", "e"), ("A", "a"), ("x²", "x2"), ("rn", "m"), ("O", "0"), ("l", "1"), ("I", "l"), ("a\nb", "a b"), ("a.", "a!"), ("“a”", '"a"'), ("α", "a"), ("a  b", "a b"), ("ß", "B"), ("З", "3"), ("a–b", "a-b"), ("θ", "Θ"), ("æ", "ae"), ("τ", "т"), ("π", "п"), ("H₂O", "H2O"), ("x×y", "xxy")])
def test_texts_that_a_reader_tells_apart_stay_apart(form, a, b):
    assert form(a) != form(b)


@settings(max_examples=150, deadline=None)
@given(st.text())
def test_form_is_idempotent(form, s):
    assert form(form(s)) == form(s)


def test_form_of_null_and_empty(form):
    assert form(None) is None
    assert form("") == ""


def test_shingle_hashes_equal_plain_shingles():
    texts = ["a b c d e f", None, "", "one two", "A b C d e f", "x " * 2000]
    hashes, starts, digests = shingle_hashes(texts, lambda t: t, 5, WordHash())
    assert np.diff(starts).tolist() == [2, 0, 0, 0, 2, 1996]
    assert digests[0] == digests[4] and digests[0] != digests[5]
    assert hashes[0] == hashes[2] and len(set(hashes[4:].tolist())) == 1


def test_shingle_hashes_keep_texts_apart_when_some_are_short():
    texts = ["a b c", "d e f g h", "i", "j k l m n o"]
    hashes, starts, _ = shingle_hashes(texts, lambda t: t, 5, WordHash(2))
    alone = [shingle_hashes([t], lambda t: t, 5, WordHash())[0].tolist() for t in texts]
    assert [hashes[s:e].tolist() for s, e in zip(starts, starts[1:])] == alone


def test_column_expressions(spark):
    d = spark.createDataFrame([(1, "A b, c_d é 2"), (2, ""), (3, None), (4, "one two")], "k int, t string")
    rows = {r.k: r.s for r in d.select("k", X.shingles(F.col("t"), 3).alias("s")).collect()}
    assert rows == {1: ["a b c_d", "b c_d é", "c_d é 2"], 2: [], 3: None, 4: ["one two"]}
    import uuid

    assert d.select(X.uuid5(F.lit("x|é"))).first()[0] == str(uuid.uuid5(uuid.NAMESPACE_URL, "x|é"))
    assert d.select(X.strip(F.lit(" \x1f a b 　\n"))).first()[0] == "a b"
    assert d.select(X.overlay(F.create_map(F.lit("a"), F.lit("1"), F.lit("b"), F.lit("2")), F.create_map(F.lit("a"), F.lit("9")))).first()[0] == {"a": "9", "b": "2"}
    assert d.select(X.size_mb(F.lit(2_250_000)), X.stored_scalar(F.array(F.lit(1)), "array<int>"), X.stored_scalar(F.lit(3), "int")).first() == (2.2, "[1]", "3")
    assert words_of("Été_1 x") == ["été_1", "x"]


def test_cut_tables_are_released(spark):
    from pathlib import Path

    from foliospark.session import cut, release

    d = cut(spark.range(5))
    folder = Path(re.sub("^file:/+", "/", d.inputFiles()[0])).parent
    assert d.count() == 5 and folder.exists()
    release()
    assert not folder.exists()
