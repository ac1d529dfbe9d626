import pytest
from pyspark.sql import functions as F

from foliospark import registry
from foliospark.config import ChunkSettings, Config
from foliospark.operators.store import TableStore
from foliospark.plans import pipeline
from foliospark.sources import files, make

ROWS = "vector_id string, filename string, text string, embedding array<float>, extra int"


def test_collection_is_made_checked_and_upserted(spark, tmp_path):
    path = str(tmp_path / "c")
    store = TableStore(spark, path, 2)
    assert store.rows().count() == 0
    with pytest.raises(ValueError, match="width 2, not 3"):
        TableStore(spark, path, 3)
    store.upsert(spark.createDataFrame([("a", "f", "one", [1.0, 0.0], 1), ("b", "f", "two", [0.0, 1.0], 1), (None, "f", "x", [1.0, 1.0], 1), ("n", "g", "none", None, 1)], ROWS))
    with pytest.raises(ValueError, match="embedding of 3"):
        store.upsert(spark.createDataFrame([("c", "f", "x", [1.0, 0.0, 0.0], 1)], ROWS))
    again = TableStore(spark, path, 2)
    again.upsert(spark.createDataFrame([("a", "f", "newer", [1.0, 0.1], 1)], ROWS))
    assert {(r.vector_id, r.text) for r in store.rows().collect()} == {("a", "newer"), ("b", "two"), ("n", "none")}
    again.upsert(spark.createDataFrame([("z", "f", "only", [1.0, 1.0], 1)], ROWS), replace_files=True)
    assert {r.vector_id for r in store.rows().collect()} == {"z", "n"}
    again.upsert(spark.createDataFrame([], ROWS))
    assert len(store._versions()) == 2
    found = store.search(spark.createDataFrame([(7, [1.0, 1.0]), (8, [0.0, 0.0])], "q long, e array<float>"), "q", "e", 1).collect()
    assert [(r.q, r.rank, r.score, r.text) for r in found] == [(7, 1, 1.0, "only")]
    assert store.is_duplicate_score(0.95, 0.95) and not store.is_duplicate_score(None, 0.5)


def test_parts_are_registered_and_looked_up(spark, monkeypatch):
    monkeypatch.setitem(registry.PARTS, "chunkers", dict(registry.PARTS["chunkers"]))
    with pytest.raises(ValueError, match="there are: fixed, markdown"):
        registry.lookup("chunkers", "nope")
    with pytest.raises(ValueError, match="kind"):
        registry.register("nothing", "x", len)
    registry.register("chunkers", "lines", lambda df, key, text, size, overlap: df.select(F.col(key), F.lit(0).alias("chunk_index"), F.lit(None).cast("int").alias("page_number"), F.lit("s").alias("section"), F.col(text).alias("text")))
    docs = spark.createDataFrame([("f", "# A\n\n" + "word " * 400)], "source_file string, content string")
    embedder = registry.lookup("embedders", "hash")(8)
    count = lambda kind: pipeline.index(docs, Config(chunks=ChunkSettings(kind=kind)), embedder).count()
    assert (count("lines"), count("fixed")) == (1, 3) and count("markdown") >= 2


def test_answers_come_in_pieces(spark):
    rows = [(1, "q", 1, 0.9, "f", 1, "s", "chunk", "text one")]
    results = spark.createDataFrame(rows, "question_id long, question string, rank int, score double, filename string, page_number int, section string, level string, text string")
    questions = spark.createDataFrame([(1, "q"), (2, "r")], "question_id long, question string")
    pieces = list(pipeline.answer_pieces(results, questions, lambda i, p: iter(["a", "b"])))
    assert pieces[:2] == [(1, "a"), (1, "b")] and [q for q, _ in pieces] == [1, 1, 2]
    assert dict(pipeline.answer(results, questions, registry.lookup("generators", "echo")))[1].startswith("Context passages:")


def test_files_are_audited_by_format(spark):
    rows = [("a.PDF", make.pdf(["x " * 90])), ("b.epub", make.epub(["x"])), ("c.txt", b"x"), ("d.pdf", b""), ("e.pdf", None), ("noext", b"")]
    got = {r.path: r for r in files.audited(spark.createDataFrame(rows, "path string, content binary")).collect()}
    assert {p for p, r in got.items() if r.supported} == {"a.PDF", "b.epub"} and {p for p, r in got.items() if r.error} == {"d.pdf", "e.pdf"} and got["noext"].format == ""
