import pytest
from pyspark.sql import functions as F

from foliospark import config
from foliospark.plans import pipeline


def test_config(tmp_path):
    path = tmp_path / "c.yaml"
    path.write_text("input_targets: [x]\ncleanup: {deduplicate_paragraphs: true, regex_removals: ['a']}\nretrieval: {top_k: 3}\nfile_rules: [{extension: txt, reader: text}]\n")
    c = config.load(str(path))
    assert c.retrieval.top_k == 3 and c.cleanup.regex_removals == ("a",) and c.file_rules[0].reader == "text" and c.chunks.size == 1000
    path.write_text("")
    assert config.load(str(path)) == config.Config()
    for bad in ("nope: 1", "retrieval: {topk: 3}", "retrieval: {top_k: 0}", "retrieval: {temperature: 2.5}", "chunks: {size: 5, overlap: 9}", "families: {threshold: 0}", "clean: 3", "chunks: {size: x}", "file_rules: [{ext: a}]"):
        path.write_text(bad)
        with pytest.raises(ValueError):
            config.load(str(path))
    with pytest.raises(FileNotFoundError):
        config.load(str(tmp_path / "none.yaml"))


def test_from_files_to_answers(spark, tmp_path):
    (tmp_path / "raw").mkdir()
    (tmp_path / "raw/a.md").write_text("# Dragons\n\nDragons guard gold in caves.  \n\n\n\n## Food\n\nThey eat sheep and goats.")
    (tmp_path / "raw/b.txt").write_text("Ships cross the northern sea in summer.")
    (tmp_path / "raw/copy.txt").write_text("Ships cross the northern sea in summer.")
    (tmp_path / "raw/bad.docx").write_bytes(b"x")
    c = config.build(config.Config, {"input_targets": [str(tmp_path / "raw")], "retrieval": {"near_copy_threshold": 0.99}})
    docs = pipeline.ingest(spark, c).cache()
    assert {(r.source_file, r.error is None) for r in docs.collect()} == {("a.md", True), ("b.txt", True), ("bad.docx", False)}
    again = pipeline.ingest(spark, c, docs.filter("error is null"))
    assert {r.source_file for r in again.collect()} == {"copy.txt", "bad.docx"}
    e = pipeline.hash_embedder()
    rows = pipeline.index(docs.filter("error is null"), c, e, lambda t: t[:20]).cache()
    assert {(r.filename, r.level, r.chunk_index) for r in rows.collect()} >= {("a.md", "chunk", 0), ("a.md", "chunk", 1), ("a.md", "document", -1), ("a.md", "section", -2), ("b.txt", "chunk", 0)}
    plain = pipeline.index(docs.filter("error is null"), c, e).cache()
    store = plain.limit(0)
    store = pipeline.add_to_store(store, plain, c).cache()
    assert store.count() == plain.count() == 3
    moved = plain.withColumn("filename", F.concat(F.lit("z"), "filename")).withColumn("vector_id", F.concat(F.lit("z"), "vector_id"))
    assert pipeline.add_to_store(store, moved, c).count() == 3
    assert pipeline.add_to_store(store, plain, c).count() == 3
    q = spark.createDataFrame([(1, "what do dragons guard in caves"), (2, "ships on the sea in summer"), (3, "")], "question_id long, question string")
    found = pipeline.retrieve(store, q, e, c)
    first = {r.question_id: r.filename for r in found.filter("rank = 1").collect()}
    assert first == {1: "a.md", 2: "b.txt"}
    answers = dict(pipeline.answer(found, q, lambda rules, prompt: iter([prompt.rsplit("Question: ", 1)[1], "!"])))
    assert answers[2] == "ships on the sea in summer!" and "can't be answered" in answers[3]
