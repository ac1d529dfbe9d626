"""Files to documents: discovery, routing by extension, extraction in the executors."""

from __future__ import annotations

import json
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import formats, pdf  # noqa: F401 - pdf registers its readers

ASSET = pa.struct([("name", pa.string()), ("content", pa.binary())])
DOCUMENT = "path string, source_file string, reader string, content string, metadata map<string,string>, pipeline_phases array<string>, error string, assets array<struct<name:string,content:binary>>"


@dataclass(frozen=True)
class Rule:
    """Which reader an extension goes to, and which one if that isn't registered."""

    extension: str
    reader: str
    fallback: str | None = None
    params: dict = field(default_factory=dict)


# Extensions that each reader is for.
DEFAULT_RULES = [Rule(e, r) for r, es in {
    "html": "html htm xhtml", "docx": "docx", "xlsx": "xlsx", "pptx": "pptx", "odf": "odt ods odp", "epub": "epub", "pdf": "pdf", "zip": "zip",
    "image": "png jpg jpeg gif webp bmp tiff", "text": "txt md csv tsv json",
}.items() for e in es.split()]


def discover(spark: SparkSession, targets: list[str], rules: list[Rule] = DEFAULT_RULES) -> DataFrame:
    """(path, modificationTime, length, content, extension) of the files under the targets that a rule is for, letter
    case aside, each once. Targets that don't exist are skipped; without any the table is empty."""
    known = [r.extension.lower().lstrip(".") for r in rules]
    out = None
    for t in targets:
        if not _exists(spark, t):
            continue
        part = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(t)
        out = part if out is None else out.union(part)
    if out is None:
        out = spark.createDataFrame([], "path string, modificationTime timestamp, length long, content binary")
    ext = F.lower(F.regexp_extract("path", r"\.([^./]+)$", 1))
    return out.withColumn("extension", ext).filter(F.col("extension").isin(known)).dropDuplicates(["path"])


def _exists(spark: SparkSession, path: str) -> bool:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()).exists(at)


def route(rules: list[Rule]) -> dict[str, tuple[str, dict]]:
    """Extension -> reader and params. A fallback only stands in for a reader that isn't registered; without either
    it is an error, as is a repeated extension with another rule."""
    out: dict[str, tuple[str, dict]] = {}
    for r in rules:
        name = r.reader if r.reader in formats.READERS else r.fallback
        if name not in formats.READERS:
            raise ValueError(f"no reader {r.reader!r} for .{r.extension}")
        ext = r.extension.lower().lstrip(".")
        if out.setdefault(ext, (name, r.params)) != (name, r.params):
            raise ValueError(f"two rules for .{ext}")
    return out


def extract(files: DataFrame, rules: list[Rule] = DEFAULT_RULES) -> DataFrame:
    """One document a file: path, source_file, reader, content, metadata, phases, error, assets.

    A file that can't be read, or that no rule is for, has empty content and says why in ``error``; it has no phase,
    so a later run tries it again. Null contents are unreadable. Readers run one file at a time, so memory holds one
    file beside a batch.
    """
    to = route(rules)
    readers = {name: formats.READERS[name] for name, _ in to.values()}

    def run(batches):
        for b in batches:
            for path, data in zip(b.column(0).to_pylist(), b.column(1)):
                name = path.rsplit("/", 1)[-1]
                kind, params = to.get(name.rsplit(".", 1)[-1].lower(), (None, {}))
                got, error = formats.Extracted(""), None
                try:
                    if kind is None:
                        raise ValueError("no rule for this extension")
                    got = readers[kind](name, data.as_py(), params)
                except Exception as e:  # an unreadable file is a result
                    error = f"{type(e).__name__}: {e}"
                meta = {"source": name, **got.metadata, **({"params": json.dumps(params)} if params else {})}
                assets = [{"name": n, "content": c} for n, c in got.assets]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([path]), pa.array([name]), pa.array([kind], pa.string()), pa.array([got.content]), pa.array([list(meta.items())], pa.map_(pa.string(), pa.string())),
                     pa.array([[] if error else ["extract"]], pa.list_(pa.string())), pa.array([error], pa.string()), pa.array([assets], pa.list_(ASSET))],
                    names=["path", "source_file", "reader", "content", "metadata", "pipeline_phases", "error", "assets"],
                )

    return files.select("path", "content").mapInArrow(run, DOCUMENT)


def unfinished(files: DataFrame, done: DataFrame, path: str = "path") -> DataFrame:
    """The files that ``done`` has no document of."""
    return files.join(done.select(path).distinct(), path, "left_anti")


def assets_of(documents: DataFrame) -> DataFrame:
    """(path, name, content) of all assets."""
    return documents.select("path", F.explode("assets").alias("a")).select("path", "a.name", "a.content")


def epub_metrics(files: DataFrame) -> DataFrame:
    """(path, metrics JSON, error) of each EPUB."""
    from . import epub

    def run(batches):
        for b in batches:
            for path, data in zip(b.column(0).to_pylist(), b.column(1)):
                metrics, error = None, None
                try:
                    metrics = json.dumps(epub.audit(data.as_py()), ensure_ascii=False)
                except Exception as e:  # a corrupt file is a finding
                    error = f"{type(e).__name__}: {e}"
                yield pa.RecordBatch.from_arrays([pa.array([path]), pa.array([metrics], pa.string()), pa.array([error], pa.string())], names=["path", "metrics", "error"])

    return files.select("path", "content").mapInArrow(run, "path string, metrics string, error string")


def epub_facts(files: DataFrame) -> DataFrame:
    """(path, place, fact, value) of all that was seen in each EPUB, for ``epub.measured``; a corrupt file has one row, the
    fact ``error``."""
    from . import epub

    def run(batches):
        for b in batches:
            for path, data in zip(b.column(0).to_pylist(), b.column(1)):
                try:
                    rows = list(epub.facts(data.as_py()))
                except Exception as e:  # a corrupt file is a finding
                    rows = [epub.Fact("archive", "error", f"{type(e).__name__}: {e}")]
                columns = [[path] * len(rows), *map(list, zip(*rows))]
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in columns], names=["path", "place", "fact", "value"])

    return files.select("path", "content").mapInArrow(run, "path string, place string, fact string, value string")


def audited(files: DataFrame) -> DataFrame:
    """(path, format, supported, metrics JSON, error) of each file. Formats without an auditor aren't supported, nor is a
    file that its auditor fails on, which has the error."""
    from ..registry import PARTS

    auditors = dict(PARTS["auditors"])

    def run(batches):
        for b in batches:
            rows = []
            for path, data in zip(b.column(0).to_pylist(), b.column(1)):
                kind = path.rsplit(".", 1)[-1].lower() if "." in path.rsplit("/", 1)[-1] else ""
                row = {"path": path, "format": kind, "supported": False, "metrics": None, "error": None}
                if kind in auditors:
                    try:
                        row |= {"metrics": json.dumps(auditors[kind](data.as_py()), ensure_ascii=False), "supported": True}
                    except Exception as e:  # a corrupt file is a finding
                        row["error"] = f"{type(e).__name__}: {e}"
                rows.append(row)
            text = [("path", pa.string()), ("format", pa.string()), ("supported", pa.bool_()), ("metrics", pa.string()), ("error", pa.string())]
            yield pa.RecordBatch.from_pylist(rows, schema=pa.schema(text))

    return files.select("path", "content").mapInArrow(run, "path string, format string, supported boolean, metrics string, error string")


def only_titles(candidates: DataFrame, title: str, names: list[str]) -> DataFrame:
    """The candidates of the named titles; a name that none has is an error."""
    if not names:
        return candidates
    known = {r[0] for r in candidates.select(title).filter(F.col(title).isin(names)).distinct().collect()}  # at most the names
    if missing := sorted(set(names) - known):
        raise ValueError(f"no such titles: {', '.join(missing)}")
    return candidates.filter(F.col(title).isin(names))


def mounted(root: str) -> str:
    """The path of a folder that every machine has mounted; executors write single files there, so a URL of another
    file system is refused rather than taken for a local name."""
    if "://" in root and not root.startswith("file://"):
        raise ValueError(f"single files are written to mounted folders only, not to {root}")
    return root.removeprefix("file://")


def write_assets(documents: DataFrame, root: str) -> None:
    """Each document's assets as files in a folder of its own under a shared, mounted root, written by the executors.
    Names lose their folders, and a file is replaced as a whole. The folder is named like the file that the document
    came from, as its links are; files that would share one are an error, and nothing is written."""
    base = F.regexp_extract("path", r"([^/]*)$", 1)
    folder = F.when(F.substring(base, 2, 1 << 20).contains("."), F.regexp_replace(base, r"\.[^.]*$", "")).otherwise(base)
    shared = assets_of(documents).groupBy(folder.alias("folder")).agg(F.countDistinct("path").alias("n"), F.min("path").alias("one"), F.max("path").alias("other")).filter("n > 1").first()
    if shared:
        raise ValueError(f"{shared.one} and {shared.other} would share the asset folder {shared.folder}")
    to_root = mounted(root)

    def save(part):
        from pathlib import Path

        for r in part:
            to = Path(to_root, formats.stem(r.path), Path(r.name).name)
            to.parent.mkdir(parents=True, exist_ok=True)
            tmp = to.with_name(to.name + ".tmp")
            tmp.write_bytes(r.content)
            tmp.replace(to)

    assets_of(documents).filter("content is not null and name is not null").foreachPartition(save)
