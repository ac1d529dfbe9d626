"""A vector collection as a table in a folder that all executors share.

Every upsert writes a whole new version and only then is it the current one, so a reader sees the old or the new one, and
an upsert that fails leaves nothing behind. A collection has a width, which is set when it is made.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import vectors

KEPT = 2  # versions that stay, for readers that have begun
COLUMNS = "vector_id string, filename string, level string, section string, chunk_index int, page_number int, text string, embedding array<float>"


class TableStore:
    """The collection in ``path``, made if it isn't there; an existing one must have the same width."""

    score_note = "cosine similarity: 1 is the same direction, 0 unrelated"

    def __init__(self, spark: SparkSession, path: str, width: int):
        if width < 1:
            raise ValueError("a width is at least 1")
        self.spark, self.path, self.width = spark, path.rstrip("/"), width
        self._fs = spark._jvm.org.apache.hadoop.fs.Path(path).getFileSystem(spark._jsc.hadoopConfiguration())
        found = self._versions()
        if not found:
            self._write(spark.createDataFrame([], COLUMNS), 0)
        elif found[-1][1] != width:
            raise ValueError(f"the collection has width {found[-1][1]}, not {width}")

    def _at(self, name: str = ""):
        return self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}" if name else self.path)

    def _versions(self) -> list[tuple[int, int]]:
        """(version, width) of the complete versions, in order."""
        if not self._fs.exists(self._at()):
            return []
        names = [s.getPath().getName() for s in self._fs.listStatus(self._at())]
        whole = [n for n in names if n.startswith("v") and self._fs.exists(self._at(f"{n}/_SUCCESS"))]
        return sorted((int(n[1:].split("-")[0]), int(n.split("-")[1])) for n in whole)

    def _write(self, rows: DataFrame, version: int) -> None:
        rows.write.mode("overwrite").parquet(f"{self.path}/v{version}-{self.width}")
        for old, width in self._versions()[:-KEPT]:
            self._fs.delete(self._at(f"v{old}-{width}"), True)

    def rows(self) -> DataFrame:
        """The current version."""
        version, width = self._versions()[-1]
        return self.spark.read.schema(COLUMNS).parquet(f"{self.path}/v{version}-{width}")

    def upsert(self, new: DataFrame, replace_files: bool = False) -> None:
        """Adds rows by ``vector_id``, in place of those that have it; with ``replace_files`` in place of all rows of their
        files. Rows without an id are left out, and of several with one id one stays. An embedding of another width is
        an error, and nothing changes; rows without an embedding are kept, but never found."""
        names = self.spark.createDataFrame([], COLUMNS).columns
        new = new.select(*[F.col(c) if c in new.columns else F.lit(None).alias(c) for c in names]).filter("vector_id is not null").dropDuplicates(["vector_id"])
        wrong = new.filter(F.size("embedding") != self.width).select(F.size("embedding").alias("n")).first()
        if wrong:
            raise ValueError(f"the collection has width {self.width}; there is an embedding of {wrong.n}")
        stored = vectors.upsert(self.rows(), new, "vector_id", "filename" if replace_files else None)
        kinds = self.spark.createDataFrame([], COLUMNS).schema
        self._write(stored.select(*[F.col(f.name).cast(f.dataType) for f in kinds]), self._versions()[-1][0] + 1)

    def search(self, queries: DataFrame, key: str, embedding: str, k: int = vectors.TOP_K) -> DataFrame:
        """(key, rank, score, then the columns of the rows found) of the ``k`` best rows for each query."""
        from ..session import cut

        rows = cut(self.rows().withColumn("_n", F.monotonically_increasing_id()))
        found = vectors.search(rows, "_n", "embedding", queries, key, embedding, k, self.width)
        return found.join(rows.drop("embedding"), "_n").drop("_n")

    @staticmethod
    def is_duplicate_score(score: float | None, threshold: float) -> bool:
        """Whether a score says that two texts are the same."""
        return score is not None and score >= threshold
