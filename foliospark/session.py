"""Session helpers: a local session for tests and the bench, reading tables, and cutting lineage."""

from __future__ import annotations

import atexit
import re
import shutil
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession


_prepared: set[str] = set()


def prepare(spark: SparkSession) -> SparkSession:
    """Sends this package to the executors, once a session; functions that run there import it. The registered queries
    do this by themselves."""
    sc = spark.sparkContext
    if sc.applicationId not in _prepared:
        folder = tempfile.mkdtemp(prefix="foliospark-code-")
        atexit.register(shutil.rmtree, folder, True)
        package = Path(__file__).resolve().parent
        with zipfile.ZipFile(f"{folder}/foliospark.zip", "w", zipfile.ZIP_DEFLATED) as z:
            for f in sorted(package.rglob("*.py")):
                z.write(f, f.relative_to(package.parent))
        sc.addPyFile(f"{folder}/foliospark.zip")
        _prepared.add(sc.applicationId)
    return spark


def local_session(cores: str = "*", shuffle_partitions: int = 8, memory: str = "8g") -> SparkSession:
    """A session for tests and benchmarks on one machine."""
    return prepare(
        SparkSession.builder.master(f"local[{cores}]")
        .appName("foliospark")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One table of the test data or of a corpus laid out the same way."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def texts(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    """Some columns of a table whose rows take long to process. A table in fewer splits than there are cores, which is
    a small one, is spread over all of them; a large one is left as it is, without a shuffle."""
    df = table(spark, sf_dir, name).select(*columns)
    cores = spark.sparkContext.defaultParallelism
    return df if df._jdf.queryExecution().toRdd().getNumPartitions() >= cores else df.repartition(cores)


def shared_dir(spark: SparkSession) -> str:
    """The folder in spark.checkpoint.dir, which all executors share; only where none is set and all runs on this
    machine, as in tests, a temporary one."""
    sc = spark.sparkContext
    where = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not where:
        if not sc.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        where = "file://" + tempfile.mkdtemp(prefix="foliospark-")
        atexit.register(shutil.rmtree, where[7:], True)
        sc.setCheckpointDir(where)
    return where.rstrip("/")


_cuts: list[tuple[SparkSession, str]] = []


def cut(df: DataFrame, *partition_by: str) -> DataFrame:
    """Writes ``df`` as a table to the shared folder and reads it again: what follows survives the loss of
    executors, and the plan before it runs only once. ``release`` deletes the table, at the latest when the program
    ends."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/cut-{uuid.uuid4().hex}"
    if not _cuts:
        atexit.register(release)
    _cuts.append((spark, path))
    df.write.option("compression", "zstd").parquet(path, partitionBy=list(partition_by) or None)
    return spark.read.schema(df.schema).parquet(path)


def release() -> None:
    """Deletes all tables that ``cut`` wrote. Results that were not stored yet can't be computed any more, so a long
    session calls this between jobs."""
    while _cuts:
        spark, path = _cuts.pop()
        if path.startswith(("file:", "/")):
            shutil.rmtree(re.sub("^file:/+", "/", path), True)
            continue
        try:
            at = spark._jvm.org.apache.hadoop.fs.Path(path)
            at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)
        except Exception:  # the session has ended already
            return
