"""Session helpers: where intermediate tables go, and how lineage is cut."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_OWN: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir. Where that is unset, a session of one
    machine has an own temporary folder; on a cluster there is no folder to fall back on, and this raises."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if found:
        return found.rstrip("/")
    master = spark.sparkContext.master
    if not (master == "local" or master.startswith("local[")):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    app = spark.sparkContext.applicationId
    if app not in _OWN:
        _OWN[app] = "file://" + tempfile.mkdtemp(prefix="doclattice-")
    return _OWN[app]


@contextmanager
def _setting(spark: SparkSession, name: str, value: str) -> Iterator[None]:
    before = spark.conf.get(name, None)
    spark.conf.set(name, value)
    try:
        yield
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)


def materialize(df: DataFrame, name: str, small: bool = False) -> DataFrame:
    """Write df once under the shared folder and read it back: lineage ends there, so a lost executor
    costs a re-read and not a recomputation. Shuffle files of the write go when it ends, the written files when the
    driver's JVM ends. small: a table that is slight beside the input; its rows are dealt to an eighth of the usual
    number of files after they have been computed by all tasks."""
    spark = df.sparkSession
    if small:
        df = df.repartition(max(8, parallelism(spark) // 8))
    where = f"{shared_dir(spark)}/doclattice/{name}-{uuid.uuid4().hex}"
    with _setting(spark, "spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true"):
        df.write.parquet(where)
    path = spark._jvm.org.apache.hadoop.fs.Path(where)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(path)
    return spark.read.schema(df.schema).parquet(where)


def drop_materialized(df: DataFrame) -> None:
    """Delete the files behind a frame that materialize() returned."""
    spark = df.sparkSession
    for name in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        path = spark._jvm.org.apache.hadoop.fs.Path(name)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def short_batches(spark: SparkSession, rows: int = 2000) -> None:
    """Whole texts go to Python in batches of at most this many rows. It is a setting of the caller's session and stays, as
    the frames that are returned run later; a smaller number that the session has is left alone."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(name, "10000")) <= rows:
        spark.conf.set(name, str(rows))


def parallelism(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions", "200"))
