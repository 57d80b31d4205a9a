"""Session defaults, the shared folder for cut lineage, and the removal of what is written there."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

#: Settings the operators rely on; everything else is left to the cluster.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.mapKeyDedupPolicy": "LAST_WIN",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}
#: Bytes of input for each partition of a range sort, and the most partitions that its sample of the keys can tell apart evenly.
PARTITION_BYTES = 256 << 20
MOST_PARTITIONS = 50_000
#: Sizes from here on are unknown, not measured.
_UNKNOWN_BYTES = 1 << 60

#: Paths written by each open scope, the innermost last; the first list belongs to the application.
_scopes: list[list[str]] = [[]]


def local_session(cores: str = "8", partitions: int = 8, **extra: str) -> SparkSession:
    """A session for tests and benchmarks on one machine."""
    builder = SparkSession.builder.master(f"local[{cores}]").config("spark.sql.shuffle.partitions", partitions)
    conf = SETTINGS | {"spark.driver.memory": "8g", "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false"}
    for key, value in (conf | extra).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def prepare(spark: SparkSession) -> SparkSession:
    """Set the SQL settings the queries rely on."""
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors share: ``spark.checkpoint.dir``.

    Where that is unset, a master on one machine gets a temporary folder that
    goes when Python ends; any other master is an error, as its executors
    would write to folders that nobody else can read.
    """
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if folder is None:
            if not is_local(context.master):
                raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
            folder = tempfile.mkdtemp(prefix="foreglass-")
            atexit.register(shutil.rmtree, folder, ignore_errors=True)
        context.setCheckpointDir(folder)
    return context.getCheckpointDir()


def is_local(master: str) -> bool:
    """True if all tasks run in the driver's own process."""
    return master == "local" or master.startswith("local[")


def file_system(spark: SparkSession, path: str):
    """``(file system, path)`` of Hadoop for a path of any scheme."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def remove(spark: SparkSession, paths: list[str]) -> None:
    for path in paths:
        system, place = file_system(spark, path)
        system.delete(place, True)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """A scope that removes every table and checkpoint made inside it when it ends.

    Results must be written or collected before. Without a scope they stay
    until ``discard`` or, of a temporary folder, until Python ends.
    """
    _scopes.append([])
    try:
        yield
    finally:
        remove(spark, _scopes.pop())


def cut(df: DataFrame) -> DataFrame:
    """``df`` with its lineage cut by a checkpoint in the shared folder; partitions and their order stay."""
    shared_folder(df.sparkSession)
    out = df.checkpoint(eager=True)
    file = out._jdf.logicalPlan().rdd().getCheckpointFile()
    if file.isDefined():
        _scopes[-1].append(file.get())
    return out


def written(df: DataFrame) -> DataFrame:
    """``df`` written to the shared folder as a compressed table and read again."""
    path = f"{shared_folder(df.sparkSession)}/table-{uuid.uuid4().hex}"
    _scopes[-1].append(path)
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._scratch_path = path
    return out


def scratch_folder(spark: SparkSession) -> str:
    """A new folder in the shared folder, removed with the scope it was made in."""
    path = f"{shared_folder(spark)}/folder-{uuid.uuid4().hex}"
    _scopes[-1].append(path)
    return path


def discard(*tables: DataFrame) -> None:
    """Remove tables of ``written`` that nothing reads any more."""
    for df in tables:
        path = df._scratch_path
        remove(df.sparkSession, [path])
        for scope in _scopes:
            if path in scope:
                scope.remove(path)


def input_bytes(df: DataFrame) -> int:
    """Bytes of the tables that a plan reads, as far as they are known before it runs."""
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    sizes = [int(leaves.apply(i).stats().sizeInBytes()) for i in range(leaves.size())]
    return sum(s for s in sizes if s < _UNKNOWN_BYTES)


def partitions(df: DataFrame) -> int:
    """Partitions for a range sort of ``df``: by the size of its input, at least ``spark.sql.shuffle.partitions``."""
    least = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return max(least, min(MOST_PARTITIONS, -(-input_bytes(df) // PARTITION_BYTES)))
