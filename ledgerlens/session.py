"""Session settings and durable intermediate storage."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Joins on an applicant are followed by an aggregate on the same key. Without the force flag the adaptive planner
# would rather keep that partitioning than split a hot applicant's partition.
RUNTIME_SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # Where every partition of a side turns out this small, hashing it beats sorting both sides.
    "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "64MB",
    "spark.sql.session.timeZone": "UTC",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the run-time SQL settings the operators are planned for."""
    for name, value in RUNTIME_SETTINGS.items():
        spark.conf.set(name, value)
    return spark


def local_session(cores: str = "8", memory: str = "16g") -> SparkSession:
    """A single-machine session for tests and the benchmark; clusters bring their own."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("ledgerlens")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", cores)
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for checkpoints, as named by the cluster.

    A folder of our own is chosen only for a local master that names none: on a cluster a machine-local folder would
    be lost together with its executor.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
    if not configured:
        if not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a shared folder")
        configured = tempfile.mkdtemp(prefix="ledgerlens-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir()


_run_folders: list[str] = []
_run_tables: dict[str, list[str]] = {}


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared checkpoint folder, within the folder of the current run if there is one."""
    base = _run_folders[-1] if _run_folders else checkpoint_dir(spark)
    return f"{base}/{name}-{uuid.uuid4().hex}"


@contextmanager
def run_scratch(spark: SparkSession) -> Iterator[None]:
    """Keep a run's intermediate tables in a folder of their own, which is deleted when the run ends."""
    folder = f"{checkpoint_dir(spark)}/run-{uuid.uuid4().hex}"
    _run_folders.append(folder)
    try:
        yield
    finally:
        _run_folders.remove(folder)
        for table in _run_tables.pop(folder, []):
            spark.sql(f"DROP TABLE IF EXISTS {table}")
        discard(spark, folder)


def discard(spark: SparkSession, folder: str) -> None:
    """Delete a scratch folder that nothing reads any more."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


#: Spark then deletes what a statement shuffled when the statement ends, not when the driver collects its garbage.
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def _shuffles_deleted(spark: SparkSession) -> Iterator[None]:
    """For writing a table that is read back: nothing reads its shuffles again."""
    before = spark.conf.get(SHUFFLE_CLEANUP, None)
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(SHUFFLE_CLEANUP)
        else:
            spark.conf.set(SHUFFLE_CLEANUP, before)


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write the rows as a Parquet table and read it back: columns are pruned per reader and lineage is cut."""
    path = scratch_path(df.sparkSession, name)
    with _shuffles_deleted(df.sparkSession):
        df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def unstaged(*tables: DataFrame) -> None:
    """Delete staged tables that nothing reads any more."""
    for table in tables:
        for folder in {path.rsplit("/", 1)[0] for path in table.inputFiles()}:
            discard(table.sparkSession, folder)


def bucketed(
    df: DataFrame, name: str, key: str, buckets: int | None = None, then: Callable[[DataFrame], DataFrame] = lambda dealt: dealt
) -> DataFrame:
    """Write the rows as a table dealt and sorted by a key: later joins on the key leave these rows where they are.

    ``then`` says what is made of the rows where they were dealt to; it keeps the key. The table lies in the scratch folder
    and is dropped with it at the end of a run.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    table = path.rsplit("/", 1)[-1].replace("-", "_")
    n = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    with _shuffles_deleted(spark):
        then(df.repartition(n, key)).write.bucketBy(n, key).sortBy(key).option("path", path).saveAsTable(table)
    if _run_folders:
        _run_tables.setdefault(_run_folders[-1], []).append(table)
    return spark.table(table)
