"""Stored tables whose replacement is a single step: a version is written whole, then one pointer file is moved to it.

A table's folder holds its versions, each a folder of its own, and the pointer, a small file that names the current one and
says what it was made from. Whoever reads the table follows the pointer, so a write that fails midway, or a reader that comes
while one goes on, sees the version before. A run's own pointer names the versions of all its tables and is moved last, so
``open_run`` gives tables that belong together; versions that no pointer names are deleted then.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from ledgerlens.session import discard

POINTER = "_current"


def _path(spark: SparkSession, path: str):
    return spark._jvm.org.apache.hadoop.fs.Path(path)


def _system(spark: SparkSession, path: str):
    return _path(spark, path).getFileSystem(spark._jsc.hadoopConfiguration())


def read_pointer(spark: SparkSession, folder: str) -> dict | None:
    """What the folder's pointer says; None where there is none."""
    pointer = f"{folder}/{POINTER}"
    if not _system(spark, pointer).exists(_path(spark, pointer)):
        return None
    stream = _system(spark, pointer).open(_path(spark, pointer))
    try:
        return json.loads(bytes(stream.readAllBytes()).decode())
    finally:
        stream.close()


def move_pointer(spark: SparkSession, folder: str, content: Mapping[str, object]) -> None:
    """Write the pointer beside its place and rename it over the old one."""
    fresh, pointer = f"{folder}/{POINTER}-{uuid.uuid4().hex}", f"{folder}/{POINTER}"
    stream = _system(spark, folder).create(_path(spark, fresh), True)
    try:
        stream.write(bytearray(json.dumps(content).encode()))
    finally:
        stream.close()
    files = spark._jvm.org.apache.hadoop.fs
    over = spark.sparkContext._gateway.new_array(files.Options.Rename, 1)
    over[0] = files.Options.Rename.OVERWRITE
    context = files.FileContext.getFileContext(_system(spark, folder).getUri(), spark._jsc.hadoopConfiguration())
    context.rename(_path(spark, fresh), _path(spark, pointer), over)


def new_version(folder: str) -> str:
    return f"{folder}/version-{uuid.uuid4().hex}"


def current(spark: SparkSession, folder: str) -> str:
    """The folder of the current version, or the folder itself where there are no versions."""
    pointer = read_pointer(spark, folder)
    return f"{folder}/{pointer['version']}" if pointer else folder


def read_table(spark: SparkSession, folder: str, schema: StructType | None = None) -> DataFrame:
    reader = spark.read.schema(schema) if schema else spark.read
    return reader.parquet(current(spark, folder))


def replace_table(df: DataFrame, folder: str, made_from: str = "") -> DataFrame:
    """Write a new version, move the pointer to it, and return it as stored."""
    path = new_version(folder)
    df.write.parquet(path)
    move_pointer(df.sparkSession, folder, {"version": path.rsplit("/", 1)[1], "made_from": made_from})
    return df.sparkSession.read.schema(df.schema).parquet(path)


def commit_run(spark: SparkSession, base: str, tables: list[str], others: list[str]) -> None:
    """Let the run's pointer name the current versions of its tables and other results, then delete what it no longer names."""
    named = {name: read_pointer(spark, f"{base}/{name}")["version"] for name in [*tables, *others]}
    move_pointer(spark, base, {"tables": {t: named[t] for t in tables}, "others": {o: named[o] for o in others}})
    for name, version in named.items():
        for status in _system(spark, base).listStatus(_path(spark, f"{base}/{name}")):
            found = status.getPath().getName()
            if found.startswith("version-") and found != version:
                discard(spark, f"{base}/{name}/{found}")


def open_run(spark: SparkSession, base: str) -> dict[str, DataFrame]:
    """The tables of the last run that came to its end."""
    pointer = read_pointer(spark, base)
    if pointer is None:
        raise ValueError(f"no finished run in {base}")
    return {name: spark.read.parquet(f"{base}/{name}/{version}") for name, version in pointer["tables"].items()}


def fingerprint_of_files(spark: SparkSession, path: str) -> str | None:
    """Length and time of change of a file, or of the files of a folder; None where there is nothing."""
    system = _system(spark, path)
    if not system.exists(_path(spark, path)):
        return None
    return ";".join(
        sorted(f"{s.getPath().getName()}:{s.getLen()}:{s.getModificationTime()}" for s in system.listStatus(_path(spark, path)))
    )
