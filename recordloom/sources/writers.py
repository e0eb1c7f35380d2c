"""Full-refresh sinks and the routing of layers to databases."""

from __future__ import annotations

import time
import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession

from .scratch import delete_path


def database_for(layer: str, layers: Mapping[str, str | None], default: str) -> str:
    """The database of a layer: its configured name, trimmed and otherwise verbatim, else the default."""
    custom = layers.get(layer)
    return default if custom is None else custom.strip()


def _moved(spark: SparkSession, source: str, target: str) -> None:
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path
    files = path(source).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not files.rename(path(source), path(target)):
        raise OSError(f"could not move {source} to {target}")


def _folders(spark: SparkSession, pattern: str) -> list[str]:
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(pattern)
    found = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(path)
    return sorted(str(f.getPath()) for f in found or [])


def recover_path(spark: SparkSession, path: str) -> bool:
    """Bring back the table of a writer that died between taking the old one away and putting the new one there."""
    folder, _, name = path.rstrip("/").rpartition("/")
    aside = _folders(spark, f"{folder}/_replaced-{name}-*")
    if not aside or _folders(spark, path):
        return False
    _moved(spark, aside[-1], path)
    return True


def write_path(df: DataFrame, path: str, fmt: str = "parquet", partition_by: Sequence[str] = ()) -> DataFrame:
    """Replace the table at ``path`` and return a scan of it.

    The rows are written beside it first, so a job that fails leaves the old table as it is, and ``df`` may
    read the table it replaces. Publishing is two renames: atomic on file systems whose renames are, but for the instant between
    the two; a writer that dies there is made good by the next one, or by ``recover_path``.
    """
    spark, path = df.sparkSession, path.rstrip("/")
    recover_path(spark, path)
    folder, _, name = path.rpartition("/")
    mark = f"{name}-{time.time_ns()}-{uuid.uuid4().hex}"
    staged, aside = f"{folder}/_staged-{mark}", f"{folder}/_replaced-{mark}"
    try:
        df.write.mode("error").format(fmt).partitionBy(*partition_by).save(staged)
        replaces = bool(_folders(spark, path))
        if replaces:
            _moved(spark, path, aside)
        try:
            _moved(spark, staged, path)
        except BaseException:
            if replaces:
                _moved(spark, aside, path)
            raise
    finally:
        delete_path(spark, staged)
    for left in _folders(spark, f"{folder}/_replaced-{name}-*"):
        delete_path(spark, left)
    spark.catalog.refreshByPath(path)
    return spark.read.format(fmt).schema(df.schema).load(path)


def _tables(spark: SparkSession, database: str, prefix: str) -> list[str]:
    return sorted(t.name for t in spark.catalog.listTables(f"`{database}`") if t.name.startswith(prefix))


def write_table(
    df: DataFrame, table: str, database: str, fmt: str = "parquet", partition_by: Sequence[str] = ()
) -> DataFrame:
    """Replace ``database.table`` (creating the database if needed) and return a scan of it.

    Like ``write_path``: written under another name, then the two tables change names.
    """
    spark = df.sparkSession
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}`")
    mark = f"{table}_{time.time_ns()}_{uuid.uuid4().hex}".lower()
    name, staged, aside = (f"`{database}`.`{n}`" for n in (table, f"staged_{mark}", f"replaced_{mark}"))

    def renamed(old: str, new: str) -> None:
        spark.sql(f"ALTER TABLE {old} RENAME TO {new}")

    lost = _tables(spark, database, f"replaced_{table}_".lower())
    if lost and not spark.catalog.tableExists(name):
        renamed(f"`{database}`.`{lost[-1]}`", name)
    try:
        df.write.mode("error").format(fmt).partitionBy(*partition_by).saveAsTable(staged)
        replaces = spark.catalog.tableExists(name)
        if replaces:
            renamed(name, aside)
        try:
            renamed(staged, name)
        except BaseException:
            if replaces:
                renamed(aside, name)
            raise
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {staged}")
    for left in _tables(spark, database, f"replaced_{table}_".lower()):
        spark.sql(f"DROP TABLE IF EXISTS `{database}`.`{left}`")
    return spark.table(name)
