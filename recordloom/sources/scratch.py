"""Intermediate tables in the folder the cluster shares for checkpoints.

Writing an intermediate result as parquet cuts its lineage, survives the loss of
executors, keeps column pruning for its readers and gives an exact size to
measure before anything is broadcast.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def scratch_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder of the session.

    Only a local session without one gets a temporary folder of its own.
    """
    context = spark.sparkContext
    shared = (
        spark.conf.get("spark.checkpoint.dir", None)
        or context.getConf().get("spark.checkpoint.dir")
        or context.getCheckpointDir()
    )
    if shared:
        return shared.rstrip("/")
    if not context.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="recordloom-"))
    return context.getCheckpointDir().rstrip("/")


# Folders written since the innermost ``temporary_tables`` of this context began.
_owned: ContextVar[list[str] | None] = ContextVar("_owned", default=None)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path for one intermediate table."""
    folder = f"{scratch_dir(spark)}/recordloom/{uuid.uuid4().hex}"
    owned = _owned.get()
    if owned is not None:
        owned.append(folder)
    return f"{folder}/{name}"


@contextmanager
def temporary_tables(spark: SparkSession) -> Iterator[None]:
    """Delete the scratch tables of the block when it ends, also after a failure.

    For blocks that save their results; a frame that still reads a scratch table is of no use afterwards.
    """
    owned: list[str] = []
    token = _owned.set(owned)
    try:
        yield
    finally:
        _owned.reset(token)
        for folder in owned:
            delete_path(spark, folder)


def delete_path(spark: SparkSession, folder: str) -> None:
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


# Bytes of a row group. Readers often do more with a row than its writer did, so what one task
# wrote should be open to several.
ROW_GROUP = 8 << 20


def materialize(df: DataFrame, name: str = "table") -> DataFrame:
    """Write ``df`` once to the shared folder and return a scan of the written table."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.mode("overwrite").option("parquet.block.size", ROW_GROUP).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def _width(kind: T.DataType) -> int | None:
    """Bytes of a value of a type whose values all take the same room, its slot and null bits included."""
    if isinstance(kind, T.StructType):
        fields = [_width(f.dataType) for f in kind.fields]
        return None if None in fields else 16 + sum(fields)
    if isinstance(kind, (T.StringType, T.BinaryType, T.ArrayType, T.MapType, T.VariantType)):
        return None
    return 24 if isinstance(kind, T.DecimalType) and kind.precision > 18 else 8


def _bytes(value: Column, kind: T.DataType) -> Column:
    """Bytes of one value in Spark's row format; a NULL counts as an empty value."""
    width = _width(kind)
    if width is not None:
        return F.lit(width).cast("bigint")
    if isinstance(kind, T.ArrayType):
        each = _width(kind.elementType)
        if each is not None:
            return F.coalesce(F.greatest(F.size(value), F.lit(0)), F.lit(0)) * F.lit(each).cast("bigint") + 32
        start = F.lit(0).cast("bigint")
        total = F.aggregate(value, start, lambda n, e: n + _bytes(e, kind.elementType))
        return F.coalesce(total, start) + 32
    if isinstance(kind, T.MapType):
        keys = _bytes(F.map_keys(value), T.ArrayType(kind.keyType))
        return keys + _bytes(F.map_values(value), T.ArrayType(kind.valueType))
    if isinstance(kind, T.StructType):
        return reduce(Column.__add__, [_bytes(value.getField(f.name), f.dataType) for f in kind.fields], F.lit(16).cast("bigint"))
    return F.coalesce(F.octet_length(value.cast("string")), F.lit(0)).cast("bigint") + 16


def byte_count(df: DataFrame) -> Column:
    """An aggregate: what all rows take in memory, with 16 bytes a column for null bits, padding and the row's place."""
    values = [_bytes(F.col(f"`{f.name}`"), f.dataType) + 16 for f in df.schema.fields]
    return F.coalesce(F.sum(reduce(Column.__add__, values, F.lit(0).cast("bigint"))), F.lit(0).cast("bigint"))


def materialize_observed(df: DataFrame, name: str = "table", **metrics: Column) -> tuple[DataFrame, dict]:
    """``materialize``, and aggregates over the rows taken while they are written."""
    seen = Observation()
    table = materialize(df.observe(seen, *[c.alias(n) for n, c in metrics.items()]), name)
    return table, seen.get


def materialize_measured(df: DataFrame, name: str = "table") -> tuple[DataFrame, int]:
    """``materialize`` and the size in bytes, counted while the table is written."""
    table, seen = materialize_observed(df, name, bytes=byte_count(df))
    return table, seen["bytes"]
