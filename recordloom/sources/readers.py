"""Scans. Schemas are given, never inferred, so planning reads no data."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .schemas import REGION_SEED


def read_table(spark: SparkSession, path: str, schema: T.StructType | None = None, fmt: str = "parquet") -> DataFrame:
    """Scan a raw feed. Without a schema, parquet takes the one in its footers."""
    reader = spark.read.format(fmt)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.load(path)


def read_seed(spark: SparkSession, path: str, schema: T.StructType = REGION_SEED) -> DataFrame:
    """Scan a CSV seed, taking the columns of ``schema`` by their names in the header and forcing their types.

    Polygon text contains commas and may span lines, hence the quoting options, with which
    each file is one task. A missing column or a row with too few or too many fields fails.
    """
    found = (
        spark.read.option("header", True)
        .option("inferSchema", False)
        .option("mode", "FAILFAST")
        .option("quote", '"')
        .option("escape", '"')
        .option("multiLine", True)
        .csv(path)
    )
    missing = [f.name for f in schema if f.name not in found.columns]
    if missing:
        raise ValueError(f"the seed has no column {', '.join(missing)}")
    return found.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema])
