"""The declared checks of the star and their report."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.joins import sized_join
from ..operators.quality import duplicates, missing, orphans, unaccepted
from ..sources.scratch import byte_count, materialize, materialize_observed


@dataclass(frozen=True)
class Check:
    """``kind`` is unique, not_null, relationships (needs ``parent``) or accepted_values (needs ``accepted``)."""

    table: str
    column: str
    kind: str
    parent: str | None = None
    accepted: tuple = ()


# Which columns are declared unique and not null, by table.
_UNIQUE = {
    "raw_requests": ("unique_key",),
    "stg_requests": ("complaint_id",),
    "stg_crashes": ("collision_id",),
    "date": ("date_key", "full_date"),
    "geography": ("geo_key",),
    "agency": ("agency_key",),
    "channel": ("channel_key",),
    "complaint": ("complaint_key",),
    "status": ("status_key", "status"),
    "factor": ("factor_key", "factor_desc"),
    "crash_time": ("crash_time_key", "hour"),
    "vehicle": ("vehicle_type_key", "vehicle_type_desc"),
    "fact_requests": ("fact_illegal_parking_key",),
    # The keys of dimensions are declared unique here too, which contradicts the grain of a fact; see the relationships.
    "fact_crashes": (
        "fact_mvc_key", "collision_id", "date_key", "geo_key", "crash_time_key", "factor_key", "vehicle_type_key",
    ),
}
_NOT_NULL = _UNIQUE | {
    "raw_crashes": ("collision_id",),
    "stg_requests": ("complaint_id", "created_date"),
    "fact_requests": ("fact_illegal_parking_key", "complaint_id", "date_key", "complaint_key", "complaint_count"),
    "fact_crashes": (
        "fact_mvc_key", "collision_id", "date_key", "geo_key", "crash_time_key", "factor_key", "vehicle_type_key",
    ),
}
_PARENTS = {
    "fact_requests": {
        "date_key": "date", "geo_key": "geography", "complaint_key": "complaint", "agency_key": "agency",
        "channel_key": "channel", "status_key": "status",
    },
    # Not declared, but what is meant by declaring these keys unique.
    "fact_crashes": {
        "date_key": "date", "geo_key": "geography", "crash_time_key": "crash_time", "factor_key": "factor",
        "vehicle_type_key": "vehicle",
    },
}

DECLARED: tuple[Check, ...] = (
    *[Check(t, c, "not_null") for t, columns in _NOT_NULL.items() for c in columns],
    *[Check(t, c, "unique") for t, columns in _UNIQUE.items() for c in columns],
    *[Check(t, c, "relationships", parent) for t, keys in _PARENTS.items() for c, parent in keys.items()],
    Check("fact_requests", "complaint_count", "accepted_values", accepted=(1,)),
)


def _countable(df: DataFrame, column: str) -> bool:
    """Whether equal values of the column have equal texts."""
    return not isinstance(df.schema[column].dataType, (T.FloatType, T.DoubleType, T.ArrayType, T.StructType, T.MapType, T.VariantType))


def _value_counts(table: str, df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(table_name, column_name, value, n_rows) of all ``columns`` in one pass over the table, combined before the shuffle."""
    values = [F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("value")) for c in columns]
    stacked = df.select(F.explode(F.array(*values)).alias("v")).select(F.lit(table).alias("table_name"), "v.*")
    return stacked.groupBy("table_name", "column_name", "value").agg(F.count("*").alias("n_rows"))


def _hash_counts(number: int, df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(i, h, n_rows): how often each hash of a value occurs; ``i`` numbers the columns from ``number`` on, h is NULL for NULL."""
    values = [F.struct(F.lit(number + k).alias("i"), F.when(F.col(c).isNotNull(), F.xxhash64(c)).alias("h")) for k, c in enumerate(columns)]
    return df.select(F.inline(F.array(*values))).groupBy("i", "h").agg(F.count("*").alias("n_rows"))


def _hashed_report(tables: Mapping[str, DataFrame], wanted: Mapping[str, Sequence[str]]) -> DataFrame:
    """(table_name, column_name, check_name, failures) of not_null and unique for columns that hardly repeat.

    First every value is a hash of 8 bytes; only values whose hash occurs twice are looked at themselves, in a second
    reading of their columns. Where no hash does, there is none.
    """
    numbers = {t: sum(len(c) for c in list(wanted.values())[:k]) for k, t in enumerate(wanted)}
    counts = reduce(DataFrame.unionByName, [_hash_counts(numbers[t], tables[t], c) for t, c in wanted.items()])
    repeated = counts.filter("n_rows > 1 OR h IS NULL")
    twice, seen = materialize_observed(repeated, "repeated", n=F.count("h"), bytes=byte_count(repeated))
    spark = twice.sparkSession
    # At most one row per checked column.
    suspect = {row.i for row in twice.filter("h IS NOT NULL").select("i").distinct().collect()} if seen["n"] else set()
    exact = []
    for t, columns in wanted.items():
        if suspect.isdisjoint(range(numbers[t], numbers[t] + len(columns))):
            continue
        values = [
            F.struct(F.lit(numbers[t] + k).alias("i"), F.xxhash64(c).alias("h"), F.col(c).cast("string").alias("value"))
            for k, c in enumerate(columns)
        ]
        rows = tables[t].select(F.inline(F.array(*values)))
        suspects = twice.filter("h IS NOT NULL").select(F.col("i").alias("_i"), F.col("h").alias("_h"))
        on = [(F.col("i"), F.col("_i")), (F.col("h"), F.col("_h"))]
        exact.append(sized_join(rows, suspects, on, "left_semi", size=seen["bytes"]).filter("value IS NOT NULL").groupBy("i", "value").agg(F.count("*").alias("n_rows")))
    found = twice.filter("h IS NULL").select("i", F.lit("not_null").alias("check_name"), F.col("n_rows").alias("failures"))
    if exact:
        again = reduce(DataFrame.unionByName, exact).filter("n_rows > 1").groupBy("i").agg(F.count("*").alias("failures"))
        found = found.unionByName(again.withColumn("check_name", F.lit("unique")))
    names = [(numbers[t] + k, t, c) for t, columns in wanted.items() for k, c in enumerate(columns)]
    named = spark.createDataFrame(names, "i int, table_name string, column_name string")
    return found.join(F.broadcast(named), "i").select("table_name", "column_name", "check_name", "failures")


def _failures(check: Check, tables: Mapping[str, DataFrame]) -> DataFrame:
    """The failures of one check on a column whose values cannot be counted as texts."""
    df = tables[check.table]
    failing, measure = {
        "not_null": lambda: (missing(df, check.column), F.count("*")),
        "unique": lambda: (duplicates(df, check.column), F.count("*")),
        "relationships": lambda: (orphans(df, check.column, tables[check.parent], check.column), F.sum("n_rows")),
        "accepted_values": lambda: (unaccepted(df, check.column, check.accepted), F.count("*")),
    }[check.kind]()
    return failing.agg(F.coalesce(measure, F.lit(0)).cast("bigint").alias("failures")).select(
        F.lit(check.table).alias("table_name"), F.lit(check.column).alias("column_name"),
        F.lit(check.kind).alias("check_name"), "failures",
    )


def run_checks(tables: Mapping[str, DataFrame], checks: Sequence[Check] = DECLARED) -> DataFrame:
    """(table_name, column_name, check_name, failures), one row per check on a given table.

    Failures count values for ``unique`` and ``accepted_values``, rows for the other two.
    The values of the columns that a relationship links are counted together in one reading of each table; of the other
    columns only hashes are, and the values themselves where a hash occurs twice. Columns of types without a text of their own
    (floating, nested) and keys whose type differs from the parent's are checked one by one.
    """
    mine = [k for k in checks if k.table in tables]

    def stacks(k: Check) -> bool:
        if not _countable(tables[k.table], k.column):
            return False
        return k.kind != "relationships" or (
            tables[k.parent].schema[k.column].dataType == tables[k.table].schema[k.column].dataType
        )

    together, alone = [k for k in mine if stacks(k)], [k for k in mine if not stacks(k)]
    reports = [_failures(k, tables) for k in alone]
    if together:
        reports.append(_stacked_report(tables, together))
    return reduce(DataFrame.unionByName, reports)


def _stacked_report(tables: Mapping[str, DataFrame], checks: Sequence[Check]) -> DataFrame:
    # Columns on either side of a relationship repeat, or are small: their values are counted themselves.
    wanted: dict[str, dict[str, None]] = {}
    for k in checks:
        for table in {"relationships": (k.table, k.parent), "accepted_values": (k.table,)}.get(k.kind, ()):
            wanted.setdefault(table, {})[k.column] = None
    hashed: dict[str, list[str]] = {}
    for k in checks:
        if k.column not in wanted.get(k.table, {}) and k.column not in hashed.setdefault(k.table, []):
            hashed[k.table].append(k.column)
    hashed = {t: columns for t, columns in hashed.items() if columns}
    where = ["table_name", "column_name"]
    parts = [_counted_report(tables, checks, wanted)] if wanted else []
    parts += [_hashed_report(tables, hashed)] if hashed else []
    each = reduce(DataFrame.unionByName, parts)
    # One row per declared check, also for a table without rows.
    asked = each.sparkSession.createDataFrame([(k.table, k.column, k.kind) for k in checks], "table_name string, column_name string, check_name string")
    return asked.join(each, [*where, "check_name"], "left").select(
        *where, "check_name", F.coalesce("failures", F.lit(0)).cast("bigint").alias("failures")
    )


def _counted_report(tables: Mapping[str, DataFrame], checks: Sequence[Check], wanted: Mapping[str, Mapping[str, None]]) -> DataFrame:
    """(table_name, column_name, check_name, failures) from the counts of all values of the columns ``wanted``."""
    counts = materialize(reduce(DataFrame.unionByName, [_value_counts(t, tables[t], list(c)) for t, c in wanted.items()]), "values")
    spark, where = counts.sparkSession, ["table_name", "column_name"]

    known = F.lit(True)
    for k in checks:
        if k.kind == "accepted_values":
            kind = tables[k.table].schema[k.column].dataType
            listed = [F.lit(v).cast(kind).cast("string") for v in k.accepted]
            known = F.when((F.col("table_name") == k.table) & (F.col("column_name") == k.column), F.col("value").isin(*listed)).otherwise(known)
    present = F.col("value").isNotNull()
    each = counts.groupBy(*where).agg(
        F.sum(F.when(present, 0).otherwise(F.col("n_rows"))).alias("not_null"),
        F.count_if(present & (F.col("n_rows") > 1)).alias("unique"),
        F.count_if(present & ~known).alias("accepted_values"),
    ).unpivot(where, ["not_null", "unique", "accepted_values"], "check_name", "failures")

    links = [(k.table, k.column, k.parent) for k in checks if k.kind == "relationships"]
    if links:
        link = spark.createDataFrame(links, "table_name string, column_name string, parent string")
        children = counts.filter(present).join(F.broadcast(link), where)  # one row per declared relationship
        parents = counts.select(F.col("table_name").alias("parent"), "column_name", "value")
        lost = children.join(parents, ["parent", "column_name", "value"], "left_anti")
        each = each.unionByName(
            lost.groupBy(*where).agg(F.sum("n_rows").alias("failures")).withColumn("check_name", F.lit("relationships"))
        )
    return each
