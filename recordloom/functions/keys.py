"""Hashed surrogate keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: what a NULL field contributes to a key, so that NULL and '' differ.
NULL_FIELD = "_dbt_utils_surrogate_key_null_"


def surrogate_key(*fields: Column | str) -> Column:
    """Hex md5 of the fields as text, joined by a dash."""
    columns = [F.col(f) if isinstance(f, str) else f for f in fields]
    return F.md5(F.concat_ws("-", *[F.coalesce(c.cast("string"), F.lit(NULL_FIELD)) for c in columns]))
