"""Readers, table sinks and the shared scratch area."""

from .readers import read_seed, read_table
from .schemas import CRASHES, REGION_SEED, REQUESTS
from .scratch import byte_count, materialize, materialize_measured, scratch_dir, scratch_path, temporary_tables
from .writers import database_for, recover_path, write_path, write_table

__all__ = [
    "CRASHES", "REGION_SEED", "REQUESTS", "byte_count", "database_for", "materialize", "materialize_measured",
    "read_seed", "read_table", "recover_path", "scratch_dir", "scratch_path", "temporary_tables", "write_path", "write_table",
]
