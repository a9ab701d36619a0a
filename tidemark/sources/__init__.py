from tidemark.sources.jdbc import DatabaseConfig, read_jdbc, write_jdbc
from tidemark.sources.series import integer_series
from tidemark.sources.snapshot import read_snapshot
from tidemark.sources.synth import doctors, ensure_table, grow, patients
from tidemark.sources.target import TargetTable, append_bucketed, create_catalog_table

__all__ = [
    "DatabaseConfig",
    "TargetTable",
    "append_bucketed",
    "create_catalog_table",
    "doctors",
    "ensure_table",
    "grow",
    "integer_series",
    "patients",
    "read_jdbc",
    "read_snapshot",
    "write_jdbc",
]
