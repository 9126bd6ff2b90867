"""Readers, writers and the shared working folder."""

from .delimited import CORRUPT_COLUMN, ingest_csv, scan_csv, split_corrupt
from .publish import newest_version, publish, retire_versions
from .schemas import TRANSACTIONS_SCHEMA, ColumnRoles, TRANSACTION_ROLES
from .shared import shared_path, stage
from .tables import scan_parquet, write_csv, write_json, write_partitioned

__all__ = [
    "CORRUPT_COLUMN",
    "ColumnRoles",
    "TRANSACTIONS_SCHEMA",
    "TRANSACTION_ROLES",
    "ingest_csv",
    "newest_version",
    "publish",
    "retire_versions",
    "scan_csv",
    "scan_parquet",
    "shared_path",
    "split_corrupt",
    "stage",
    "write_csv",
    "write_json",
    "write_partitioned",
]
