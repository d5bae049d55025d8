"""Inputs: parquet tables, the test-data adapter views, catalog tables, task, text and inline sources."""

from visitlens.sources.actions import scan_actions, scan_users
from visitlens.sources.adapters import adapter_actions, adapter_users
from visitlens.sources.tables import TABLE_NAMES, read_table, table_path

__all__ = [
    "TABLE_NAMES",
    "adapter_actions",
    "adapter_users",
    "read_table",
    "scan_actions",
    "scan_users",
    "table_path",
]
