"""Sources and sinks: driver tables, derived entity tables, generator, table sinks."""

from ringwise.sources.tables import read_table
from ringwise.sources.fixtures import ClaimTables, derive_tables

__all__ = ["read_table", "ClaimTables", "derive_tables"]
