"""Table scans, the test-data adapter and sinks."""

from orderlens.sources.tables import (
    SourceTables,
    read_csv_tables,
    read_snapshot,
    read_translation,
    translate_categories,
    write_csv_tables,
)
from orderlens.sources.testdata import load_testdata

__all__ = [
    "SourceTables",
    "read_csv_tables",
    "read_snapshot",
    "read_translation",
    "translate_categories",
    "write_csv_tables",
    "load_testdata",
]
