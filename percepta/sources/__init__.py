"""Sources and sinks: CSV scan/export, the fixture table over ``orders``."""

from percepta.sources.csv import preview, read_csv, read_input, write_csv
from percepta.sources.fixture import FIXTURE_SQL, passengers, passengers_from_orders, read_table

__all__ = [
    "FIXTURE_SQL",
    "passengers",
    "passengers_from_orders",
    "preview",
    "read_csv",
    "read_input",
    "read_table",
    "write_csv",
]
