from .files import csv_schema, read_trips, stream_trips, with_arrival
from .layers import TABLES, Layers, without_metadata
from .lineitem import raw_trips, stream_table
from .rescued import file_ledger, stream_lines, with_rescued

__all__ = [
    "TABLES",
    "Layers",
    "csv_schema",
    "file_ledger",
    "raw_trips",
    "read_trips",
    "stream_lines",
    "stream_table",
    "stream_trips",
    "with_arrival",
    "with_rescued",
    "without_metadata",
]
