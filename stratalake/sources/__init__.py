from stratalake.sources.events import (
    accepted,
    committed_files,
    decode_events,
    decode_lines,
    event_lines,
    files_outside_log,
    read_events,
)
from stratalake.sources.published import Conflict, Written, publish, read_table, retire, snapshot, table_profile
from stratalake.sources.readers import csv_variants, read_csv, read_csv_text, read_parquet
from stratalake.sources.writers import land_csv, write_parquet, write_partitioned

__all__ = [
    "Conflict",
    "Written",
    "accepted",
    "committed_files",
    "csv_variants",
    "decode_events",
    "decode_lines",
    "event_lines",
    "files_outside_log",
    "land_csv",
    "publish",
    "read_csv",
    "read_csv_text",
    "read_events",
    "read_parquet",
    "read_table",
    "retire",
    "snapshot",
    "table_profile",
    "write_parquet",
    "write_partitioned",
]
