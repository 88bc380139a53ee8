from lendmill.sinks.files import export_csv, refresh_table, snapshot_table, write_parquet
from lendmill.sinks.keyed import read_keyed_table, upsert_keyed_table, write_keyed_table
from lendmill.sinks.messages import write_messages

__all__ = [
    "export_csv",
    "read_keyed_table",
    "refresh_table",
    "snapshot_table",
    "upsert_keyed_table",
    "write_keyed_table",
    "write_messages",
    "write_parquet",
]
