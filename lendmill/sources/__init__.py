from lendmill.sources.files import read_csv_dir, read_parquet_table, register_table, table_path
from lendmill.sources.messages import MessageDir, MessageSource, Topic, read_messages

__all__ = [
    "MessageDir",
    "MessageSource",
    "Topic",
    "read_csv_dir",
    "read_messages",
    "read_parquet_table",
    "register_table",
    "table_path",
]
