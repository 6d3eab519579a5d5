"""Reading and writing files, tables and message batches."""

from .files import (
    read_bronze,
    read_csv_inferred,
    read_csv_strings,
    read_json_records,
    read_parquet_glob,
    register_json_table,
    with_row_locator,
)
from .messages import decode_messages, encode_messages
from .sinks import load_full_refresh, write_data_dictionary, write_tables

__all__ = [
    "decode_messages",
    "encode_messages",
    "load_full_refresh",
    "read_bronze",
    "read_csv_inferred",
    "read_csv_strings",
    "read_json_records",
    "read_parquet_glob",
    "register_json_table",
    "with_row_locator",
    "write_data_dictionary",
    "write_tables",
]
