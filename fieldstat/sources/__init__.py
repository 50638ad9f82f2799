"""Sources and sinks (JSON, Parquet, CSV, binary listing) and table helpers."""

from fieldstat.sources.io import (
    RAW_EVENT_SCHEMA,
    bounded,
    dataset_size,
    load_features,
    manifest,
    read_csv,
    read_events,
    read_parquet,
    register,
    save_features,
    union_available,
    with_file_key,
    write_csv,
    write_parquet,
)

__all__ = [
    "RAW_EVENT_SCHEMA", "bounded", "dataset_size", "load_features", "manifest",
    "read_csv", "read_events", "read_parquet", "register", "save_features",
    "union_available", "with_file_key", "write_csv", "write_parquet",
]
