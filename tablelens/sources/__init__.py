from .tables import (
    DATE_FORMATS,
    coerce_dates,
    drop_columns_like,
    load_dataset,
    read_json_pages,
    read_table,
    resolve_dataset,
    write_result,
)

__all__ = [
    "DATE_FORMATS",
    "coerce_dates",
    "drop_columns_like",
    "load_dataset",
    "read_json_pages",
    "read_table",
    "resolve_dataset",
    "write_result",
]
