from .catalog import Catalog
from .readers import empty, read_csv, read_parquet, read_word_list, require_columns, small_table
from .writers import (
    preview,
    write_batches,
    write_csv,
    write_one_csv,
    write_parquet,
    write_quoted_csv,
    write_word_counts,
)

__all__ = [
    "Catalog", "empty", "preview", "read_csv", "read_parquet", "read_word_list",
    "require_columns", "small_table", "write_batches", "write_csv", "write_one_csv", "write_parquet",
    "write_quoted_csv", "write_word_counts",
]
