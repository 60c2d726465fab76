"""Sources and sinks."""

from stayvalue.sources.csv_files import read_csv_columns, read_listings_csv, read_reviews_csv
from stayvalue.sources.keyed import open_by_key, write_by_key
from stayvalue.sources.writers import (
    export_csv,
    export_parts,
    scratch_path,
    shared_folder,
    write_table,
)

__all__ = [
    "export_csv",
    "export_parts",
    "open_by_key",
    "read_csv_columns",
    "read_listings_csv",
    "read_reviews_csv",
    "scratch_path",
    "shared_folder",
    "write_by_key",
    "write_table",
]
