"""Readers, writers and the filtered extract."""

from tenderlens.sources.extract import extract_contracts, preview
from tenderlens.sources.files import (
    read_clean,
    read_json_records,
    read_raw_csv,
    write_clean,
    write_raw_csv,
)
from tenderlens.sources.shared import kept, shared_folder, shuffles_removed

__all__ = [
    "extract_contracts", "preview", "read_clean", "read_json_records", "read_raw_csv",
    "write_clean", "write_raw_csv", "kept", "shared_folder", "shuffles_removed",
]
