"""File sources: JSON lines, CSV, Parquet and label catalogues."""

from starmart.sources.files import (
    expand_paths,
    first_per_file,
    line_count,
    preview,
    read_csv_files,
    read_immigration,
    read_json_auto,
    read_json_glob,
    read_json_paths,
    read_json_tree,
    read_table,
)
from starmart.sources.labels import city_codes, code_map, code_map_from_dict, read_catalogue, section_codes

__all__ = [
    "city_codes",
    "code_map",
    "code_map_from_dict",
    "expand_paths",
    "first_per_file",
    "line_count",
    "preview",
    "read_catalogue",
    "read_csv_files",
    "read_immigration",
    "read_json_auto",
    "read_json_glob",
    "read_json_paths",
    "read_json_tree",
    "read_table",
    "section_codes",
]
