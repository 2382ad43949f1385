"""Readers: files, seeds, stored pages and event streams."""

from farebox.sources.events import bounded_counts, parse_events, read_event_files, read_event_topic, stream_event_files
from farebox.sources.files import (
    external_view,
    first_rows,
    month_units,
    profile,
    read_csv,
    read_json_list,
    read_parquet,
    read_units,
)
from farebox.sources.pages import land_pages, read_pages, write_pages
from farebox.sources.seeds import load_seed

__all__ = [
    "bounded_counts", "external_view", "first_rows", "land_pages", "load_seed", "month_units", "parse_events", "profile",
    "read_csv", "read_event_files", "read_event_topic", "read_json_list", "read_pages", "read_parquet",
    "read_units", "stream_event_files", "write_pages",
]
