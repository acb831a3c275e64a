"""Scans and sinks."""

from textree.sources.csv import read_csv, read_feature_csv, write_csv
from textree.sources.files import file_manifest, file_present, materialize, newest
from textree.sources.json import read_jsonl, read_runs, unread_runs, write_report

__all__ = [
    "file_manifest",
    "file_present",
    "materialize",
    "newest",
    "read_csv",
    "read_feature_csv",
    "read_jsonl",
    "read_runs",
    "unread_runs",
    "write_csv",
    "write_report",
]
