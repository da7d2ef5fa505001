from almanac.sources.shared import delete_path, discard, finished, materialise, reused, scratch, shared_folder, shared_path
from almanac.sources.store import read_observations, write_csv, write_observations
from almanac.sources.text import classified_lines, parse_legacy, parse_lines, read_lines, rejected_lines, unread_lines

__all__ = [
    "classified_lines",
    "delete_path",
    "discard",
    "finished",
    "materialise",
    "parse_legacy",
    "parse_lines",
    "read_lines",
    "read_observations",
    "rejected_lines",
    "reused",
    "scratch",
    "shared_folder",
    "shared_path",
    "unread_lines",
    "write_csv",
    "write_observations",
]
