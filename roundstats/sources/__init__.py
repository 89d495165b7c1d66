"""Sources: text files and parquet tables."""

from roundstats.sources.tables import TABLES, table
from roundstats.sources.text import (
    documents_from,
    numbers_from,
    points_from,
    points_from_lines,
    read_documents,
    read_numbers,
    read_points,
    rejected_number_tokens,
    rejected_point_lines,
)

__all__ = [
    "TABLES",
    "documents_from",
    "numbers_from",
    "points_from",
    "points_from_lines",
    "read_documents",
    "read_numbers",
    "read_points",
    "rejected_number_tokens",
    "rejected_point_lines",
    "table",
]
