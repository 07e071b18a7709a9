"""Columns taken from a file path, and path arguments of the jobs."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The naming of the landed files and day folders.
VISITORS_FILE = r"visitors_([A-Za-z0-9]+)_page"
MEDIAS_FILE = r"medias_([A-Za-z0-9]+)"
METADATA_FILE = r"metadata_([A-Za-z0-9]+)"
ANY_FILE = r"^(?:medias|metadata|visitors)_([A-Za-z0-9]+).*\.ndjson$"
DAY_FOLDER = "/dt="
DAY = r"^([0-9]{4}-[0-9]{2}-[0-9]{2})/"


def file_name(path: Column) -> Column:
    return F.substring_index(path, "/", -1)


def id_from_path(path: Column, pattern: str = ANY_FILE) -> Column:
    """Media id in the file name, null where the name does not match."""
    return F.nullif(F.regexp_extract(file_name(path), pattern, 1), F.lit(""))


def dt_from_path(path: Column) -> Column:
    """Day of the innermost ``dt=`` folder as a date, null where there is none."""
    behind = F.substring_index(path, DAY_FOLDER, -1)
    return F.try_to_date(F.regexp_extract(behind, DAY, 1))


def bronze_root(base: str, sub_folder: str = "") -> str:
    """Base path without trailing slash, ending in ``sub_folder``."""
    base = base.rstrip("/")
    if sub_folder and not base.endswith(f"/{sub_folder}"):
        base = f"{base}/{sub_folder}"
    return base
