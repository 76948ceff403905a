"""Text column functions: case conversion, JSON fields, keys and paths."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed patterns (must stay as written): camelCase -> snake_case in two passes.
CAMEL_WORD = "(.)([A-Z][a-z]+)"
CAMEL_EDGE = "([a-z0-9])([A-Z])"
# Ordinal of a rejected record inside an error line, e.g. "/12/".
ORDINAL_PATTERN = "/(\\d+)/"


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def snake_case(col) -> Column:
    """``vehicleIdentificationNumber`` -> ``vehicle_identification_number`` on column values."""
    first = F.regexp_replace(_c(col), CAMEL_WORD, "$1_$2")
    return F.lower(F.regexp_replace(first, CAMEL_EDGE, "$1_$2"))


def snake_case_name(name: str) -> str:
    """The same rule for a column *name* (driver side, names only)."""
    return re.sub(CAMEL_EDGE, r"\1_\2", re.sub(CAMEL_WORD, r"\1_\2", name)).lower()


def snake_case_columns(df: DataFrame) -> DataFrame:
    return df.withColumnsRenamed({c: snake_case_name(c) for c in df.columns})


def message_type(body, default: str = "unknown") -> Column:
    """Top-level ``type`` of a JSON message, ``default`` when absent or unparseable."""
    return F.coalesce(F.get_json_object(_c(body), "$.type"), F.lit(default))


def key_segment(key, index: int) -> Column:
    """1-based segment of a ``/``-separated key; negative counts from the end."""
    return F.try_element_at(F.split(_c(key), "/"), F.lit(index))


def file_stem(path) -> Column:
    """``a/b/20240131_x.csv`` -> ``20240131_x``."""
    last = F.element_at(F.split(_c(path), "/"), -1)
    return F.regexp_replace(last, "\\.[^.]*$", "")


def url_decode_plus(col) -> Column:
    """Percent-decoding with ``+`` read as a blank; malformed input -> NULL."""
    return F.try_url_decode(_c(col))


def anchored(pattern: str) -> str:
    """Full-match form of a regex: ``x.csv`` must not match ``x.csv.bak``."""
    p = pattern
    if not p.startswith("^"):
        p = "^" + p
    if not p.endswith("$"):
        p = p + "$"
    return p
