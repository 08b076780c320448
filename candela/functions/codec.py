"""Event codec: string maps <-> compact UTF-8 JSON bytes (the wire format of events)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MAP_DDL = "map<string,string>"


def _c(col: str | Column) -> Column:
    return F.col(col) if isinstance(col, str) else col


def map_to_json_bytes(col: str | Column) -> Column:
    """``map<string,string>`` -> compact JSON as binary; NULL stays NULL."""
    return F.to_json(_c(col)).cast("binary")


def json_bytes_to_map(col: str | Column) -> Column:
    """UTF-8 JSON bytes -> ``map<string,string>``; NULL or malformed -> NULL."""
    return F.from_json(_c(col).cast("string"), MAP_DDL, {"mode": "PERMISSIVE"})
