"""JSON and digest columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def decode_json(column: str | Column, schema: str) -> Column:
    """Parse JSON text to `schema`; blank or broken text gives an empty value."""
    col = F.col(column) if isinstance(column, str) else column
    return F.coalesce(F.from_json(col, schema, {"mode": "PERMISSIVE"}),
                      F.from_json(F.lit("{}"), schema))


def encode_json(columns: Sequence[str]) -> Column:
    """Row to JSON text, null fields included."""
    return F.to_json(F.struct(*columns), {"ignoreNullFields": "false"})


def content_digest(column: str, algorithm: str = "sha256") -> Column:
    if algorithm == "sha256":
        return F.sha2(F.col(column), 256)
    if algorithm == "md5":
        return F.md5(F.col(column))
    raise ValueError(f"unsupported digest {algorithm!r}")
