"""Struct helper."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def record(**fields: Column) -> Column:
    """Struct with explicit field names.

    ``F.struct`` takes names from aliases, which do not survive inside some nested
    expressions; named fields always do.
    """
    parts: list[Column] = []
    for name, value in fields.items():
        parts += [F.lit(name), value]
    return F.named_struct(*parts)
