"""Small shared helpers for Column building."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_col(c) -> Column:
    """Accept a column name or a Column."""
    return c if isinstance(c, Column) else F.col(c)


def free_name(taken: Iterable[str], name: str) -> str:
    """``name``, with underscores in front until it is none of ``taken`` (compared without case)."""
    used = {t.lower() for t in taken}
    while name.lower() in used:
        name = "_" + name
    return name
