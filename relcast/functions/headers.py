"""Header handling (H1-H3): normalised names, legacy renames, collisions.

Column names are metadata, so they are resolved on the driver; the data is
only touched through one positional ``toDF`` / ``select`` per header.
"""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame

_NON_WORD = re.compile(r"\W+")


def normalise_name(raw: str) -> str:
    """Lower-case, spaces to ``_``, drop every other non-word character."""
    return _NON_WORD.sub("", raw.lower().replace(" ", "_"))


class HeaderError(ValueError):
    """Two source columns end up under one name."""


def resolve_header(raw: Sequence[str], renames: Mapping[str, str] | None = None) -> list[str]:
    """Normalised, legacy-renamed names for a raw header, in order.

    Fails with the offending names when two columns collide, e.g. an old and a
    new name both present, or names equal after normalisation.
    """
    renames = renames or {}
    names = [renames.get(n, n) for n in (normalise_name(r) for r in raw)]
    seen: dict[str, str] = {}
    for r, n in zip(raw, names):
        if n in seen:
            raise HeaderError(f"columns {seen[n]!r} and {r!r} both map to {n!r}")
        seen[n] = r
    return names


def normalise_header(df: DataFrame, renames: Mapping[str, str] | None = None) -> DataFrame:
    """Rename every column by position (safe with dots, case and duplicates)."""
    return df.toDF(*resolve_header(df.columns, renames))


def rename_legacy(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    """Old column name → current name; fails if both are present."""
    present = set(df.columns)
    clash = [(o, n) for o, n in mapping.items() if o in present and n in present and o != n]
    if clash:
        raise HeaderError(f"old and new column both present: {clash}")
    return df.withColumnsRenamed({o: n for o, n in mapping.items() if o in present})
