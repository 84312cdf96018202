"""Tolerant scalar parsing.

All helpers return Column expressions built from built-in functions, so they
stay inside whole-stage codegen. Spark 4 runs with ANSI casts; the releases
rely on the lenient behaviour (bad text becomes null), which is rebuilt here
with ``try_cast`` / ``try_to_date``.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from relcast.functions.common import as_col

# Characters removed from money and count text before casting.
MONEY_CHARS_PATTERN = r"[$,%]"
# Suppression markers used by the releases.
GEO_MARKERS = ("*", "NA")
NOT_AVAILABLE = "N/A"

_NUMERIC_TEXT = r"^[+-]?[0-9]*([.][0-9]*)?$"
_INT_HEAD = r"^([+-]?[0-9]*)"


def strip_money(c) -> Column:
    """Remove ``$``, ``,`` and ``%``; a percent is not divided by 100."""
    return F.regexp_replace(as_col(c), MONEY_CHARS_PATTERN, "")


def lenient_int(c) -> Column:
    """Integer cast with the non-ANSI rules: ``12.5`` → 12, ``.5`` → 0,
    ``1e3`` / overflow / junk → null, surrounding spaces ignored."""
    v = F.trim(as_col(c).cast("string"))
    head = F.regexp_extract(v, _INT_HEAD, 1)
    head = F.when(head.isin("", "+", "-"), F.lit("0")).otherwise(head)
    ok = v.rlike(_NUMERIC_TEXT) & ~v.isin("", "+", "-")
    return F.when(ok, head.try_cast("int"))


def lenient_double(c) -> Column:
    return F.trim(as_col(c).cast("string")).try_cast("double")


def parse_int(c) -> Column:
    """T1 count parse: strip money characters, then lenient int."""
    return lenient_int(strip_money(c))


def parse_double(c) -> Column:
    """T1 money parse: strip money characters, then lenient double."""
    return lenient_double(strip_money(c))


def null_if(c, markers: Iterable[str]) -> Column:
    """The given marker strings become null, everything else is kept."""
    col = as_col(c)
    return F.when(~col.isin(*list(markers)) | col.isNull(), col)


def parse_date(c, fmt: str) -> Column:
    """Date with one format; text that does not parse becomes null."""
    return F.try_to_date(as_col(c).cast("string"), fmt)


#: Fixed value: two-digit years from this one on belong to the last century.
CENTURY_PIVOT = 69


def guessed_date(col: Column, fmt: str) -> Column:
    """A date in one of several declared formats; two-digit years below the pivot are 20xx, others 19xx."""
    parsed = F.try_to_date(col, fmt)
    if "yy" not in fmt or "yyyy" in fmt:
        return parsed
    return F.when(F.year(parsed) >= 2000 + CENTURY_PIVOT, F.add_months(parsed, -1200)).otherwise(parsed)


#: What the parts of a date format read, at the most: leading zeros and signs as the parser takes them.
_DATE_PARTS = {"yyyy": "[+-]?[0-9]{4,}", "yy": "[+-]?[0-9]{2}", "M": "[+-]?0*(?:[1-9]|1[0-2])", "MM": "[+-]?0*(?:[1-9]|1[0-2])",
               "d": "[+-]?0*(?:[1-9]|[12][0-9]|3[01])", "dd": "[+-]?0*(?:[1-9]|[12][0-9]|3[01])", "MMM": "[^0-9]+", "MMMM": "[^0-9]+"}


def date_shape(fmt: str) -> str | None:
    """A regular expression that matches every text that ``fmt`` reads, and few others; None if the format has other parts.

    A failed parse throws and catches an exception, which costs many times a match.
    """
    parts = re.findall(r"[A-Za-z]+|[-/, .]+|.", fmt, re.DOTALL)
    known = [_DATE_PARTS.get(x) if x.isalnum() else re.escape(x) for x in parts]
    if any(k is None for k in known) or re.search(r"['\[\]#{}]", fmt):
        return None
    return f"^{''.join(known)}$"


def parse_date_any(c, fmts: Sequence[str], strict: bool = False) -> Column:
    """The first of several declared formats that parses.

    ``strict`` fails the job (``raise_error``) on non-blank text no format
    accepts, which is what a raising parser does.
    """
    col = F.trim(as_col(c).cast("string"))
    parsed = F.coalesce(*[guessed_date(col, f) if len(fmts) > 1 else F.try_to_date(col, f) for f in fmts])
    if not strict:
        return parsed
    bad = parsed.isNull() & col.isNotNull() & (col != "")
    return F.when(bad, F.raise_error(F.concat(F.lit("unparseable date: "), col))).otherwise(parsed)


def pad_id(c, width: int = 6, fill: str = "0") -> Column:
    """Left-pad an identifier (``lpad`` semantics: longer input is cut)."""
    return F.lpad(as_col(c), width, fill)
