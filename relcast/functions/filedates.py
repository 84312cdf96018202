"""Dates and names derived from file paths and URLs.

Each release family encodes its period in the file name differently. The rules
are declared by name so a :class:`relcast.spec.TableSpec` can refer to them;
every rule is a Column expression over the path column.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from relcast.functions.common import as_col

# The date used for enrolment files whose name carries no date.
UNDATED_ENROLMENT_DATE = "2022-11-30"
# Formats tried for day-precision dates in file names, in order.
DAY_FORMATS = ("yyyyMMdd", "MMddyyyy", "yyyy-MM-dd", "MM-dd-yyyy", "M-d-yyyy", "yyyy.MM.dd")


def name_of(path) -> Column:
    return F.substring_index(as_col(path), "/", -1)


def stem_of(path) -> Column:
    """File name without its last extension."""
    return F.regexp_replace(name_of(path), r"(?<=.)\.[^.]*$", "")


def year_end(year_text) -> Column:
    """``YYYY`` text → Dec 31 of that year (null if not a year)."""
    y = as_col(year_text)
    return F.when(y.rlike(r"^[0-9]{4}$"), F.make_date(y.cast("int"), F.lit(12), F.lit(31)))


def _coded_year(stem: Column, letter: str) -> Column:
    """Year coded as ``_<letter>[y]NN_`` (20NN) or ``_<letter>[y]NNNN_`` (as written)."""
    g = F.regexp_extract(F.lower(stem), rf"_{letter}y*([0-9]+)_", 1)
    return F.when(F.length(g) == 4, g).when(g != "", F.concat(F.lit("20"), g))


def _day(text: Column, fmts=DAY_FORMATS) -> Column:
    return F.coalesce(*[F.try_to_date(text, f) for f in fmts])


def _nth_token(stem: Column, n: int) -> Column:
    return F.element_at(F.split(stem, "_"), n)


def file_date(path, rule: str) -> Column:
    """Period date of a release file by naming rule."""
    stem = stem_of(path)
    if rule == "data_year":            # ..._d13_... / _dy13_ → 2013-12-31
        return year_end(_coded_year(stem, "d"))
    if rule == "stem_year_slice":      # data year = stem[-5:-1]
        return year_end(F.substring(stem, -5, 4))
    if rule == "last4_year":           # ..._2022 → 2022-12-31
        return year_end(F.substring(stem, -4, 4))
    if rule == "token2_year":          # x_2023_y → 2023-12-31
        return year_end(_nth_token(stem, 2))
    if rule == "month_year":           # _March2024 → 2024-03-01
        month = F.regexp_replace(F.regexp_extract(stem, r"_(\w+)(\d{4})", 1), r"^.*_", "")
        year = F.regexp_extract(stem, r"_(\w+)(\d{4})", 2)
        text = F.concat_ws(" ", month, F.lit("01"), year)
        return F.coalesce(F.try_to_date(text, "MMMM dd yyyy"), F.try_to_date(text, "MMM dd yyyy"))
    if rule == "token2_day":           # x_20240105_y → that day
        return _day(_nth_token(stem, 2))
    if rule == "last_token_day":       # x_01052024 (MMddyyyy) or x_20231204 (yyyyMMdd)
        return _day(F.element_at(F.split(stem, "_"), -1), ("MMddyyyy", "yyyyMMdd"))
    if rule == "last8_day":            # ...20240105
        return _day(F.substring(stem, -8, 8), ("yyyyMMdd", "MMddyyyy"))
    if rule == "last_token_iso":       # ..._2024-01-05
        return F.try_to_date(F.element_at(F.split(stem, "_"), -1), "yyyy-MM-dd")
    if rule == "last10_dotted":        # ...2024.01.05, else the undated default
        tail = F.substring(stem, -10, 10)
        numeric = F.regexp_replace(tail, r"\.", "").rlike(r"^[0-9]+$")
        parsed = F.try_to_date(F.regexp_replace(tail, r"\.", "-"), "yyyy-MM-dd")
        return F.when(numeric, parsed).otherwise(F.lit(UNDATED_ENROLMENT_DATE).cast("date"))
    raise ValueError(f"unknown file date rule {rule!r}")


def release_date(path, rule: str) -> Column:
    """Release (publication) date of a file, for picking the newest release of a period."""
    stem = stem_of(path)
    if rule == "release_year":         # ..._r19_... / _ry19_ → 2019-12-31
        return year_end(_coded_year(stem, "r"))
    if rule == "stem_prefix_year":     # release year = stem[2:6]
        return year_end(F.substring(stem, 3, 4))
    if rule == "none":
        return F.lit(None).cast("date")
    raise ValueError(f"unknown release date rule {rule!r}")


def url_file_name(url) -> Column:
    """Last segment of a download URL."""
    return F.substring_index(as_col(url), "/", -1)


def title_file_name(title) -> Column:
    """Title lower-cased, non-word characters removed, ``.csv`` appended."""
    return F.concat(F.regexp_replace(F.lower(as_col(title)), r"(?U)\W+", ""), F.lit(".csv"))
