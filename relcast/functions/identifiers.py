"""Identifier functions: CCN remapping (T11) and crosswalk tokens."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from relcast.functions.common import as_col

# Legacy CCN letter codes, checked in this order.
# One letter in the third position followed by a digit → that digit prefix.
CCN_SINGLE_LETTER_RULES = [
    (("M", "R", "Z"), "1"),
    (("S", "T", "U"), "0"),
    (("W",), "2"),
    (("Y",), "3"),
]
# Two letters in positions three and four → two-digit prefix.
CCN_DOUBLE_LETTER_RULES = [
    (("TA", "SA"), "20"),
    (("TB", "SB"), "21"),
    (("TC", "SC"), "22"),
    (("SD",), "30"),
    (("TE", "SE"), "33"),
    (("TF",), "40"),
    (("TG",), "41"),
    (("TH",), "42"),
    (("TJ",), "43"),
    (("TK",), "44"),
]

TOKEN_SEPARATOR = "^"


def remap_ccn(c) -> Column:
    """Map a CMS certification number with a legacy letter code to its numeric form.

    Null becomes ``""``; anything shorter than four characters, or with no
    matching rule, is returned cut to six characters.
    """
    s = as_col(c).cast("string")
    head = F.substring(s, 1, 2)
    third = F.substring(s, 3, 1)
    third_fourth = F.substring(s, 3, 2)
    fourth_is_digit = F.substring(s, 4, 1).rlike("^[0-9]$")
    expr = F.when(s.isNull(), F.lit(""))
    expr = expr.when(F.length(s) < 4, F.substring(s, 1, 6))
    for letters, digit in CCN_SINGLE_LETTER_RULES:
        expr = expr.when(third.isin(*letters) & fourth_is_digit, F.concat(head, F.lit(digit), F.substring(s, 4, 3)))
    for pairs, digits in CCN_DOUBLE_LETTER_RULES:
        expr = expr.when(third_fourth.isin(*pairs), F.concat(head, F.lit(digits), F.substring(s, 5, 2)))
    return expr.otherwise(F.substring(s, 1, 6))


def join_token(*cols, sep: str = TOKEN_SEPARATOR) -> Column:
    """Join parts with ``sep``; a null part keeps its slot as an empty string."""
    return F.concat_ws(sep, *[F.coalesce(as_col(c).cast("string"), F.lit("")) for c in cols])
