"""Text predicates and keys: phonetic key (T13), edit distance (T14), id lists."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from relcast.functions.common import as_col


def phonetic_key(c) -> Column:
    """American Soundex (built-in); input that does not start with a letter is returned as is."""
    return F.soundex(as_col(c))


def neighbour_swaps(c) -> Column:
    """All strings made by exchanging two neighbouring characters (empty when length < 2)."""
    s = as_col(c)
    return F.when(F.length(s) < 2, F.array().cast("array<string>")).otherwise(
        F.transform(
            F.sequence(F.lit(1), F.length(s) - 1),
            lambda i: F.concat(
                F.substring(s, F.lit(1), i - 1),
                F.substring(s, i + 1, F.lit(1)),
                F.substring(s, i, F.lit(1)),
                F.substring(s, i + 2, F.length(s)),
            ),
        )
    )


def within_edits2(a, b) -> Column:
    """Unrestricted Damerau-Levenshtein distance of ``a`` and ``b`` is at most 2.

    Two edits are either two plain edits, a swap followed by at most one plain
    edit, at most one plain edit followed by a swap, or two swaps. Swaps are
    involutions, so every case is one bounded ``levenshtein`` test.
    """
    a, b = as_col(a), as_col(b)
    sa, sb = neighbour_swaps(a), neighbour_swaps(b)
    return (
        (F.levenshtein(a, b, 2) >= 0)
        | F.exists(sa, lambda w: F.levenshtein(w, b, 1) >= 0)
        | F.exists(sb, lambda w: F.levenshtein(a, w, 1) >= 0)
        | F.arrays_overlap(sa, sb)
    )


def split_ids(c, sep: str = " ") -> Column:
    """Split a separated id list; empty pieces (double separators) are dropped."""
    return F.filter(F.split(as_col(c), sep), lambda x: x != "")
