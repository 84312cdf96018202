"""Type inference over all files of a feed (S3) and election of date formats.

Nothing is guessed from a first file or a first row. All values of all files and
vintages are classified once, and the classes of a column are joined in a
lattice by a commutative aggregate (bit_or and counts), so the result does not
depend on the order of files or rows:

    (nothing) < boolean                 < string
    (nothing) < int < bigint < decimal(38,0) < double < string
    (nothing) < date                    < string

Whole numbers with leading zeros are identifiers and make a column a string. A
text column is a date column if one format of a declared list reads all of its
values. If several do, they must agree on every value; a column whose values fit
two formats with different dates (all days up to the 12th, say) fails.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from relcast.functions.parsing import date_shape, guessed_date
from relcast.sources.csv import FILE_PATH, scan_csv

#: Texts that stand for a missing value, besides blanks.
NA_VALUES = ("#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null")
#: Date formats that take part in an election; the earlier one names equal readings.
DATE_FORMATS = ("yyyy-M-d", "M/d/yyyy", "d/M/yyyy", "M/d/yy", "d/M/yy", "M-d-yyyy", "d-M-yyyy", "yyyy/M/d", "d-MMM-yyyy", "MMM d, yyyy", "MMMM d, yyyy")

# Classes of a value, as bits.
_BOOLEAN, _INT, _LONG, _WHOLE, _DOUBLE, _TEXT = 1, 2, 4, 8, 16, 32

_RANKS = ("int", "bigint", "decimal(38,0)", "double")
_DATE_LIKE = r"^(?=.*[0-9])[0-9A-Za-z]{1,9}[-/ ][0-9A-Za-z]{1,9}[-/, ]+[0-9]{1,4}$"


def value_class(v: Column, keep_padded: bool = True) -> Column:
    """The class bit of a non-blank text."""
    whole = v.rlike(r"^[+-]?[0-9]+$")
    padded = v.rlike(r"^[+-]?0[0-9]")
    digits = F.length(F.regexp_replace(v, "^[+-]?0*", ""))
    number = v.rlike(r"^[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?$")
    return (F.when(F.lower(v).isin("true", "false"), F.lit(_BOOLEAN))
            .when(whole, F.when(padded & F.lit(keep_padded), F.lit(_TEXT))
                  .when(v.try_cast("int").isNotNull(), F.lit(_INT))
                  .when(v.try_cast("bigint").isNotNull(), F.lit(_LONG))
                  .when(digits <= 38, F.lit(_WHOLE)).otherwise(F.lit(_DOUBLE)))
            .when(number, F.lit(_DOUBLE))
            .otherwise(F.lit(_TEXT)))


def join_types(a: str | None, b: str | None) -> str | None:
    """The least type of the lattice that holds both; None is the type of a column without values."""
    if a is None or b is None or a == b:
        return a if b is None else b
    if a in _RANKS and b in _RANKS:
        return max(a, b, key=_RANKS.index)
    return "string"


def _type_of(bits: Column) -> Column:
    numbers = _INT | _LONG | _WHOLE | _DOUBLE
    within = lambda m: bits.bitwiseAND(F.lit(~m)) == 0
    return (F.when(bits.isNull(), F.lit(None).cast("string"))
            .when(within(_BOOLEAN), F.lit("boolean"))
            .when(within(_INT), F.lit("int")).when(within(_INT | _LONG), F.lit("bigint"))
            .when(within(_INT | _LONG | _WHOLE), F.lit("decimal(38,0)")).when(within(numbers), F.lit("double"))
            .otherwise(F.lit("string")))


def present(c: Column, na_values: Sequence[str] = NA_VALUES) -> Column:
    """The trimmed text of a value; null if it is blank or stands for a missing one."""
    v = F.trim(c.cast("string"))
    return F.when(~v.isin("", *na_values), v)


def infer_types(df: DataFrame, columns: Sequence[str] | None = None, formats: Sequence[str] = DATE_FORMATS,
                na_values: Sequence[str] = NA_VALUES, keep_padded: bool = True) -> DataFrame:
    """(column, type, format, rivals, n_values): one row per column of an all-text table.

    One pass: every row becomes a row per column, which is aggregated in the
    task that reads it. ``type`` is null for a column without values.
    ``format`` is the elected date format; ``rivals`` are formats that read all
    values too, but some of them as another date (then ``format`` is null).

    A format is tried on texts of its shape only, as a parse that fails costs
    most.
    """
    columns = list(df.columns if columns is None else columns)
    if not columns:
        raise ValueError("no columns to infer")
    cells = F.array(*[F.struct(F.lit(c).alias("column"), present(F.col(f"`{c}`"), na_values).alias("value")) for c in columns])
    long = df.select(F.inline(cells)).withColumn("like", F.col("value").rlike(_DATE_LIKE))
    shaped = [F.col("like") if (shape := date_shape(f)) is None else F.col("like") & F.col("value").rlike(shape) for f in formats]
    long = long.select("column", "value", "like", *[F.when(s, guessed_date(F.col("value"), f)).alias(f"d{i}") for i, (s, f) in enumerate(zip(shaped, formats))])
    pairs = [(i, j) for i in range(len(formats)) for j in range(i + 1, len(formats))]
    found = long.groupBy("column").agg(
        # what looks like a date is no number
        F.bit_or(F.when(F.col("value").isNotNull(), F.when(F.col("like"), F.lit(_TEXT)).otherwise(value_class(F.col("value"), keep_padded)))).alias("bits"),
        F.count("value").alias("n_values"),
        *[F.count(f"d{i}").alias(f"n{i}") for i in range(len(formats))],
        *[F.count(F.when(F.col(f"d{i}") != F.col(f"d{j}"), F.lit(1))).alias(f"x{i}_{j}") for i, j in pairs])
    n = F.col("n_values")
    reads = [(n > 0) & (F.col(f"n{i}") == n) for i in range(len(formats))]
    fit = F.array_compact(F.array(*[F.when(r, F.lit(f)) for r, f in zip(reads, formats)]))
    clash = F.array_distinct(F.array_compact(F.flatten(F.array(*[
        F.when(reads[i] & reads[j] & (F.col(f"x{i}_{j}") > 0), F.array(F.lit(formats[i]), F.lit(formats[j]))).otherwise(F.array().cast("array<string>")) for i, j in pairs])))
    ) if pairs else F.array().cast("array<string>")
    base = _type_of(F.col("bits"))
    out = found.select("column", base.alias("base"), fit.alias("fit"), clash.alias("rivals"), "n_values")
    is_date = (F.col("base") == "string") & (F.size("fit") > 0)
    return out.select("column", F.when(is_date, F.lit("date")).otherwise(F.col("base")).alias("type"),
                      F.when(is_date & (F.size("rivals") == 0), F.col("fit")[0]).alias("format"),
                      F.when(is_date, F.col("rivals")).otherwise(F.array().cast("array<string>")).alias("rivals"), "n_values")


class AmbiguousDates(ValueError):
    """Values of a column fit several date formats that read them as different dates."""


def elected(types: DataFrame, declared: Mapping[str, tuple[str, str | None]] | None = None) -> dict[str, tuple[str | None, str | None]]:
    """{column: (type, date format)} of an inference; ``declared`` entries take the place of inferred ones.

    Fails on columns whose date format is a tie.
    """
    declared = dict(declared or {})
    out: dict[str, tuple[str | None, str | None]] = {}
    ties = []
    for r in types.collect():  # one row per column
        if r["column"] in declared:
            out[r["column"]] = declared[r["column"]]
            continue
        if r["rivals"]:
            ties.append(f"{r['column']}: {', '.join(r['rivals'])}")
        out[r["column"]] = (r["type"], r["format"])
    if ties:
        raise AmbiguousDates("date formats that fit equally well, declare one; " + "; ".join(sorted(ties)))
    return out


def widened(known: Mapping[str, tuple[str | None, str | None]], new: Mapping[str, tuple[str | None, str | None]]) -> dict[str, tuple[str | None, str | None]]:
    """The types that hold both of two inferences (a table's and a new release's); two date formats make a string."""
    out = dict(known)
    for c, (kind, fmt) in new.items():
        before, before_fmt = out.get(c, (None, None))
        if before == kind == "date" and fmt != before_fmt:
            out[c] = ("string", None)
            continue
        joined = join_types(before, kind)
        out[c] = (joined, (fmt or before_fmt) if joined == "date" else None)
    return out


def typed_as(df: DataFrame, types: Mapping[str, tuple[str | None, str | None]], na_values: Sequence[str] = NA_VALUES) -> DataFrame:
    """``df`` with the inferred types. Strings are kept as they are, blanks apart; columns without values are strings."""
    def one(c: str) -> Column:
        if c not in types:
            return F.col(f"`{c}`")
        kind, fmt = types[c]
        v = present(F.col(f"`{c}`"), na_values)
        if kind == "date":
            return guessed_date(v, fmt).alias(c)
        if kind in (None, "string"):
            return F.when(v.isNotNull(), F.col(f"`{c}`")).alias(c)
        return v.try_cast(kind).alias(c)

    return df.select(*[one(c) for c in df.columns])


def scan_csv_inferred(spark: SparkSession, files: DataFrame | Sequence[str], declared: Mapping[str, tuple[str, str | None]] | None = None,
                      na_values: Sequence[str] = NA_VALUES, keep_padded: bool = True, formats: Sequence[str] = DATE_FORMATS, **options) -> DataFrame:
    """S3: a scan of all files and vintages of a feed with the types that hold all of their values."""
    raw = scan_csv(spark, files, **options)
    columns = [c for c in raw.columns if c != FILE_PATH]
    return typed_as(raw, elected(infer_types(raw, columns, formats, na_values, keep_padded), declared), na_values)
