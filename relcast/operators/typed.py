"""Typing of scanned string columns from a spec (T2-T6, T10, T11) in one projection."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from relcast.functions.identifiers import remap_ccn
from relcast.functions.parsing import (
    lenient_double,
    lenient_int,
    null_if,
    pad_id,
    parse_date_any,
    strip_money,
)
from relcast.spec import TableSpec


def _lenient_bigint(c: Column) -> Column:
    v = F.trim(c.cast("string"))
    head = F.regexp_extract(v, r"^([+-]?[0-9]*)", 1)
    head = F.when(head.isin("", "+", "-"), F.lit("0")).otherwise(head)
    ok = v.rlike(r"^[+-]?[0-9]*([.][0-9]*)?$") & ~v.isin("", "+", "-")
    return F.when(ok, head.try_cast("bigint"))


def type_of(name: str, spec: TableSpec) -> tuple[str, tuple[str, ...]]:
    """(kind, date formats) for one column name; first matching rule wins."""
    if name in spec.types:
        kind = spec.types[name]
        return kind, tuple(spec.date_formats.get(name, ()))
    for rule in spec.date_rules:
        hit = (
            (rule.how == "suffix" and name.endswith(rule.text))
            or (rule.how == "contains" and rule.text in name)
            or (rule.how == "exact" and name == rule.text)
        )
        if hit:
            return ("date_strict" if rule.strict else "date"), rule.formats
    st = spec.suffix_typing
    if st is not None:
        if name in st.strings:
            return "string", ()
        if any(name.endswith(s) for s in st.double_suffixes):
            return "double", ()
        return st.default, ()
    return "string", ()


def typed_column(name: str, spec: TableSpec) -> Column:
    c = F.col(f"`{name}`")
    kind, fmts = type_of(name, spec)
    if name in spec.pads:
        c = pad_id(c, spec.pads[name])
    if kind in ("int", "bigint", "double"):
        if spec.markers:
            c = null_if(c, spec.markers)
        if spec.strip_money:
            c = strip_money(c)
        c = lenient_int(c) if kind == "int" else _lenient_bigint(c) if kind == "bigint" else lenient_double(c)
    elif kind in ("date", "date_strict"):
        c = parse_date_any(c, fmts, strict=(kind == "date_strict"))
    return c.alias(name)


def apply_types(df: DataFrame, spec: TableSpec, keep: tuple[str, ...] = ("_file_path",)) -> DataFrame:
    """Every data column typed per the spec; bookkeeping columns in ``keep`` pass through."""
    cols = [typed_column(n, spec) for n in df.columns if n not in keep]
    if spec.ccn_column and spec.ccn_column in df.columns:
        cols.append(remap_ccn(F.col(spec.ccn_column)).alias("ccn_remapped"))
    return df.select(*cols, *[k for k in keep if k in df.columns])
