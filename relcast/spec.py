"""Declarative dataset specs.

A :class:`TableSpec` says where a feed's files are, how their names carry the
period, which columns get which type, and how the table is loaded. Jobs in
:mod:`relcast.plans.jobs` turn a spec into one Spark plan per run.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from collections.abc import Mapping


@dataclass(frozen=True)
class SuffixTyping:
    """Type by name suffix. Listed string names stay strings; a name ending in
    one of ``double_suffixes`` is double; any other column gets ``default``."""

    strings: tuple[str, ...] = ()
    double_suffixes: tuple[str, ...] = ()
    default: str = "int"


@dataclass(frozen=True)
class DateRule:
    """T4: which names are dates. ``how`` is ``suffix``, ``contains`` or ``exact``."""

    how: str
    text: str
    formats: tuple[str, ...]
    strict: bool = False


@dataclass(frozen=True)
class TableSpec:
    name: str
    globs: tuple[str, ...] = ("*",)
    file_date: str = "last4_year"
    release: str = "none"             # release rule for G3; "none" = no release choice
    load: str = "period"              # period | append | full | latest
    renames: Mapping[str, str] = field(default_factory=dict)
    types: Mapping[str, str] = field(default_factory=dict)   # name -> int|bigint|double|date|string
    date_formats: Mapping[str, tuple[str, ...]] = field(default_factory=dict)
    suffix_typing: SuffixTyping | None = None
    date_rules: tuple[DateRule, ...] = ()
    strip_money: bool = True          # remove $ , % before numeric casts
    markers: tuple[str, ...] = ()     # suppression markers -> null before casting typed columns
    pads: Mapping[str, int] = field(default_factory=dict)
    malformed: Mapping[str, str] = field(default_factory=dict)  # column -> marker text of broken rows
    ccn_column: str | None = None     # adds ccn_remapped
    id_list_column: str | None = None  # A1: explode a space-separated id list
    output: tuple[str, ...] | None = None  # fixed output projection
    dedupe: bool = False
    source_name: bool = False         # add _source_file_name
    pending_on: tuple[str, ...] = ("_input_file_date",)
    encoding: str = "UTF-8"
    multi_line: bool = False
    table_comment: str | None = None
    column_comments: Mapping[str, str] = field(default_factory=dict)
