"""Secret scan: patterns, and sliding-window Shannon entropy per character class.

Candidate strings are runs of one character class. A window slides over each
and its entropy is kept up to date by incremental counts: one character
enters, one leaves, and the sum of c*log2(c) changes in two terms. Stretches
whose windows reach the class's limits become spans, unless the allow list
explains them (plain numbers, UUIDs, placeholders, alphabets).

Keys of single-case letters alone are not looked for: short windows of them
cannot be told from words run together.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from relcast.llm.common import map_batches

BASE_KINDS = ("assign", "access", "hex")
KINDS = (*BASE_KINDS, "entropy")

_ASSIGN = re.compile(r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.IGNORECASE | re.ASCII)
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]{16,}")  # a run of 16 or more is a run that passes the length test


@dataclass(frozen=True)
class CharClass:
    """A class of candidate strings: the runs of ``chars``.

    A window of ``window`` characters is hot if it has at least ``bits`` bits of
    entropy and ``turns`` turns. A turn is where a letter and a digit, or two
    cases, stand side by side: random keys turn all the time, words, paths and
    numbered names hardly ever. For classes without digits (``cased``) it is a
    capital behind a small letter that does not start a word (two small letters
    follow then), or a small letter between two capitals.
    """

    name: str
    chars: str
    window: int
    bits: float
    turns: int
    cased: bool = False


#: Limits that random keys of these shapes pass with a probability of 0.95 and more in their best window.
CLASSES = (
    CharClass("hex", "0-9a-fA-F", 16, 2.6, 3),
    CharClass("lower", "0-9a-z", 20, 3.4, 4),
    CharClass("upper", "0-9A-Z", 20, 3.3, 3),
    CharClass("letters", "A-Za-z", 20, 3.6, 4, cased=True),
    CharClass("base64", "A-Za-z0-9+/_-", 20, 3.7, 6),
)
#: Whole candidates that are no secrets.
ALLOW = tuple(re.compile(p) for p in (
    r"[0-9]+",
    r"[A-Za-z]+",
    r"[0-9a-fA-F]{8}(?:-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}",
    r"[A-Za-z]+(?:[/_-][A-Za-z]+)*(?:[/_-][0-9]+)*",
))
#: Parts between separators that are no secrets, whatever stands beside them: placeholders, alphabets.
ALLOW_PARTS = tuple(re.compile(p) for p in (
    r".*(?:EXAMPLE|example|xxxxxx|XXXXXX|placeholder).*",
    r"(?:0123456789)?(?:abcdef|ABCDEF).*(?:uvwxyz|UVWXYZ|0123456789|456789).*",
))
_PART = re.compile("[A-Za-z0-9]+")
_LOG = [0.0, 0.0, *(c * math.log2(c) for c in range(2, 513))]


def _turns(run: str, cased: bool) -> list[int]:
    """Running number of turns: entry i counts those before character i."""
    kinds = [1 if c.islower() else 2 if c.isupper() else 3 if c.isdigit() else 0 for c in run]
    if cased:
        at = [kinds[i - 1:i] == [3 - k] and (kinds[i + 1:i + 2] == [2] if k == 1 else kinds[i + 1:i + 3] != [1, 1]) for i, k in enumerate(kinds)]
    else:
        at = [i > 0 and k != kinds[i - 1] and k > 0 and kinds[i - 1] > 0 for i, k in enumerate(kinds)]
    out = [0]
    for t in at:
        out.append(out[-1] + t)
    return out


def hot_stretches(run: str, window: int, bits: float, turns: int = 0, cased: bool = False) -> list[tuple[int, int]]:
    """Unions of the windows of ``run`` whose entropy is at least ``bits``, and that have ``turns`` turns."""
    if len(run) < window:
        return []
    counts = Counter(run[:window])
    total = sum(_LOG[c] for c in counts.values())
    limit = (math.log2(window) - bits) * window + 1e-9  # entropy >= bits
    upto = _turns(run, cased) if turns else None
    out: list[list[int]] = []
    for i in range(len(run) - window + 1):
        if i:
            gone, new = run[i - 1], run[i + window - 1]
            if gone != new:
                c = counts[gone]
                total += _LOG[c - 1] - _LOG[c]
                counts[gone] = c - 1
                c = counts[new]
                total += _LOG[c + 1] - _LOG[c]
                counts[new] = c + 1
        # a turn lies between two characters of the window, or at a capital of it
        if total <= limit and (upto is None or upto[i + window] - upto[i if cased else i + 1] >= turns):
            if out and i <= out[-1][1]:
                out[-1][1] = i + window
            else:
                out.append([i, i + window])
    return [(a, b) for a, b in out]


_RUNS = [(c, re.compile(f"[{c.chars}]{{{c.window},}}")) for c in CLASSES]
#: The widest class holds the characters of the others.
_WIDE = re.compile(f"[{CLASSES[-1].chars}]{{{min(c.window for c in CLASSES)},}}")


def _unexplained(text: str) -> Iterator[tuple[int, int]]:
    """The runs of the widest class, cut at the parts that the allow list explains."""
    for m in _WIDE.finditer(text):
        at = m.start()
        for p in _PART.finditer(text, m.start(), m.end()):
            if any(a.fullmatch(p.group()) for a in ALLOW_PARTS):
                if at < p.start() - 1:
                    yield at, p.start() - 1
                at = min(p.end() + 1, m.end())  # with the separator
        yield at, m.end()


def entropy_spans(text: str) -> list[tuple[int, int]]:
    """Hot stretches of every class in its own maximal runs, overlapping ones joined."""
    found: list[tuple[int, int]] = []
    for begin, end in _unexplained(text):
        for i, (cls, runs) in enumerate(_RUNS):
            for m in runs.finditer(text, begin, end):
                run = m.group()
                if i and _RUNS[0][1].fullmatch(run):
                    continue  # judged as hex
                if cls.cased:
                    if run.islower() or run.isupper() or run[1:].islower():
                        continue
                elif any(a.fullmatch(run) for a in ALLOW) or not (re.search("[0-9]", run) and re.search("[A-Za-z]", run)):
                    continue
                found += [(m.start() + a, m.start() + b) for a, b in hot_stretches(run, cls.window, cls.bits, cls.turns, cls.cased)]
    out: list[tuple[int, int]] = []
    for a, b in sorted(found):
        if out and a < out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def find(text: str | None) -> list[tuple[str, int, int]]:
    """(kind, start, end) in code points, end exclusive, by start, then kind.

    Base kinds are leftmost non-overlapping matches per kind that pass their
    length test; ``entropy`` spans are added, also where they overlap base
    ones. Null and empty texts have none.
    """
    if not text:
        return []
    spans = [("assign", *m.span()) for m in _ASSIGN.finditer(text) if len(m.group(2)) >= 12]
    spans += [("access", *m.span()) for m in _ACCESS.finditer(text) if m.end() - m.start() >= 18]
    spans += [("hex", *m.span()) for m in _HEX.finditer(text)]
    spans += [("entropy", a, b) for a, b in entropy_spans(text)]
    return sorted(spans, key=lambda s: (s[1], KINDS.index(s[0])))


SPANS = T.StructType([
    T.StructField("doc_id", T.LongType()),
    T.StructField("spans", T.ArrayType(T.StructType([
        T.StructField("kind", T.StringType()), T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType()),
    ]))),
])


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, spans): the secrets of every text, one row per input row.

    Null and empty texts have an empty list; null ids and repeated rows are
    kept; other columns are not read. No shuffle.
    """
    def spans(batch: pa.RecordBatch) -> dict:
        found = [[{"kind": k, "start": s, "end": e} for k, s, e in find(t)] for t in batch.column(1).to_pylist()]
        return {"doc_id": batch.column(0), "spans": found}

    return map_batches(docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")), spans, SPANS)


def op4_query(docs: DataFrame) -> DataFrame:
    """Digest columns of :func:`scan`: counts per base kind, the SHA-256 of the base spans, all spans."""
    kind_is = lambda name: lambda s: s["kind"] == name
    text = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
    spans = F.col("spans")
    base = F.filter(spans, lambda s: s["kind"].isin(*BASE_KINDS))
    return scan(docs).select(
        "doc_id",
        *[F.size(F.filter(spans, kind_is(k))).cast("long").alias(f"n_{k}") for k in BASE_KINDS],
        F.sha2(text(base).cast("binary"), 256).alias("base_sha256"),
        text(spans).alias("spans"),
    )
