"""Personal data by anchor expansion.

An Aho-Corasick automaton finds anchors (at-signs, schemes, plus signs, digits
and identifier cues) in one pass over a text. At each anchor a deterministic
local parser expands to the boundaries of the item and validates it. Every
parser moves a cursor over the text and skips what it has judged, so the work
is linear in the text, also for very long runs of digits or letters.
"""

from __future__ import annotations

import hashlib
import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from relcast.llm.common import map_batches

#: Kinds in the order of the reports; the first four are the base kinds.
BASE_KINDS = ("email", "ip", "card", "phone")
KINDS = (*BASE_KINDS, "address", "account")
CUES = ("iban", "account", "acct", "ssn", "social security", "passport")
SCHEMES = ("://", "mailto:", "tel:", "sip:")

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_SCHEME_CHARS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+.-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+")
_DIGITS = re.compile(r"[0-9]++")
_IP = re.compile(r"([0-9]++)\.([0-9]++)\.([0-9]++)\.([0-9]++)")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_SEPARATORS = str.maketrans("", "", " -().+")
#: Neither this nor _CALL reads over the next scheme (its slash, its letters), so all tries together are linear.
_USERINFO = re.compile(r"[^\s/?#@\"'<>][^\s/?#@\"'<>:]*+:[^\s/?#@\"'<>]++@(?:[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+|localhost)(?::[0-9]+)?")
_CALL = re.compile(r"\+?[0-9][0-9().-]{6,}[0-9]")
_IBAN = re.compile(r"[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]){11,30}")
_LINK = re.compile(r"(?:\x20?(?:number|no\.?|nr\.?|#|is))*\x20?[:=#]?\x20{0,2}", re.IGNORECASE | re.ASCII)
_SSN = re.compile(r"(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)[0-9]{4}(?![0-9-])")
_ACCOUNT = re.compile(r"[0-9](?:[\x20-]?[0-9]){7,16}(?![0-9])")
_PASSPORT = re.compile(r"[A-Z]{1,2}[0-9]{6,8}(?![A-Za-z0-9])")


_BUILT: list = []  # the automaton, built once in each worker


def _automaton():
    import ahocorasick

    if _BUILT:
        return _BUILT[0]
    found = ahocorasick.Automaton()
    found.add_word("@", ("at", 1))
    found.add_word("+", ("plus", 1))
    for digit in "0123456789":
        found.add_word(digit, ("digit", 1))
    for scheme in SCHEMES:
        found.add_word(scheme, ("scheme", len(scheme)))
    for cue in CUES:
        for form in {cue, cue.upper(), cue.title(), cue.capitalize()}:
            found.add_word(form, ("cue", len(form)))
    found.make_automaton()
    _BUILT.append(found)
    return found


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        if i % 2:
            d = d * 2 - 9 if d > 4 else d * 2
        total += d
    return total % 10 == 0


def iban_valid(text: str) -> bool:
    moved = text[4:] + text[:4]
    return int("".join(str(int(c, 36)) for c in moved)) % 97 == 1


def find(text: str | None) -> list[tuple[str, int, int]]:
    """(kind, start, end) in code points, end exclusive, by kind then start.

    Base kinds are the leftmost non-overlapping matches of their patterns;
    matches that fail validation are dropped and not tried again. The kinds
    ``address`` (user:password@host behind a scheme, call links) and
    ``account`` (valid IBANs, and numbers right behind an identifier cue) are
    added. Null and empty texts have none.
    """
    if not text:
        return []
    out: dict[str, list[tuple[int, int]]] = {kind: [] for kind in KINDS}
    email = ip = card = phone = account = address = 0  # how far each parser has come
    for end, (anchor, width) in _automaton().iter(text):
        at = end + 1 - width
        if anchor == "digit":
            if at >= ip:
                if m := _IP.match(text, at):
                    ip = m.end()
                    if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m.groups()):
                        out["ip"].append(m.span())
                else:  # what follows this run of digits fails for each of its digits
                    ip = _DIGITS.match(text, at).end()
            if at >= card and (m := _CARD.match(text, at)):
                card = m.end()
                digits = m.group().translate(_SEPARATORS)
                if 13 <= len(digits) <= 19 and luhn(digits):
                    out["card"].append(m.span())
        elif anchor == "at":
            start = at
            while start > email and text[start - 1] in _LOCAL:
                start -= 1
            if start < at and (m := _DOMAIN.match(text, at + 1)):
                email = m.end()
                out["email"].append((start, email))
        elif anchor == "plus":
            if at >= phone and (m := _PHONE.match(text, at)):
                phone = m.end()
                if 9 <= len(m.group().translate(_SEPARATORS)) <= 15:
                    out["phone"].append(m.span())
        elif anchor == "scheme":
            start, parser = at, _USERINFO if width == 3 else _CALL
            while start > address and text[start - 1] in _SCHEME_CHARS and at - start < 20:
                start -= 1
            word = text[at:end + 1]
            if word != "mailto:" and end + 1 >= address and (width != 3 or start < at) and (m := parser.match(text, end + 1)):
                address = m.end()
                out["address"].append((start if width == 3 else at, address))
        elif at >= account and not (at and (text[at - 1].isalnum() or text[at - 1] == "_")):
            start = _LINK.match(text, end + 1).end()
            cue = text[at:end + 1].lower()
            if cue == "iban":
                span = _iban(text, start)
            else:
                parser = _SSN if cue in ("ssn", "social security") else _PASSPORT if cue == "passport" else _ACCOUNT
                span = m.span() if (m := parser.match(text, start)) else None
                if span is None and cue in ("account", "acct"):
                    span = _iban(text, start)
            if span:
                account = span[1]
                out["account"].append(span)
    return [(kind, *span) for kind in KINDS for span in out[kind]]


def _iban(text: str, start: int) -> tuple[int, int] | None:
    """The longest valid IBAN that starts at ``start`` and ends at a word boundary."""
    m = _IBAN.match(text, start)
    if not m:
        return None
    for stop in range(m.end(), start + 14, -1):
        if text[stop - 1] != " " and (stop == len(text) or not text[stop].isalnum()) and iban_valid(text[start:stop].replace(" ", "")):
            return start, stop
    return None


def redact(text: str | None) -> str | None:
    """The text with every found item replaced by its kind in brackets.

    Overlapping items are replaced together, under the kind that starts first
    (the longer one on ties). Null stays null.
    """
    if not text:
        return text
    parts, done = [], 0
    for start, end, kind in _merged(find(text)):
        parts += [text[done:start], f"[{kind}]"]
        done = end
    return "".join([*parts, text[done:]]) if parts else text


def _merged(spans: list[tuple[str, int, int]]) -> list[list]:
    merged: list[list] = []
    for kind, start, end in sorted(spans, key=lambda s: (s[1], -s[2], KINDS.index(s[0]))):
        if merged and start < merged[-1][1]:
            merged[-1][1] = max(merged[-1][1], end)
        else:
            merged.append([start, end, kind])
    return merged


SPANS = T.StructType([
    T.StructField("doc_id", T.LongType()),
    T.StructField("spans", T.ArrayType(T.StructType([
        T.StructField("kind", T.StringType()), T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType()),
    ]))),
])


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, spans): the personal data of every text, one row per input row.

    Null and empty texts and texts without items have an empty list; null ids
    and repeated rows are kept as they are. Other columns are not read. No
    shuffle: each text is judged where it is read.
    """
    def spans(batch: pa.RecordBatch) -> dict:
        found = [[{"kind": k, "start": s, "end": e} for k, s, e in find(t)] for t in batch.column(1).to_pylist()]
        return {"doc_id": batch.column(0), "spans": found}

    return map_batches(docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")), spans, SPANS)


def digest(spans: list[tuple[str, int, int]]) -> str:
    return hashlib.sha256(",".join(f"{k}:{s}:{e}" for k, s, e in spans).encode()).hexdigest()


def op8_query(docs: DataFrame) -> DataFrame:
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


def redact_documents(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with the personal data in ``text_col`` masked; all else as it was.

    Null and empty texts are unchanged. Every row and column is kept.
    """
    from pyspark.sql.functions import pandas_udf

    @pandas_udf(T.StringType())
    def masked(texts):
        return texts.map(redact, na_action="ignore")

    from relcast.llm.common import bound_batches

    bound_batches(docs.sparkSession)
    return docs.withColumn(text_col, masked(F.col(text_col)))
