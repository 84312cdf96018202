"""CSV files with line breaks inside quoted fields, read in splits.

Spark parses such a file in one task, since a split may start inside a quoted
field. Here the file is read as lines, in as many tasks as it has splits:

1. Every task says of each of its splits in which state (inside a quoted field
   or not) it would end, for either state that it may start in.
2. Going through these pairs, one per split, in order gives the state that each
   split really starts in.
3. Every task joins its lines to records. A record that crosses a border comes
   out as fragments, which are put together by file; there is at most one open
   record per border, so only these few rows are shuffled.

Records are then parsed by Spark's own CSV parser. A quote counts as the start
of a quoted field only where a field starts, as in that parser.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The line readers run in Python workers; they travel by value, so executors need no installed copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Encodings in which quotes, commas and line breaks are the bytes that they are in ASCII, and no other bytes are.
ASCII_BASED = ("utf-8", "us-ascii", "iso-8859-1", "iso-8859-15", "windows-1252")

_WHOLE, _HEAD, _TAIL, _MIDDLE = 0, 1, 2, 3


class MovedSplits(RuntimeError):
    """A file was cut into other splits than those whose states are known."""


def _after_quote(line: bytes, at: int) -> int:
    """The place behind the quote that closes a field whose text goes on at ``at``; -1 if none does."""
    while True:
        at = line.find(b'"', at)
        if at < 0:
            return -1
        if line[at + 1:at + 2] != b'"':
            return at + 1
        at += 2


def ends_inside(line: bytes, inside: bool, comma: bytes = b",") -> bool:
    """Whether a quoted field is open at the end of a line that starts inside one, or outside."""
    if b'"' not in line:
        return inside
    at = 0
    if inside:
        at = _after_quote(line, 0)
        if at < 0:
            return True
        at = line.find(comma, at) + 1
        if not at:
            return False
    while True:
        if line[at:at + 1] == b'"':
            at = _after_quote(line, at + 1)
            if at < 0:
                return True
        at = line.find(comma, at) + 1
        if not at:
            return False


def _splits(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, int, list, bool]]:
    """(path, start, some lines, whether the split starts here) in order."""
    last = None
    for batch in batches:
        paths, starts, lines = (c.to_pylist() for c in batch.columns)
        i = 0
        while i < len(lines):
            j, here = i, (paths[i], starts[i])
            while j < len(lines) and (paths[j], starts[j]) == here:
                j += 1
            yield *here, lines[i:j], here != last
            last, i = here, j


def _lines(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    from relcast.sources.csv import scan_file_path

    text = spark.read.option("lineSep", "\n").text(list(paths))
    return text.select(scan_file_path().alias("path"), F.col("_metadata.file_block_start").alias("start"), F.col("value").cast("binary").alias("line"))


def _states(lines: DataFrame) -> DataFrame:
    """(path, start, from_out, from_in, crlf): how every split ends, and whether its first line ends with CR LF."""
    schema = T.StructType([T.StructField("path", T.StringType()), T.StructField("start", T.LongType()), T.StructField("from_out", T.BooleanType()), T.StructField("from_in", T.BooleanType()),
                           T.StructField("crlf", T.BooleanType())])
    arrow = pa.schema([("path", pa.string()), ("start", pa.int64()), ("from_out", pa.bool_()), ("from_in", pa.bool_()), ("crlf", pa.bool_())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, out, in_, crlf = None, False, True, False
        row = lambda: pa.RecordBatch.from_pylist([{"path": current[0], "start": current[1], "from_out": out, "from_in": in_, "crlf": crlf}], schema=arrow)
        for path, start, part, fresh in _splits(batches):
            if fresh:
                if current:
                    yield row()
                current, out, in_, crlf = (path, start), False, True, part[0].endswith(b"\r")
            for line in part:
                if b'"' in line:
                    out, in_ = ends_inside(line, out), ends_inside(line, in_)
        if current:
            yield row()

    return lines.mapInArrow(run, schema)


def starting_states(lines: DataFrame) -> tuple[dict[str, dict[int, bool]], bool, set[str]]:
    """{path: {split start: whether it starts inside a quoted field}}, as many entries as the driver plans splits;
    whether any split ends inside one; and the files whose first line ends with CR LF."""
    out: dict[str, dict[int, bool]] = {}
    inside: dict[str, bool] = {}
    open_, crlf = False, set()
    for r in sorted(_states(lines).collect(), key=lambda r: (r["path"], r["start"])):
        state = inside.get(r["path"], False)
        out.setdefault(r["path"], {})[r["start"]] = state
        inside[r["path"]] = r["from_in"] if state else r["from_out"]
        open_ = open_ or inside[r["path"]]
        if r["crlf"] and r["start"] == 0:
            crlf.add(r["path"])
    return out, open_, crlf


def _pieces(lines: DataFrame, states: dict[str, dict[int, bool]], crlf: set[str]) -> DataFrame:
    """(path, start, kind, first, text): whole records, and the fragments of those that cross a border.

    In files with CR LF, line breaks inside fields become LF, as Spark's reader has them.
    """
    schema = T.StructType([T.StructField("path", T.StringType()), T.StructField("start", T.LongType()), T.StructField("kind", T.IntegerType()),
                           T.StructField("first", T.BooleanType()), T.StructField("text", T.BinaryType())])
    arrow = pa.schema([("path", pa.string()), ("start", pa.int64()), ("kind", pa.int32()), ("first", pa.bool_()), ("text", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, inside, head, first, open_ = None, False, False, False, []
        out: list[tuple] = []
        size = 0

        def ended() -> None:
            """The split is over: what is still open goes on in the next one."""
            if open_:
                out.append((*current, _MIDDLE if head else _TAIL, first, b"\n".join(open_)))

        def flush() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), arrow)], schema=arrow)

        for path, start, part, fresh in _splits(batches):
            if fresh:
                ended()
                current, open_, first = (path, start), [], start == 0
                if start not in states.get(path, {}):
                    raise MovedSplits(f"{path} from {start}")
                inside = head = states[path][start]
            strip = path in crlf
            for line in part:
                if strip:
                    line = line.removesuffix(b"\r")
                inside = ends_inside(line, inside)
                if inside or open_:
                    open_.append(line)
                    if inside:
                        continue
                    line = b"\n".join(open_)
                    open_ = []
                out.append((*current, _HEAD if head else _WHOLE, first, line))
                size += len(line) + 64
                head = first = False
                if size > 4 << 20:
                    yield flush()
                    out, size = [], 0
        ended()
        if out:
            yield flush()

    return lines.mapInArrow(run, schema)


def records(spark: SparkSession, paths: Sequence[str], encoding: str = "UTF-8") -> DataFrame:
    """(path, record): the records of CSV files without their headers and blank lines, one row each, read in splits."""
    lines = _lines(spark, paths)
    states, open_, crlf = starting_states(lines)
    pieces = _pieces(lines, states, crlf)
    whole = pieces.where(F.col("kind") == _WHOLE).select("path", "first", "text")
    if open_:
        # a record is counted from its tail on, and what follows closes it; a file that ends inside a field leaves a tail alone
        parts = pieces.where(F.col("kind") != _WHOLE)
        opened = F.sum((F.col("kind") == _TAIL).cast("int")).over(Window.partitionBy("path").orderBy("start", "kind"))
        joined = parts.withColumn("opened", opened).groupBy("path", "opened").agg(
            F.bool_or("first").alias("first"), F.sort_array(F.collect_list(F.struct("start", "kind", "text"))).alias("parts"))
        text = F.reduce("parts", F.lit(None).cast("binary"), lambda acc, x: F.when(acc.isNull(), x["text"]).otherwise(F.concat(acc, F.lit(b"\n"), x["text"])))
        whole = whole.unionByName(joined.select("path", "first", text.alias("text")))
    text = F.col("text").cast("string") if encoding.lower() == "utf-8" else F.decode("text", encoding)
    record = F.regexp_replace(text, "\r$", "")
    return whole.where(~F.col("first")).select("path", record.alias("record")).where(F.col("record") != "")


def read_multiline(spark: SparkSession, schema: T.StructType, paths: Sequence[str], path_column: str, encoding: str = "UTF-8") -> DataFrame:
    """The columns of ``schema`` (all of them, by place) and the file path of every record."""
    options = {"escape": '"', "multiLine": "true", "mode": "PERMISSIVE"}
    ddl = ", ".join(f"`{f.name.replace('`', '``')}` {f.dataType.simpleString()}" for f in schema)
    parsed = records(spark, paths, encoding).select(F.from_csv("record", F.lit(ddl), options).alias("row"), F.col("path").alias(path_column))
    return parsed.select(*[F.col(f"row.`{f.name}`").alias(f.name) for f in schema], path_column)
