"""CSV release scans (S1-S3) that survive header drift.

One multi-file CSV read maps columns by position using the first file's
header, so files whose headers differ would be silently mis-aligned. The scan
therefore reads each file's first line in a distributed job (only the first
bytes of each file), groups the files by header, reads each group with its own
all-string schema and unions the groups by name.
"""

from __future__ import annotations

import csv
import io
import sys
from collections.abc import Iterator, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from relcast.functions.headers import normalise_name, resolve_header
from relcast.session import hadoop_path, materialise, release
from relcast.sources.multiline import ASCII_BASED, read_multiline

# The header reader runs in Python workers; ship this module's functions by
# value so executors need no installed copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

FILE_PATH = "_file_path"
#: A first line longer than this is no header.
MAX_HEADER_BYTES = 16 << 20
#: Spark's names of file systems that Arrow knows under another name.
ARROW_SCHEMES = {"s3a": "s3", "s3n": "s3", "abfss": "abfs", "wasbs": "abfs"}


def arrow_location(path: str) -> tuple[str, str]:
    """(kind, location) of a listing path: ``local`` with a file name, or ``uri`` with a URI Arrow understands.

    Listing paths are not URI-escaped. ``dbfs:/x`` is mounted as ``/dbfs/x``.
    """
    from urllib.parse import quote

    scheme, colon, rest = path.partition(":")
    if not colon or "/" in scheme:
        return "local", path
    if scheme in ("file", "dbfs"):
        local = "/" + rest.lstrip("/")
        return "local", local if scheme == "file" else "/dbfs" + local
    return "uri", quote(f"{ARROW_SCHEMES.get(scheme, scheme)}:{rest}", safe=":/@?&=+$,;~!*'()")


def _open_fs(path: str):
    from pyarrow import fs as pafs

    kind, where = arrow_location(path)
    return (pafs.LocalFileSystem(), where) if kind == "local" else pafs.FileSystem.from_uri(where)


def _fields(line: str) -> list[str]:
    return next(csv.reader(io.StringIO(line.rstrip("\r").lstrip("\ufeff"))), [])


def _first_line(path: str, encoding: str) -> list[str]:
    filesystem, inner = _open_fs(path)
    buf = b""
    with filesystem.open_input_stream(inner) as stream:
        while b"\n" not in buf:
            chunk = stream.read(1 << 16)
            if not chunk:
                break
            buf += chunk
            if len(buf) > MAX_HEADER_BYTES:
                raise ValueError(f"no line end in the first {MAX_HEADER_BYTES} bytes of {path}")
    return _fields(buf.split(b"\n", 1)[0].decode(encoding, errors="replace"))


def _first_line_hadoop(spark: SparkSession, path: str, encoding: str) -> list[str]:
    """The first line through the Hadoop file system: opens the file and reads its first block only."""
    fs, where = hadoop_path(spark, path)
    jvm = spark.sparkContext._jvm
    reader = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(fs.open(where), encoding))
    try:
        return _fields(reader.readLine() or "")
    finally:
        reader.close()


def scan_file_path():
    """The scan's file path in the listing's (unescaped) form.

    ``_metadata.file_path`` is URI-escaped (space → %20, % → %25) while file
    listings are not; decode it, keeping a literal ``+`` as ``+``.
    """
    return F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B")))


def header_groups(files: DataFrame, encoding: str = "UTF-8") -> dict[tuple[str, ...], list[str]]:
    """Paths by header: what reaches the driver is every distinct header once, and the
    paths that its reader needs anyway.

    First lines are read in Python workers. Files that Arrow cannot open there
    (an unknown scheme, no client library) are opened through the Hadoop file
    system instead, a few at a time.
    """
    def heads(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyarrow import ArrowInvalid, ArrowNotImplementedError

        def one(path: str):
            try:
                return _first_line(path, encoding)
            except (ArrowInvalid, ArrowNotImplementedError, OSError):
                return None

        for pdf in batches:
            yield pd.DataFrame({"path": pdf["path"], "header": [one(p) for p in pdf["path"]]})

    spark = files.sparkSession
    found = files.select("path").mapInPandas(heads, "path string, header array<string>")
    found = materialise(found.select("path", "header", F.xxhash64("header").alias("id")), "headers")
    headers = {r["id"]: r["header"] for r in found.groupBy("id").agg(F.first("header").alias("header")).collect()}
    groups: dict[tuple[str, ...], list[str]] = {}
    unread = []
    for row in found.select("path", "id").collect():
        header = headers[row["id"]]
        if header is None:
            unread.append(row["path"])
        else:
            groups.setdefault(tuple(header), []).append(row["path"])
    release(found)
    with ThreadPoolExecutor(16) as pool:
        for path, header in zip(unread, pool.map(lambda p: _first_line_hadoop(spark, p, encoding), unread)):
            groups.setdefault(tuple(header), []).append(path)
    return {h: sorted(paths) for h, paths in sorted(groups.items())}


def _listed(spark: SparkSession, files: DataFrame | Sequence[str]) -> DataFrame:
    return files if isinstance(files, DataFrame) else spark.read.format("binaryFile").load(list(files)).select("path")


def _read(spark: SparkSession, schema: T.StructType, paths: Sequence[str], encoding: str, multi_line: bool = False) -> DataFrame:
    return (
        spark.read.schema(schema)
        .option("header", "true")
        .option("enforceSchema", "true")
        .option("escape", '"')
        .option("multiLine", "true" if multi_line else "false")
        .option("encoding", encoding)
        .option("mode", "PERMISSIVE")
        .csv(list(paths))
    )


def scan_csv(
    spark: SparkSession,
    files: DataFrame | Sequence[str],
    renames: Mapping[str, str] | None = None,
    encoding: str = "UTF-8",
    multi_line: bool = False,
    normalise: bool = True,
) -> DataFrame:
    """All-string scan of release files with normalised (and legacy-renamed) names.

    Files with line breaks inside quoted fields (``multi_line``) are read in
    splits too; only those in an encoding that is not based on ASCII are read
    one file per task.

    ``files`` is a listing DataFrame (with ``path``) or a list of paths. Adds
    ``_file_path`` (the scan's own ``_metadata.file_path``) for provenance.
    """
    parts = []
    for header, paths in header_groups(_listed(spark, files), encoding).items():
        if not header:  # empty files carry no columns and no rows
            continue
        names = resolve_header(list(header), renames) if normalise else list(header)
        schema = T.StructType([T.StructField(n, T.StringType(), True) for n in names])
        if multi_line and encoding.lower() in ASCII_BASED:
            parts.append(read_multiline(spark, schema, paths, FILE_PATH, encoding))
            continue
        df = _read(spark, schema, paths, encoding, multi_line)
        parts.append(df.select(*[F.col(f"`{n}`") for n in names], scan_file_path().alias(FILE_PATH)))
    return _united(parts)


def _united(parts: list[DataFrame]) -> DataFrame:
    if not parts:
        raise FileNotFoundError("no files to scan")
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p, allowMissingColumns=True)
    return out


def scan_csv_typed(spark: SparkSession, files: DataFrame | Sequence[str], schema: T.StructType | str, encoding: str = "UTF-8") -> DataFrame:
    """S3: declared-schema scan. Columns are found by header name (normalised on
    both sides), whatever their order; undeclared ones are left out, missing ones null."""
    declared = schema if isinstance(schema, T.StructType) else T.StructType.fromDDL(schema)
    by_name = {normalise_name(f.name): f for f in declared}
    parts = []
    for header, paths in header_groups(_listed(spark, files), encoding).items():
        if not header:
            continue
        names = [normalise_name(h) for h in header]
        fields = [T.StructField(by_name[n].name, by_name[n].dataType) if n in by_name else T.StructField(f"_undeclared_{i}", T.StringType())
                  for i, n in enumerate(names)]
        df = _read(spark, T.StructType(fields), paths, encoding)
        cols = [F.col(f"`{f.name}`") if normalise_name(f.name) in names else F.lit(None).cast(f.dataType).alias(f.name) for f in declared]
        parts.append(df.select(*cols, scan_file_path().alias(FILE_PATH)))
    return _united(parts)
