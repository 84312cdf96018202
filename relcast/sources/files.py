"""File listing and table lookups.

A release folder is listed with the ``binaryFile`` source restricted to
``path`` and ``length``, so file contents are never read. Several globs are
a union with a ``glob_rank`` column (earlier glob wins ties later on).
"""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from relcast.functions.filedates import name_of
from relcast.session import hadoop_path

LISTING_SCHEMA = "path string, file_name string, length bigint, glob_rank int"


def list_releases(spark: SparkSession, folder: str, globs: Sequence[str] = ("*",)) -> DataFrame:
    """One row per file in ``folder`` matching any glob: path, file_name, length, glob_rank."""
    parts = []
    for rank, glob in enumerate(globs):
        listing = (
            spark.read.format("binaryFile")
            .option("pathGlobFilter", glob)
            .load(folder)
            .select("path", "length")
        )
        parts.append(listing.select("path", name_of("path").alias("file_name"), "length", F.lit(rank).alias("glob_rank")))
    if not parts:
        return spark.createDataFrame([], LISTING_SCHEMA)
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    # A file matched by two globs counts once, under its first glob.
    return out.groupBy("path", "file_name", "length").agg(F.min("glob_rank").alias("glob_rank"))


def is_path(target: str) -> bool:
    """A folder rather than a catalog table name."""
    return "/" in target or ":" in target


def table_exists(spark: SparkSession, target: str) -> bool:
    """A catalog table name or a parquet folder that already holds data."""
    if not is_path(target):
        return spark.catalog.tableExists(target)
    fs, path = hadoop_path(spark, target)
    if not fs.exists(path):
        return False
    # Holds data: any entry that is not a marker, summary or staging entry.
    names = [st.getPath().getName() for st in fs.listStatus(path)]
    return any(not n.startswith((".", "_")) or "=" in n for n in names)


# ---- table schema beside the data (K4): no load has to open the footers of the whole table

SCHEMA_FILE = "_relcast_schema.json"


def save_schema(spark: SparkSession, target: str, schema: T.StructType) -> None:
    fs, path = hadoop_path(spark, f"{target.rstrip('/')}/{SCHEMA_FILE}")
    out = fs.create(path, True)
    out.write(schema.json().encode())
    out.close()


def saved_schema(spark: SparkSession, target: str) -> T.StructType | None:
    fs, path = hadoop_path(spark, f"{target.rstrip('/')}/{SCHEMA_FILE}")
    if not fs.exists(path):
        return None
    jvm = spark.sparkContext._jvm
    stream = fs.open(path)
    text = jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    stream.close()
    return T.StructType.fromJson(json.loads(text))


def merged_schema(spark: SparkSession, target: str, incoming: T.StructType) -> T.StructType:
    """The target's schema with the columns that are new in ``incoming``; a changed type is refused."""
    if not table_exists(spark, target):
        return incoming
    present = read_table(spark, target).schema
    types = {f.name: f.dataType for f in present}
    for f in incoming:
        if f.name in types and types[f.name] != f.dataType:
            raise ValueError(f"column {f.name} of {target} is {types[f.name].simpleString()}, incoming {f.dataType.simpleString()}")
    new = [T.StructField(f.name, f.dataType, True) for f in incoming if f.name not in types]
    return T.StructType([*present.fields, *new])


def read_table(spark: SparkSession, target: str) -> DataFrame:
    """S5 with K4: a table, or a parquet folder whose periods may lack later columns.

    The schema kept beside the data is used; only a folder without one has its
    footers merged.
    """
    if not is_path(target):
        return spark.read.table(target)
    schema = saved_schema(spark, target)
    if schema is not None:
        return spark.read.schema(schema).parquet(target)
    return spark.read.option("mergeSchema", "true").parquet(target)


def partition_keys(spark: SparkSession, target: str, columns: Sequence[str]) -> DataFrame:
    """Distinct values of partition columns, from folder names alone (no data file is opened)."""
    if is_path(target):
        listing = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").load(target)
        return listing.select(*columns).distinct()
    text = spark.sql(f"SHOW PARTITIONS {target}")
    types = {f.name: f.dataType for f in spark.table(target).schema}
    value = lambda c: F.regexp_extract("partition", rf"(?:^|/){c}=([^/]*)", 1)
    plain = lambda c: F.url_decode(F.replace(value(c), F.lit("+"), F.lit("%2B")))
    none = "__HIVE_DEFAULT_PARTITION__"
    return text.select(*[F.when(plain(c) != none, plain(c)).cast(types[c]).alias(c) for c in columns]).distinct()
