"""Release catalogue (S4): nested JSON ``dataset[].distribution[]`` → one row per distribution."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Catalogue fields kept, dataset-level then distribution-level.
DATASET_FIELDS = ("accessLevel", "bureauCode", "accrualPeriodicity", "describedBy", "description")
DISTRIBUTION_FIELDS = ("format", "downloadURL", "accessURL", "mediaType", "title", "modified", "temporal")

DISTRIBUTION_TYPE = T.StructType([T.StructField(f, T.StringType()) for f in DISTRIBUTION_FIELDS])
DATASET_TYPE = T.StructType(
    [T.StructField(f, T.StringType()) for f in DATASET_FIELDS]
    + [T.StructField("distribution", T.ArrayType(DISTRIBUTION_TYPE))]
)
CATALOG_SCHEMA = T.StructType([T.StructField("dataset", T.ArrayType(DATASET_TYPE))])


def read_catalog(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    """Read catalogue JSON with an explicit schema (a field published as an array reads as its JSON text)."""
    return spark.read.schema(CATALOG_SCHEMA).option("multiLine", "true" if multi_line else "false").json(path)


def flatten_catalog(catalog: DataFrame) -> DataFrame:
    """Dataset fields × each distribution; absent keys become ``""``.

    A dataset without distributions yields no row (``explode``, not ``explode_outer``).
    """
    ds = catalog.select(F.explode("dataset").alias("d"))
    dist = ds.select("d", F.explode("d.distribution").alias("x"))
    cols = [F.coalesce(F.col(f"d.{f}"), F.lit("")).alias(f) for f in DATASET_FIELDS]
    cols += [F.coalesce(F.col(f"x.{f}"), F.lit("")).alias(f) for f in DISTRIBUTION_FIELDS]
    return dist.select(*cols)


# ---- fields outside the schema, kept as variants

#: Columns that hold what a catalogue publishes beyond the declared fields.
DATASET_EXTRA, DISTRIBUTION_EXTRA = "dataset_extra", "distribution_extra"
_OPEN_SCHEMA = "dataset array<map<string, variant>>"


def read_open_catalog(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    """Catalogue JSON with every field of its datasets, whatever its name and type, as a variant."""
    return spark.read.schema(_OPEN_SCHEMA).option("multiLine", "true" if multi_line else "false").json(path)


def _text(value: Column) -> Column:
    """A field as the declared reader gives it: text as it is, other values as JSON (here without the file's spacing)."""
    return F.coalesce(value.cast("string"), F.lit(""))


def flatten_open_catalog(catalog: DataFrame) -> DataFrame:
    """:func:`flatten_catalog` with two more columns: the fields of the dataset and of the distribution that are not declared.

    They are maps from name to variant, empty where there are none; nothing
    that a catalogue publishes is lost. Null values stay as variant nulls.
    """
    ds = catalog.select(F.explode("dataset").alias("d"))
    dist = ds.select("d", F.explode(F.col("d")["distribution"].cast("array<map<string, variant>>")).alias("x"))
    cols = [_text(F.col("d")[f]).alias(f) for f in DATASET_FIELDS] + [_text(F.col("x")[f]).alias(f) for f in DISTRIBUTION_FIELDS]
    rest = lambda c, known: F.map_filter(F.coalesce(F.col(c), F.create_map().cast("map<string, variant>")), lambda k, _: ~k.isin(*known))
    return dist.select(*cols, rest("d", (*DATASET_FIELDS, "distribution")).alias(DATASET_EXTRA), rest("x", DISTRIBUTION_FIELDS).alias(DISTRIBUTION_EXTRA))


def extra(path: str, kind: str, of: str = DISTRIBUTION_EXTRA) -> Column:
    """An undeclared field by its path (``contactPoint.fn``, ``keyword[1]``) as a typed column; null where it is absent or of another type."""
    at = min((i for i in (path.find("."), path.find("[")) if i >= 0), default=len(path))
    return F.try_variant_get(F.col(of)[path[:at]], f"${path[at:]}", kind)


def extra_fields(flat: DataFrame) -> DataFrame:
    """(level, field, type, n): every undeclared field of a flattened catalogue with the type that holds all of its values."""
    parts = None
    for level, column in (("dataset", DATASET_EXTRA), ("distribution", DISTRIBUTION_EXTRA)):
        part = flat.select(F.lit(level).alias("level"), F.explode(column).alias("field", "value"))
        parts = part if parts is None else parts.unionAll(part)
    return parts.groupBy("level", "field").agg(F.schema_of_variant_agg("value").alias("type"), F.count("*").alias("n"))
