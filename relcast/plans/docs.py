"""Table and column documentation (K5) through catalog comments."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession


def _quote(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def register_table(spark: SparkSession, name: str, path: str) -> None:
    """Expose a parquet folder as a catalog table (partitions discovered)."""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} USING parquet LOCATION {_quote(path)}")
    try:
        spark.sql(f"ALTER TABLE {name} RECOVER PARTITIONS")
    except Exception:  # unpartitioned tables have nothing to recover
        pass


def document(spark: SparkSession, name: str, table_comment: str | None, column_comments: Mapping[str, str]) -> None:
    """Table comment plus column comments; partition columns cannot carry a comment,
    so their descriptions are appended to the table comment."""
    columns = {c.name: c for c in spark.catalog.listColumns(name)}
    on_partitions = {c: t for c, t in column_comments.items() if c in columns and columns[c].isPartition}
    text = table_comment
    if on_partitions:
        extra = "; ".join(f"{c}: {t}" for c, t in on_partitions.items())
        text = f"{text} ({extra})" if text else extra
    if text is not None:
        spark.sql(f"COMMENT ON TABLE {name} IS {_quote(text)}")
    for col, comment in column_comments.items():
        if col in columns and col not in on_partitions:
            spark.sql(f"ALTER TABLE {name} ALTER COLUMN `{col}` COMMENT {_quote(comment)}")


def column_docs(spark: SparkSession, name: str) -> DataFrame:
    """(col_name, data_type, comment) of a table, partition columns included once."""
    return spark.sql(f"DESCRIBE TABLE {name}").where(
        "col_name NOT LIKE '#%' AND col_name <> ''"
    ).dropDuplicates(["col_name"])
