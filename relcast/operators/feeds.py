"""Feed selection over the release catalogue.

All feeds are matched in one pass: the feed phrases are a declared, fixed-size
list, so each catalogue row is tested against them in a projection
(``filter`` over a literal array) and exploded — no join with the feed list.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from relcast.functions.filedates import title_file_name, url_file_name
from relcast.operators.releases import missing_downloads

CSV_MEDIA_TYPE = "text/csv"


@dataclass(frozen=True)
class Download:
    """Distributions whose title contains ``phrase`` go to the feed's ``folder``.

    Their file name is the last segment of the URL (or what ``renames`` has for
    it), with ``by_title`` the title, or the one name ``fixed`` (``{date}`` in
    it is the day of the run).
    """

    folder: str
    phrase: str
    by_title: bool = False
    renames: Mapping[str, str] = field(default_factory=dict)
    fixed: str = ""


def tag_feeds(df: DataFrame, phrases: Mapping[str, str], text_col: str = "title", feed_col: str = "feed") -> DataFrame:
    """one row per (row, feed) whose phrase the text contains; rows matching no feed drop out."""
    table = F.array(*[F.struct(F.lit(f).alias("feed"), F.lit(p).alias("phrase")) for f, p in phrases.items()])
    hits = F.filter(table, lambda x: F.col(text_col).contains(x["phrase"]))
    return df.withColumn("_hit", F.explode(hits)).withColumn(feed_col, F.col("_hit.feed")).drop("_hit")


def renamed(name: Column, renames: Mapping[str, str]) -> Column:
    if not renames:
        return name
    lookup = F.create_map(*[F.lit(x) for kv in renames.items() for x in kv])
    return F.coalesce(F.element_at(lookup, name), name)


def release_file_names(df: DataFrame, rule: str = "url", renames: Mapping[str, str] | None = None,
                       url_col: str = "downloadURL", title_col: str = "title") -> DataFrame:
    """The local file name of each download (URL segment, fixed rename map, or title rule)."""
    return df.withColumn("file_name", title_file_name(title_col) if rule == "title" else renamed(url_file_name(url_col), renames or {}))


def select_feeds(catalog: DataFrame, feeds: Sequence[Download], as_of: str = "", media_type: str = CSV_MEDIA_TYPE) -> DataFrame:
    """F1 + F2 + T17: CSV distributions whose title names a feed, with ``folder`` and ``file_name``."""
    entry = [F.struct(F.lit(d.folder).alias("folder"), F.lit(d.phrase).alias("phrase"), F.lit(d.by_title).alias("by_title"),
                      F.lit(d.fixed.replace("{date}", as_of)).alias("fixed")) for d in feeds]
    hits = F.filter(F.array(*entry), lambda x: F.col("title").contains(x["phrase"]))
    rows = catalog.where(F.col("mediaType") == F.lit(media_type)).withColumn("_hit", F.explode(hits))
    url_name = url_file_name("downloadURL")
    renames = {k: v for d in feeds for k, v in d.renames.items()}
    name = (F.when(F.col("_hit.fixed") != "", F.col("_hit.fixed")).when(F.col("_hit.by_title"), title_file_name("title"))
            .otherwise(renamed(url_name, renames)))
    return rows.withColumns({"folder": F.col("_hit.folder"), "file_name": name}).drop("_hit")


def plan_downloads(catalog: DataFrame, feeds: Sequence[Download], present: DataFrame, as_of: str = "") -> DataFrame:
    """(folder, file_name, downloadURL, title, modified) of the files still to fetch.

    One row per file: of several distributions with one target name the most
    recently modified is taken, then the smallest URL. ``present`` has the
    (folder, file_name) that are there already.
    """
    wanted = select_feeds(catalog, feeds, as_of)
    newest = F.min_by(F.struct("downloadURL", "title", "modified"), F.struct(
        -F.coalesce(F.try_to_timestamp("modified").cast("long"), F.lit(0)), F.col("downloadURL"), F.col("title"), F.col("modified")))
    one = wanted.groupBy("folder", "file_name").agg(newest.alias("_d")).select("folder", "file_name", "_d.*")
    return missing_downloads(one, present, ["folder", "file_name"])
