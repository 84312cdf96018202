"""Identifier crosswalk (G1, U1, H5, P3, T12): npi ↔ other identifier with validity dates.

All facility types are tagged and unioned first, then aggregated once, so the
job is one shuffle on (type, npi, id) with map-side partial aggregation.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from relcast.functions.identifiers import join_token
from relcast.operators.intervals import interval_join, presence_intervals

# The constant columns of the CCN crosswalk.
CCN_TYPE_DESC = "CCN"
CCN_ISSUER = "MEDICARE"
CCN_TYPE_CODE = "06"

CROSSWALK_COLUMNS = (
    "npi", "other_id_token", "other_id", "other_id_type_code", "other_id_state", "other_id_issuer",
    "other_id_type_desc", "other_id_dt_s", "other_id_dt_e", "facility_type",
)


def id_crosswalk(
    tables: Mapping[str, DataFrame],
    id_col: str = "ccn",
    npi_col: str = "npi",
    state_col: str = "state",
    date_col: str = "_input_file_date",
    type_desc: str = CCN_TYPE_DESC,
    issuer: str = CCN_ISSUER,
    type_code: str = CCN_TYPE_CODE,
) -> DataFrame:
    """Per (facility type, npi, id): first and last period seen, and the state of
    the earliest period (smallest non-null state on ties)."""
    tagged = None
    for ftype, df in tables.items():
        part = df.select(
            F.col(npi_col).alias("npi"), F.col(id_col).alias("other_id"), F.col(state_col).alias("state"),
            F.col(date_col).alias("d"), F.lit(ftype).alias("facility_type"),
        )
        tagged = part if tagged is None else tagged.unionByName(part)
    agg = tagged.groupBy("facility_type", "npi", "other_id").agg(
        F.min("d").alias("other_id_dt_s"),
        F.max("d").alias("other_id_dt_e"),
        F.min_by("state", F.struct("d", F.col("state").isNull(), "state")).alias("other_id_state"),
    )
    return _entries(agg, type_desc, issuer, type_code)


def _entries(agg: DataFrame, type_desc: str, issuer: str, type_code: str, more: Sequence[str] = ()) -> DataFrame:
    """The constant columns and the token."""
    out = agg.withColumns({
        "other_id_type_desc": F.lit(type_desc),
        "other_id_issuer": F.lit(issuer),
        "other_id_type_code": F.lit(type_code),
    })
    out = out.withColumn("other_id_token", join_token(
        "other_id", "other_id_type_code", "other_id_state", "other_id_issuer", "other_id_type_desc",
        "other_id_dt_s", "other_id_dt_e",
    ))
    return out.select(*CROSSWALK_COLUMNS, *more)


def id_crosswalk_history(
    tables: Mapping[str, DataFrame],
    id_col: str = "ccn",
    npi_col: str = "npi",
    state_col: str = "state",
    date_col: str = "_input_file_date",
    type_desc: str = CCN_TYPE_DESC,
    issuer: str = CCN_ISSUER,
    type_code: str = CCN_TYPE_CODE,
) -> DataFrame:
    """The crosswalk with one row per run of consecutive releases in which a pair stood with one state.

    :func:`id_crosswalk` keeps the first and last period of a pair only. Here
    an id that left and came back, or moved, has several entries, whose dates
    do not overlap. Each facility type has its own release calendar.
    ``is_current`` tells the entries of its newest release.
    """
    runs = None
    for ftype, df in tables.items():
        part = df.select(F.col(npi_col).alias("npi"), F.col(id_col).alias("other_id"), F.col(state_col).alias("other_id_state"), F.col(date_col).alias("d"))
        part = presence_intervals(part, ["npi", "other_id"], "d", ["other_id_state"]).withColumn("facility_type", F.lit(ftype))
        runs = part if runs is None else runs.unionByName(part)
    runs = runs.withColumnsRenamed({"first_period": "other_id_dt_s", "last_period": "other_id_dt_e"})
    current = runs.select("npi", "other_id", "facility_type", "other_id_state", "other_id_dt_s", "other_id_dt_e", "is_current")
    return _entries(current, type_desc, issuer, type_code, ("is_current",))


def entries_on(rows: DataFrame, crosswalk: DataFrame, at: str, npi_col: str = "npi", how: str = "left") -> DataFrame:
    """Rows with the crosswalk entries of their npi that are valid on the date ``at``."""
    entries = crosswalk.withColumnRenamed("npi", npi_col)
    return interval_join(rows, entries, [npi_col], at, "other_id_dt_s", "other_id_dt_e", how)
