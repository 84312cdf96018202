"""Mixing sources to target weights by pivotal dependent rounding.

Every document of a source gets the same fractional number of copies, target
over size. Whole parts are settled at once; fractional parts are rounded by
the pivotal method: two documents fight, one passes mass to the other until
one of them is integral, and the other goes on. Blocks of documents are
rounded in parallel, each leaves one residual at most, and a reduction tree
of further fights combines the residuals of a source. Within a block, fights
are between neighbours in size order, so that mass moves between documents of
like size and the words taken stay near the target.

What sources with few documents then still miss is made up by a few repairs:
in each, one document of a source goes from the copies below its rate to those
above or back, that whose size is nearest to what is missing. The rounding keeps
every document's expected number of copies; the repairs do not, but they move
REPAIRS documents of a source at most, by one copy each. In a source of hundreds
of documents that bias is under one in a hundred; in one of a few documents it
is the price for the words that they take.
"""

from __future__ import annotations

import hashlib
import math

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from relcast.llm.common import WORD_RE, free_name, written

WEIGHTS = (5, 2, 1)
SHARE = 1.5
MAX_COPIES = 2
BLOCK = 1024
FAN_IN = 64
REPAIRS = 3
_EPS = 1e-9


def sized(docs: DataFrame, key: str | None = None) -> DataFrame:
    """(row, key, doc_id, source, size, text_hash): size is the number of words, 0 for null texts; ``row`` numbers the rows."""
    return docs.select(
        F.monotonically_increasing_id().alias("row"), (F.lit(None).cast("long") if key is None else F.col(key)).alias("key"),
        F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"),
        F.coalesce(F.regexp_count("text", F.lit(WORD_RE)), F.lit(0)).cast("long").alias("size"),
        F.xxhash64("text").alias("text_hash"),
    )


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, most: int = MAX_COPIES) -> DataFrame:
    """(source, source_size, n_docs, weight, target) per source.

    Sources in code point order, null last, take the weights in turn and share
    ``share`` of all words. A target stops at ``most`` times its source's
    size; the excess is shared again by weight until none is above. Only the
    two sums of each round reach the driver. Ranks come from a range sort, so
    the list of sources is never in one task.
    """
    spark = sizes.sparkSession
    totals = written(sizes.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("n_docs")), "mix-totals")
    ranked = totals.orderBy(F.asc_nulls_last("source")).rdd.zipWithIndex().map(lambda x: (*x[0], weights[x[1] % len(weights)]))
    schema = T.StructType([
        T.StructField("source", T.StringType()), T.StructField("source_size", T.LongType()),
        T.StructField("n_docs", T.LongType()), T.StructField("weight", T.IntegerType()),
    ])
    ranked = written(spark.createDataFrame(ranked, schema), "mix-ranked")
    total = ranked.agg(F.sum("source_size")).first()[0] or 0
    cap = F.col("source_size") * most
    level, before = 0.0, -1
    while True:
        capped = cap < F.col("weight") * F.lit(level)
        row = ranked.agg(
            F.sum(F.when(capped, cap).otherwise(0)).alias("full"), F.sum(F.when(capped, 0).otherwise(F.col("weight"))).alias("open"),
            F.sum(capped.cast("int")).alias("n"),
        ).first()
        if not row["open"] or row["n"] == before:
            break
        level, before = (share * total - row["full"]) / row["open"], row["n"]
    return ranked.withColumn("target", F.least(cap.cast("double"), F.col("weight") * F.lit(level)))


def _uniform(*key) -> float:
    return int.from_bytes(hashlib.blake2b(repr(key).encode(), digest_size=8).digest(), "big") / 2.0**64


def fight(ids: list, masses: list[float], seed: int, source, last: bool) -> list[float]:
    """Sequential pivotal rounding of ``masses`` (each within 0 to 1).

    At most one of the results is fractional, none if ``last``. The sum is
    kept but for the final coin; each mass keeps its expectation.
    """
    out, carry = list(masses), -1
    for j, q in enumerate(out):
        if q <= _EPS or q >= 1 - _EPS:
            out[j] = float(round(q))
            continue
        if carry < 0:
            carry = j
            continue
        p, both = out[carry], out[carry] + q
        u = _uniform(seed, source, ids[carry], ids[j], carry, j)
        if both < 1 - _EPS:
            winner, loser = (j, carry) if u * both < q else (carry, j)
            out[winner], out[loser] = both, 0.0
            carry = winner
        elif both <= 1 + _EPS:
            winner, loser = (j, carry) if u * both < q else (carry, j)
            out[winner], out[loser], carry = 1.0, 0.0, -1
        else:
            winner, loser = (j, carry) if u * (2 - both) < 1 - p else (carry, j)
            out[winner], out[loser] = 1.0, both - 1
            carry = loser
    if last and carry >= 0:
        out[carry] = float(_uniform(seed, source, ids[carry]) < out[carry])
    return out


def _rounder(seed: int, last: bool):
    def round_block(block: pd.DataFrame) -> pd.DataFrame:
        block = block.sort_values(["size", "doc_id", "text_hash", "row"], ascending=[False, True, True, True], ignore_index=True)
        source = block["source"].iloc[0]
        ids = [None if pd.isna(i) else int(i) for i in block["doc_id"]]
        block["mass"] = fight(ids, block["mass"].tolist(), seed, None if pd.isna(source) else source, last)
        block["block"] = block["block"] // FAN_IN
        return block

    return round_block


#: Ids travel as text: pandas would turn a column with nulls into floats.
_STATE = "row long, key string, doc_id string, source string, text_hash long, size long, whole int, mass double, block long"


def copies(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, most: int = MAX_COPIES, seed: int = 17, key: str | None = None) -> DataFrame:
    """One row per input row: key, doc_id, source, text_hash, size, source_size, target, copies, taken.

    ``key`` is what stands in the column of that name, null if none is named.

    Reruns agree: chance comes from hashes of the ids. Null texts and texts
    without words have size 0 and take part like others; a source without
    words has target 0 and no copies. Null sources are one source; null ids
    and repeated rows are ordinary documents. An empty table gives no rows.
    """
    sizes = written(sized(docs, key), "mix-sizes")
    goals = written(targets(sizes, weights, share, most), "mix-targets")
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    blocks = F.ceil(F.col("n_docs") / F.lit(BLOCK))
    near = F.round(rate)
    whole = F.when(F.abs(rate - near) < _EPS, near).otherwise(F.floor(rate))
    goal = goals.select(F.col("source").alias("s"), rate.alias("rate"), whole.cast("int").alias("whole"), blocks.alias("blocks"))
    state = (sizes.join(goal, F.col("source").eqNullSafe(F.col("s")))
             .select("row", F.col("key").cast("string").alias("key"), F.col("doc_id").cast("string").alias("doc_id"), "source", "text_hash", "size", "whole", F.greatest(F.col("rate") - F.col("whole"), F.lit(0.0)).alias("mass"),
                     F.pmod(F.xxhash64("doc_id", "text_hash"), F.col("blocks")).alias("block")))
    levels = max(1, 1 + math.ceil(math.log(max(1, goals.agg(F.max(blocks)).first()[0] or 1), FAN_IN)))
    settled = []
    for level in range(levels):
        last = level == levels - 1
        done = written(state.groupBy("source", "block").applyInPandas(_rounder(seed + level, last), _STATE), f"mix-level{level}")
        open_mass = (F.col("mass") > 0) & (F.col("mass") < 1)
        settled.append(done if last else done.where(~open_mass))
        state = done.where(open_mass)
    rows = settled[0]
    for more in settled[1:]:
        rows = rows.unionAll(more)
    goal = goals.select(F.col("source").alias("s"), "source_size", "target", (F.abs(rate - near) >= _EPS).alias("open"))
    rows = rows.withColumns({"doc_id": F.col("doc_id").cast("long"), "key": F.col("key").cast("long")})
    rows = rows.join(goal, F.col("source").eqNullSafe(F.col("s"))).withColumn("copies", F.col("whole") + F.col("mass").cast("int"))
    rows = rows.select("row", "key", "doc_id", "source", "text_hash", "size", "source_size", "target", "open", "whole", "copies")
    for _ in range(REPAIRS):
        rows = _repaired(rows)
    return rows.select("key", "doc_id", "source", "text_hash", "size", "source_size", "target", "copies", (F.col("copies") * F.col("size")).cast("long").alias("taken"))


def _repaired(rows: DataFrame) -> DataFrame:
    """``rows`` with one document per source moved to its other number of copies, where that brings the source nearer to its target."""
    missing = written(rows.groupBy(F.col("source").alias("s")).agg((F.first("target") - F.sum(F.col("copies") * F.col("size"))).alias("miss")), "mix-missing")
    by = F.abs(F.abs(F.col("miss")) - F.col("size"))
    spare = F.when(F.col("miss") > 0, F.col("copies") == F.col("whole")).otherwise(F.col("copies") > F.col("whole"))
    able = rows.where("open").join(missing, F.col("source").eqNullSafe(F.col("s"))).where(spare & (by < F.abs(F.col("miss"))))
    best = able.groupBy("source").agg(F.min_by("row", F.struct(by.alias("by"), F.col("doc_id"), F.col("text_hash"), F.col("row"))).alias("moved"))
    moved = written(best.select("moved"), "mix-moved")
    other = F.when(F.col("copies") == F.col("whole"), F.col("whole") + 1).otherwise(F.col("whole"))
    out = rows.join(moved, F.col("row") == F.col("moved"), "left")
    return out.withColumn("copies", F.when(F.col("moved").isNotNull(), other).otherwise(F.col("copies"))).drop("moved")


def mix_documents(docs: DataFrame, **options) -> DataFrame:
    """``docs`` with every row repeated as often as the mix takes it (0 to 2 times).

    Rows are drawn one by one: rows that agree in doc_id and text but not in
    another column, as the source, have copies of their own. Rows that agree in
    all columns cannot be told apart; together they are repeated as often as
    they were drawn. Null texts, ids and sources are treated as in
    :func:`copies`. Columns may have any names (maps are not compared) and are
    returned as they were. An empty table stays empty.

    Draws are joined back by id and hash of the row, so nothing is copied; the
    table of draws has a row per document and is shuffled at any size.
    """
    row = free_name(docs, "row")
    held = docs.withColumn(row, F.xxhash64(*[F.col(f"`{f.name}`") for f in docs.schema if not isinstance(f.dataType, T.MapType)]))
    number, key, times = free_name(held, "drawn"), free_name(held, "drawn_row"), free_name(held, "times")
    drawn = copies(held, key=row, **options).groupBy(F.col("doc_id").alias(number), F.col("key").alias(key)).agg(F.sum("copies").cast("int").alias(times), F.count("*").alias("m"))
    drawn = written(drawn.where(F.col(times) > 0), "mix-drawn")
    same = F.col("doc_id").cast("long").eqNullSafe(F.col(number)) & (F.col(row) == F.col(key))
    pick = lambda rows, which: rows.join(drawn.where(which).drop("m").hint("merge"), same)
    kept = pick(held, F.col("m") == 1)
    if not drawn.where("m > 1").isEmpty():
        kept = kept.unionByName(pick(held, F.col("m") > 1).dropDuplicates(["doc_id", row]))
    return kept.withColumn(number, F.explode(F.sequence(F.lit(1), F.col(times)))).select(*[F.col(f"`{c}`") for c in docs.columns])


def op10_query(docs: DataFrame) -> DataFrame:
    return copies(docs).select("doc_id", "size", "source_size", "target", "taken", "source", "copies")
