"""Best-fit packing into sequences of several permitted lengths.

Pieces go in falling length into the open bin that they fill best. If none
takes a piece, a bin is opened, of the size whose cost per expected word is
least, given what is still to come that could fill it. In the end each bin
shrinks to the smallest permitted length that holds its contents. Shards are
packed in parallel; a shard has a bounded number of pieces.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right, insort

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from relcast.llm.common import WORD_RE, written

#: Permitted lengths in words.
CAPACITIES = (512, 1024, 2048, 4096, 8192)
#: Cost of a sequence: its length, a part that grows with its square
#: (attention), and a fixed part. LENGTH_SCALE is the length at which the
#: square part equals the linear one.
LENGTH_SCALE = 16384
FIXED_COST = 64
SHARD = 8192


def cost(capacity: int) -> float:
    return capacity + capacity * capacity / LENGTH_SCALE + FIXED_COST


def pack(lengths: list[int], capacities: tuple[int, ...] = CAPACITIES) -> tuple[list[int], list[int], list[int]]:
    """Packs ``lengths``, given in falling order, each within the largest capacity.

    Returns each piece's bin and its offset there, and each bin's capacity.
    """
    n = len(lengths)
    rising = lengths[::-1]
    sums = [0]
    for x in rising:
        sums.append(sums[-1] + x)
    free: list[tuple[int, int]] = []  # (room, bin) of open bins, by room
    bins, offsets, sizes, used = [], [], [], []
    for i, length in enumerate(lengths):
        at = bisect_left(free, (length, -1))
        if at < len(free):
            room, which = free.pop(at)
        else:
            left = n - 1 - i  # pieces still to come are the first ones of `rising`
            best = None
            for c in capacities:
                if c >= length:
                    filled = length + min(c - length, sums[min(left, bisect_right(rising, c - length))])
                    price = cost(c) / max(filled, 1)
                    if best is None or price < best[0]:
                        best = (price, c)
            room, which = best[1], len(sizes)
            sizes.append(best[1])
            used.append(0)
        bins.append(which)
        offsets.append(used[which])
        used[which] += length
        if room > length:
            insort(free, (room - length, which))
    return bins, offsets, [next(c for c in capacities if c >= u) for u in used]


_OUT = "doc_id long, piece long, start long, length long, bin string, capacity long, offset long"


def pack_documents(docs: DataFrame, capacities: tuple[int, ...] = CAPACITIES) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, bin, capacity, offset (in words).

    Documents longer than the largest capacity are cut there; the pieces of a
    document cover its words in order. A document without words (null or empty
    text) has one piece of length 0 and no bin. Null ids and repeated rows are
    ordinary documents. Other columns, whatever their names, are not read; an
    empty table gives no rows. Shards follow a hash of document and piece, so a very
    long document spreads over many; only ids and lengths are shuffled.
    """
    largest = max(capacities)
    capacities = tuple(sorted(capacities))
    sizes = written(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.regexp_count("text", F.lit(WORD_RE)), F.lit(0)).cast("long").alias("n"),
                                F.xxhash64("text").alias("h")), "pack-sizes")
    pieces = F.sequence(F.lit(0).cast("long"), F.greatest(F.ceil(F.col("n") / F.lit(largest)) - 1, F.lit(0)).cast("long"))
    n = sizes.agg(F.sum(F.greatest(F.ceil(F.col("n") / F.lit(largest)), F.lit(1)))).first()[0] or 0
    shards = max(1, -(-n // SHARD))
    cut = sizes.select("doc_id", "n", "h", F.explode(pieces).alias("piece"))
    start = F.col("piece") * largest
    cut = cut.select("doc_id", "piece", start.alias("start"), F.least(F.col("n") - start, F.lit(largest)).cast("long").alias("length"),
                     F.pmod(F.xxhash64("doc_id", "h", "piece"), F.lit(shards)).alias("shard"))

    def shard(rows: pd.DataFrame) -> pd.DataFrame:
        name = int(rows["shard"].iloc[0])
        rows = rows.sort_values(["length", "doc_id", "piece"], ascending=[False, True, True], ignore_index=True)
        bins, offsets, sizes = pack(rows["length"].tolist(), capacities)
        rows["bin"] = [f"{name}-{b}" for b in bins]
        rows["capacity"] = [sizes[b] for b in bins]
        rows["offset"] = offsets
        return rows[["doc_id", "piece", "start", "length", "bin", "capacity", "offset"]]

    empty = cut.where(F.col("length") == 0).select("doc_id", "piece", "start", "length", F.lit(None).cast("string").alias("bin"),
                                                   F.lit(None).cast("long").alias("capacity"), F.lit(None).cast("long").alias("offset"))
    return cut.where(F.col("length") > 0).groupBy("shard").applyInPandas(shard, _OUT).unionAll(empty)
