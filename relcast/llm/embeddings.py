"""Near-duplicate embeddings by a pivot-permutation index.

A vector is described by its nearest reference points (pivots) in order. Each
pivot has an inverted list of the vectors that name it; two vectors of a list
are candidates if they share enough pivots, and are then verified by their
cosine. A pair that meets in several lists is judged in that of its smallest
shared pivot only.

Equal vectors are collapsed first. Long lists are cut into blocks, and every
pair of blocks is one group of rows for a task, which returns for each vector
the number of links found and one link to its component there. Pairs never
become rows.
"""

from __future__ import annotations

import hashlib
import math
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from relcast.llm.common import connected_components, map_batches, written
from relcast.session import release

COSINE = 0.93


@dataclass(frozen=True)
class Index:
    """``nearest`` pivots describe a vector; candidates share at least ``shared``.

    The pivots are a sample of the vectors: twice the square root of their
    number, within ``least`` and ``most``. Every vector is indexed.
    """

    nearest: int = 8
    shared: int = 2
    least: int = 128
    most: int = 4096
    block: int = 512


INDEX = Index()


def unit(vector) -> np.ndarray | None:
    """The vector scaled to length 1 in double precision; None if null, empty, zero, or not finite throughout."""
    if vector is None or any(x is None for x in vector):
        return None
    v = np.asarray(vector, np.float64)
    if not len(v) or not np.isfinite(v).all():
        return None
    largest = np.abs(v).max()
    if largest == 0:
        return None
    v = v / largest  # so that squares neither overflow nor vanish
    return v / math.sqrt(float(v @ v))


_ROW = T.StructType([
    T.StructField("vec_id", T.LongType()), T.StructField("label", T.StringType()), T.StructField("digest", T.BinaryType()),
    T.StructField("dim", T.IntegerType()), T.StructField("vector", T.BinaryType()),
])


def prepared(rows: DataFrame) -> DataFrame:
    """(vec_id, label, digest, dim, vector); digest and vector are null where nothing can be linked."""
    def run(batch: pa.RecordBatch) -> dict:
        digests, dims, vectors = [], [], []
        for vec_id, label, vector in zip(*(c.to_pylist() for c in batch.columns)):
            v = unit(vector) if vec_id is not None and label is not None else None
            # the digest is that of the given vector: adding zero makes -0.0 equal to 0.0
            digests.append(None if v is None else hashlib.blake2b((np.asarray(vector, np.float64) + 0.0).tobytes(), digest_size=16).digest())
            dims.append(None if v is None else len(v))
            vectors.append(None if v is None else v.tobytes())
        return {"vec_id": batch.column(0), "label": batch.column(1), "digest": digests, "dim": dims, "vector": vectors}

    return map_batches(rows.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("string").alias("label"), "embedding"), run, _ROW)


_POSTED = T.StructType([*[T.StructField(n, T.LongType()) for n in ("rep", "copies")], T.StructField("label", T.StringType()),
                        T.StructField("dim", T.IntegerType()), T.StructField("vector", T.BinaryType()), T.StructField("pivots", T.ArrayType(T.IntegerType()))])


def described(classes: DataFrame, index: Index = INDEX) -> DataFrame:
    """``classes`` with the ordered nearest pivots of each vector.

    The sample of pivots is that with the smallest hashes of the vector, at
    most ``index.most`` rows, and goes to the tasks. Vectors of a length that
    no pivot has share the one list -1.
    """
    n = classes.count()
    size = max(index.least, min(index.most, 2 * math.isqrt(n)))
    sample = classes.select("dim", "vector", F.xxhash64("digest").alias("h"), "label").orderBy("h", "label").limit(size).collect()
    by_dim: dict[int, np.ndarray] = {}
    for dim in {r["dim"] for r in sample}:
        by_dim[dim] = np.array([np.frombuffer(r["vector"], np.float64) for r in sample if r["dim"] == dim])

    def run(batch: pa.RecordBatch) -> dict:
        dims = batch.column(3).to_pylist()
        vectors = batch.column(4).to_pylist()
        pivots: list = [[-1]] * len(dims)
        for dim, points in by_dim.items():
            at = [i for i, d in enumerate(dims) if d == dim]
            for k in range(0, len(at), 1024):
                part = at[k:k + 1024]
                near = np.array([np.frombuffer(vectors[i], np.float64) for i in part]) @ points.T
                m = min(index.nearest, len(points))
                for i, order in zip(part, np.argsort(-near, axis=1, kind="stable")[:, :m]):
                    pivots[i] = order.tolist()
        return {f: batch.column(j) for j, f in enumerate(("rep", "copies", "label", "dim", "vector"))} | {"pivots": pivots}

    return map_batches(classes.select("rep", "copies", "label", "dim", "vector"), run, _POSTED)


def _compare(index: Index):
    def compare(rows: pd.DataFrame) -> pd.DataFrame:
        """Links between the vectors of two blocks of a list (or within one)."""
        pivot = int(rows["pivot"].iloc[0])
        same = int(rows["bi"].iloc[0]) == int(rows["bj"].iloc[0])
        rows = rows.sort_values("rep", ignore_index=True)
        left = rows if same else rows[rows["block"] == rows["bi"]]
        right = rows if same else rows[rows["block"] == rows["bj"]]
        if not len(left) or not len(right):
            return _NO_LINKS
        width = 1 + max(int(max(p)) for p in rows["pivots"])
        x, y = (np.array([np.frombuffer(v, np.float64) for v in side["vector"]]) for side in (left, right))
        a, b = (_incidence(side["pivots"], width) for side in (left, right))
        if pivot >= 0:
            enough = np.minimum(index.shared, np.minimum(a.sum(1)[:, None], b.sum(1)[None, :]))
            may = (a @ b.T >= enough) & (a[:, :pivot] @ b[:, :pivot].T == 0)
        else:
            may = np.ones((len(left), len(right)), bool)
        links = may & (x @ y.T >= COSINE)
        if same:
            links = np.triu(links, 1)
        ids = np.concatenate([left["rep"].to_numpy(), right["rep"].to_numpy()])
        copies_l, copies_r = left["copies"].to_numpy(), right["copies"].to_numpy()
        counts = np.concatenate([links @ copies_r, copies_l @ links])
        n, root = len(left), np.arange(len(ids))
        order = np.argsort(ids, kind="stable")
        rank = np.empty(len(ids), np.int64)
        rank[order] = np.arange(len(ids))
        far = len(ids)
        while True:  # the smallest rank reachable inside the block
            low = np.concatenate([np.minimum(rank[:n], np.where(links, rank[None, n:], far).min(1)), np.minimum(rank[n:], np.where(links, rank[:n, None], far).min(0))])
            if same:
                low = np.tile(np.minimum(low[:n], low[n:]), 2)
            if (low == rank).all():
                break
            rank = low
        root = ids[order][rank]
        found = counts > 0
        return pd.DataFrame({"rep": ids[found], "links": counts[found], "root": root[found]}).astype("int64")

    return compare


_NO_LINKS = pd.DataFrame({"rep": [], "links": [], "root": []}, dtype="int64")


def _incidence(lists, width: int) -> np.ndarray:
    out = np.zeros((len(lists), max(width, 1)), np.float32)
    for i, pivots in enumerate(lists):
        out[i, [p for p in pivots if p >= 0]] = 1
    return out


def links(classes: DataFrame, index: Index = INDEX) -> DataFrame:
    """(rep, links, root): per vector and block pair, the rows linked with it (copies counted) and the smallest id of its component there."""
    posted = written(described(classes, index).select("*", F.explode("pivots").alias("pivot")), "pivot-lists")
    lists = ["label", "dim", "pivot"]
    sizes = posted.groupBy(*lists).agg(F.ceil(F.count("*") / F.lit(index.block)).alias("blocks"))
    sizes = written(sizes.select(*[F.col(c).alias(f"s_{c}") for c in lists], "blocks"), "pivot-sizes")
    placed = posted.join(sizes, [F.col(c) == F.col(f"s_{c}") for c in lists]).drop(*[f"s_{c}" for c in lists])
    placed = placed.withColumn("block", F.pmod(F.xxhash64("rep"), F.col("blocks")))
    placed = placed.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1))).drop("blocks")
    placed = placed.withColumn("bi", F.least("block", "other")).withColumn("bj", F.greatest("block", "other")).drop("other")
    return placed.groupBy(*lists, "bi", "bj").applyInPandas(_compare(index), "rep long, links long, root long")


def components(rows: DataFrame, index: Index = INDEX) -> DataFrame:
    """vec_id, n_links, component_id, kept; one row per input row.

    Links join vectors of equal, non-null labels (and equal length) with a
    cosine of COSINE or more. Null, zero and not finite vectors, null labels
    and null ids link with nothing; a null id has a null component and is
    kept. Repeated rows are vectors of their own, also where a vec_id stands on
    several vectors or labels: each links by its own. Other columns are not
    read; an empty table gives no rows.
    """
    ready = written(prepared(rows), "pivot-rows")
    known = ready.where(F.col("digest").isNotNull())
    # equal vectors of a label are a class; classes are numbered, and linked
    classes = known.groupBy("label", "digest").agg(F.min("vec_id").alias("least"), F.count("*").alias("copies"), F.first("dim").alias("dim"), F.first("vector").alias("vector"))
    classes = written(classes.withColumn("rep", F.monotonically_increasing_id()), "pivot-classes")
    found = written(links(classes, index), "pivot-links")
    counts = found.groupBy(F.col("rep").alias("r")).agg(F.sum("links").alias("links"))
    parts = connected_components(found, "rep", "root")
    judged = classes.select(F.col("label").alias("l"), F.col("digest").alias("d"), "rep", "least", "copies")
    judged = judged.join(counts, F.col("rep") == F.col("r"), "left").join(parts, F.col("rep") == F.col("node"), "left")
    judged = written(judged.select("l", "d", "least", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n"), F.coalesce("component", "rep").alias("c")), "pivot-judged")
    names = judged.groupBy(F.col("c").alias("nc")).agg(F.min("least").alias("name"))
    judged = written(judged.join(names, F.col("c") == F.col("nc")).select("l", "d", "n", "name"), "pivot-named")
    component = F.coalesce("name", "vec_id")
    out = ready.join(judged, (F.col("label") == F.col("l")) & (F.col("digest") == F.col("d")), "left")
    release(found)
    return out.select("vec_id", F.coalesce("n", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"), F.col("vec_id").eqNullSafe(component).alias("kept"))


def op7_query(rows: DataFrame) -> DataFrame:
    return components(rows)
