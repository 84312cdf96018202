"""MinHash near-duplicates with circulant signatures.

Two permutations make all coordinates: the first scatters the shingles over a
universe of fixed size, the second is a table that is shifted by one place for
each further coordinate. So coordinate k of a shingle at place i is table[i + k],
and a signature is the column-wise minimum of consecutive table slices. Bands of
the signature find candidates, which are confirmed on the full shingle sets.

Copies (equal sets) are collapsed first. A band bucket is not expanded into its
pairs: its members are confirmed against one centre. Members that are then
still in different components of a bucket are compared with each other block by
block inside tasks. So every candidate pair is compared or already in one component.
"""

from __future__ import annotations

import hashlib
import sys
import types
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from relcast.llm.common import bound_batches, connected_components, free_name, map_batches, written
from relcast.session import release

UNIVERSE_BITS = 22
_M1, _M2 = 0xFF51AFD7ED558CCD, 0xC4CEB9FE1A85EC53


@dataclass(frozen=True)
class Banding:
    """``bands`` bands of ``rows`` coordinates. A pair at similarity 0.8 is
    missed with probability (1 - 0.8**rows)**bands, 7e-6 as set here."""

    bands: int = 30
    rows: int = 5


BANDING = Banding()
#: Shingles are linked from 100 * intersection >= PERCENT * union on.
PERCENT = 80
#: Words of a shingle; the contract of the op6 query sets two.
SHINGLE = 5
QUERY_SHINGLE = 2


def worker_cache() -> dict:
    """A dictionary that lives as long as the worker process (functions that travel by value lose theirs with each task)."""
    module = sys.modules.setdefault("_worker_cache", types.ModuleType("_worker_cache"))
    return module.__dict__.setdefault("kept", {})


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers (the finalizer of MurmurHash3)."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(_M1)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(_M2)
    return x ^ (x >> np.uint64(33))


def circulant_table(width: int) -> np.ndarray:
    """The second permutation of the universe as a table, its first ``width`` places repeated at the end."""
    size = 1 << UNIVERSE_BITS
    mask, half = np.uint64(size - 1), np.uint64(UNIVERSE_BITS // 2)
    x = np.arange(size, dtype=np.uint64)
    for odd in (0x2C1B3C6D, 0x297A2D39, 0x1B56C4E9):  # each round is a bijection of the universe
        x = (x * np.uint64(odd)) & mask
        x = x ^ (x >> half)
    x = x.astype(np.uint32)
    return np.concatenate([x, x[:width]])


class _WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        import xxhash

        if len(self) > 1 << 16:
            self.clear()
        value = self[word] = xxhash.xxh64_intdigest(word)
        return value


def shingle_set(text: str | None, size: int = SHINGLE) -> np.ndarray:
    """The sorted 64-bit hashes of the distinct word shingles of a text.

    Words are runs of anything but ASCII white space, A-Z lower-cased. A text
    with fewer words than a shingle has its whole sequence as one; null texts
    and texts without words have none.
    """
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.empty(0, np.uint64)
    hashes = worker_cache().setdefault("words", _WordHashes())
    h = np.fromiter(map(hashes.__getitem__, words), np.uint64, len(words))
    size = min(size, len(words))
    out = mix64(h[:len(h) - size + 1] + np.uint64(size))
    for k in range(1, size):
        out = mix64(out + h[k:len(h) - size + 1 + k])
    return np.unique(out)


def signature(shingles: np.ndarray, width: int) -> np.ndarray:
    """``width`` circulant MinHash coordinates of a non-empty set."""
    cache = worker_cache()
    if ("table", width) not in cache:
        table = circulant_table(width)
        cache["table", width] = np.lib.stride_tricks.sliding_window_view(table, width)
    slices = cache["table", width]
    places = (mix64(shingles) >> np.uint64(64 - UNIVERSE_BITS)).astype(np.int64)  # the first permutation
    out = None
    for i in range(0, len(places), 4096):
        least = slices[places[i:i + 4096]].min(axis=0)
        out = least if out is None else np.minimum(out, least)
    return out


def band_keys(sig: np.ndarray, banding: Banding) -> np.ndarray:
    values = sig.astype(np.uint64).reshape(banding.bands, banding.rows)
    keys = np.arange(1, banding.bands + 1, dtype=np.uint64)
    for k in range(banding.rows):
        keys = mix64(keys * np.uint64(0x9E3779B97F4A7C15) + values[:, k])
    return keys.view(np.int64)


_SKETCH = T.StructType([
    T.StructField("row", T.LongType()), T.StructField("doc_id", T.LongType()), T.StructField("n_shingles", T.LongType()),
    T.StructField("digest", T.BinaryType()), T.StructField("bands", T.ArrayType(T.LongType())),
])


def _digest(shingles: np.ndarray) -> bytes | None:
    """128 bits that stand for a set; None for the empty one."""
    return hashlib.blake2b(shingles.tobytes(), digest_size=16).digest() if len(shingles) else None


def sketches(docs: DataFrame, banding: Banding = BANDING, size: int = SHINGLE, row: str | None = None) -> DataFrame:
    """(row, doc_id, n_shingles, digest of the set, band keys), one per input row; null digest and bands for empty sets."""
    def run(batch: pa.RecordBatch) -> dict:
        counts, digests, bands = [], [], []
        for text in batch.column(2).to_pylist():
            s = shingle_set(text, size)
            counts.append(len(s))
            digests.append(_digest(s))
            bands.append(band_keys(signature(s, banding.bands * banding.rows), banding) if len(s) else None)
        return {"row": batch.column(0), "doc_id": batch.column(1), "n_shingles": counts, "digest": digests, "bands": bands}

    number = F.lit(None).cast("long") if row is None else F.col(row)
    return map_batches(docs.select(number.alias("row"), F.col("doc_id").cast("long").alias("doc_id"), "text"), run, _SKETCH)


_SETS = T.StructType([T.StructField("d", T.BinaryType()), T.StructField("shingles", T.BinaryType())])


def _sets(docs: DataFrame, wanted: DataFrame, size: int) -> DataFrame:
    """(id, shingles): the full sets of the classes ``wanted`` (id, digest, least), one per class.

    Each is built from the texts of the class's smallest doc_id; where that id
    stands on several texts, the digest picks the class's own.
    """
    picked = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(wanted.select(F.col("least").alias("l")).distinct(), F.col("doc_id") == F.col("l"), "left_semi")

    def run(batch: pa.RecordBatch) -> dict:
        sets = [shingle_set(t, size) for t in batch.column(1).to_pylist()]
        return {"d": [_digest(s) for s in sets], "shingles": [s.tobytes() for s in sets]}

    return wanted.select("id", "digest").join(map_batches(picked, run, _SETS), F.col("digest") == F.col("d")).select("id", "shingles").dropDuplicates(["id"])


_CONFIRMED = T.StructType([T.StructField("a", T.LongType()), T.StructField("b", T.LongType()), T.StructField("shared", T.LongType()), T.StructField("either", T.LongType())])


def confirm(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """(a, b, shared, either): sizes of intersection and union for every pair (a, b)."""
    left = pairs.join(sets.select(F.col("id").alias("a"), F.col("shingles").alias("x")), "a")
    both = left.join(sets.select(F.col("id").alias("b"), F.col("shingles").alias("y")), "b").select("a", "b", "x", "y")
    bound_batches(pairs.sparkSession)
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("shared", pa.int64()), ("either", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            shared, either = [], []
            for x, y in zip(batch.column(2), batch.column(3)):
                x, y = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                n = len(np.intersect1d(x, y, assume_unique=True))
                shared.append(n)
                either.append(len(x) + len(y) - n)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(shared, pa.int64()), pa.array(either, pa.int64())], schema=schema)

    return both.mapInArrow(run, _CONFIRMED)


def _linked() -> F.Column:
    return 100 * F.col("shared") >= PERCENT * F.col("either")


def _sizes_allow(n, m) -> F.Column:
    """Two sets can only be linked if the smaller has PERCENT of the larger."""
    return 100 * F.least(n, m) >= PERCENT * F.greatest(n, m)


#: A block of an open group has about so many documents and so many shingles at most.
BLOCK_DOCS, BLOCK_SHINGLES = 512, 1 << 20


def _compare_blocks(rows):
    """Links between the documents of two blocks that join different labels (no more than it takes to join them)."""
    import pandas as pd

    minor, all_ = rows[rows["side"] == 0], rows[rows["side"] == 1]
    other = [np.frombuffer(x, np.uint64) for x in all_["shingles"]]
    values, cells = np.unique(np.concatenate(other), return_inverse=True)
    starts = np.cumsum([0, *(len(x) for x in other[:-1])])
    ids, labels, sizes, minors = (all_[c].to_numpy() for c in ("id", "label", "n", "minor"))
    root: dict[int, int] = {}

    def find(x: int) -> int:
        while (y := root.get(x, x)) != x:
            x = y
        return x

    out = []
    hit = np.zeros(len(values), np.int64)
    for i, label, n, shingles in zip(minor["id"], minor["label"], minor["n"], minor["shingles"]):
        may = (labels != label) & (~minors | (i < ids)) & (100 * np.minimum(n, sizes) >= PERCENT * np.maximum(n, sizes))
        if not may.any():
            continue
        mine = np.frombuffer(shingles, np.uint64)
        at = np.searchsorted(values, mine)
        at = at[values[np.minimum(at, len(values) - 1)] == mine]
        hit[at] = 1
        shared = np.add.reduceat(hit[cells], starts)
        hit[at] = 0
        for j in np.flatnonzero(may & (100 * shared >= PERCENT * (n + sizes - shared))):
            x, y = find(int(label)), find(int(labels[j]))
            if x != y:
                root[max(x, y)] = min(x, y)
                out.append((int(i), int(ids[j])))
    return pd.DataFrame(out, columns=["a", "b"]).astype("int64")


#: What it costs to bring a document to a comparison, in comparisons.
CARRY = 16


def _units(labelled: DataFrame) -> tuple[DataFrame, DataFrame]:
    """What is to be compared, unit by unit: (kind, unit, id, n, label), and per unit its blocks, main label and number of comparisons.

    ``labelled`` has the members of all buckets and their components so far
    (key, id, n, centre, label). In a unit, every document outside the most
    common component is compared with all documents of other components. Open
    buckets that share members form a group, and a unit is either such a group
    (kind 0) or one of its buckets (kind 1): whichever way takes less for the
    whole group. Where nearly all members are in one component already, the
    group is compared once; where a long chain of documents drifts apart,
    bucket by bucket, as only members of one bucket are candidates.
    """
    several = labelled.groupBy(F.col("key").alias("k")).agg(F.min("label").alias("lo"), F.max("label").alias("hi")).where(F.col("lo") != F.col("hi"))
    open_ = written(labelled.join(several, F.col("key") == F.col("k"), "left_semi"), "minhash-open")
    groups = connected_components(open_.select("id", "centre"), "id", "centre").select("node", F.col("component").alias("grp"))
    members = written(open_.join(groups, F.col("id") == F.col("node")).select("grp", "key", "id", "n", "label"), "minhash-groups")
    blocks = lambda docs, shingles: F.greatest(F.ceil(docs / BLOCK_DOCS), F.ceil(shingles / BLOCK_SHINGLES), F.lit(1))

    def stats(rows: DataFrame, unit: str) -> DataFrame:
        counts = rows.groupBy("grp", unit, "label").agg(F.count("*").alias("m"), F.sum("n").alias("s"))
        top = counts.groupBy("grp", F.col(unit).alias("unit")).agg(F.max(F.struct("m", "label", "s")).alias("top"), F.sum("m").alias("m"), F.sum("s").alias("s"))
        minor = F.col("m") - F.col("top.m")
        return top.select("grp", "unit", F.col("top.label").alias("main"), blocks(F.col("m"), F.col("s")).alias("all_blocks"), blocks(minor, F.col("s") - F.col("top.s")).alias("minor_blocks"),
                          (minor * F.col("m")).alias("comparisons"), (minor * F.col("m") + CARRY * F.col("m")).alias("cost"))

    distinct = members.withColumn("unit", F.col("grp")).select("grp", "unit", "id", "n", "label").distinct()
    whole, single = written(stats(distinct, "unit"), "minhash-by-group"), written(stats(members, "key"), "minhash-by-bucket")
    cheaper = whole.select(F.col("grp").alias("g"), "cost").join(single.groupBy(F.col("grp").alias("h")).agg(F.sum("cost").alias("apart")), F.col("g") == F.col("h"))
    cheaper = written(cheaper.select("g", (F.col("apart") < F.col("cost")).cast("int").alias("kind")), "minhash-ways")
    chosen = lambda rows, kind: rows.join(cheaper.where(F.col("kind") == kind), F.col("grp") == F.col("g"), "left_semi").withColumn("kind", F.lit(kind))
    parts = chosen(distinct, 0).unionByName(chosen(members.select("grp", F.col("key").alias("unit"), "id", "n", "label"), 1))
    return parts.drop("grp"), written(chosen(whole, 0).unionByName(chosen(single, 1)).drop("grp", "cost"), "minhash-stats")


def _between_components(joined: DataFrame, links: DataFrame, sets: DataFrame) -> DataFrame:
    """Links among the members of buckets that ``links`` leave in several components.

    The units of :func:`_units` are compared block by block, inside the tasks;
    no pair becomes a row.
    """
    label = F.coalesce("component", "id").alias("label")
    labelled = written(joined.join(connected_components(links), F.col("id") == F.col("node"), "left").select("key", "id", "n", "centre", label), "minhash-labels")
    members, stats = _units(labelled)
    stats = stats.select(F.col("kind").alias("k"), F.col("unit").alias("u"), "main", "all_blocks", "minor_blocks")
    placed = members.join(stats, (F.col("kind") == F.col("k")) & (F.col("unit") == F.col("u"))).withColumn("minor", F.col("label") != F.col("main"))
    own = lambda n: F.pmod(F.xxhash64("id"), F.col(n))
    upto = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.col(n) - 1))
    keep = ["kind", "unit", "id", "n", "label", "minor"]
    sides = (placed.where("minor").select(*keep, F.lit(0).alias("side"), own("minor_blocks").alias("bi"), upto("all_blocks").alias("bj"))
             .unionAll(placed.select(*keep, F.lit(1).alias("side"), own("all_blocks").alias("bj"), upto("minor_blocks").alias("bi"))
                       .select(*keep, "side", "bi", "bj")))
    full = sides.join(sets.select(F.col("id").alias("i"), "shingles"), F.col("id") == F.col("i")).drop("i")
    return full.groupBy("kind", "unit", "bi", "bj").applyInPandas(_compare_side, "a long, b long")


def _compare_side(rows):
    import pandas as pd

    if rows["side"].nunique() < 2:
        return pd.DataFrame({"a": [], "b": []}, dtype="int64")
    return _compare_blocks(rows)


def _labelled(docs: DataFrame, banding: Banding, size: int, row: str | None = None) -> DataFrame:
    """(row, doc_id, n_shingles, digest, component, least): the component (a number) and its smallest doc_id of every row; null for rows without a set or an id.

    Equal sets are a class, and classes are what is linked. They are numbered,
    so a doc_id that stands on several texts takes part with each of them.
    """
    rows = written(sketches(docs, banding, size, row), "minhash-sketches")
    known = rows.where(F.col("digest").isNotNull() & F.col("doc_id").isNotNull())
    classes = known.groupBy("digest").agg(F.min("doc_id").alias("least"), F.first("n_shingles").alias("n"), F.first("bands").alias("bands"))
    classes = written(classes.withColumn("id", F.monotonically_increasing_id()), "minhash-classes")
    keyed = classes.select(F.explode("bands").alias("key"), "id", "n")
    shared = keyed.groupBy(F.col("key").alias("k")).agg(F.min(F.struct("id", "n")).alias("c"), F.count("*").alias("m")).where(F.col("m") > 1)
    shared = written(shared.select("k", F.col("c.id").alias("centre"), F.col("c.n").alias("centre_n")), "minhash-buckets")
    joined = written(keyed.join(shared, F.col("key") == F.col("k")).drop("k"), "minhash-members")
    wanted = classes.join(joined.select(F.col("id").alias("i")).distinct(), F.col("id") == F.col("i"), "left_semi")
    wanted = written(wanted.select("id", "digest", "least"), "minhash-wanted")  # without the bands, so that the planner knows its size
    sets = written(_sets(docs, wanted, size), "minhash-sets")

    # every member against the centre of its buckets
    star = joined.where((F.col("id") != F.col("centre")) & _sizes_allow(F.col("n"), F.col("centre_n")))
    star = star.select(F.col("id").alias("a"), F.col("centre").alias("b")).distinct()
    first = written(confirm(star, sets), "minhash-star")
    links = first.where(_linked()).select("a", "b")

    # then the members of buckets that are still in several components among each other
    links = links.unionAll(written(_between_components(joined, links, sets), "minhash-more"))

    parts = connected_components(links)
    placed = classes.join(parts, F.col("id") == F.col("node"), "left").select("digest", "least", F.coalesce("component", "id").alias("component"))
    placed = written(placed, "minhash-placed")
    names = placed.groupBy(F.col("component").alias("c")).agg(F.min("least").alias("name"))
    by_digest = written(placed.join(names, F.col("component") == F.col("c")).select(F.col("digest").alias("d"), "component", "name"), "minhash-parts")
    out = rows.join(by_digest, (F.col("digest") == F.col("d")) & F.col("doc_id").isNotNull(), "left")
    out = out.select("row", "doc_id", "n_shingles", "component", F.coalesce("name", "doc_id").alias("least"))
    for scratch in (joined, shared, sets, first, placed):
        release(scratch)
    return out


def components(docs: DataFrame, banding: Banding = BANDING, size: int = SHINGLE) -> DataFrame:
    """doc_id, n_shingles, component_id, kept; one row per input row.

    ``component_id`` is the smallest doc_id reachable over links. Null texts
    and texts without words have no shingles and are linked with nothing. A
    null doc_id cannot name a component: such rows are kept, alone. Rows that
    repeat a doc_id are documents of their own, each linked by its own text.
    Other columns are not read; an empty table gives no rows.
    """
    rows = _labelled(docs, banding, size)
    return rows.select("doc_id", "n_shingles", F.col("least").alias("component_id"), F.col("doc_id").eqNullSafe(F.col("least")).alias("kept"))


def keep_documents(docs: DataFrame, banding: Banding = BANDING, size: int = SHINGLE) -> DataFrame:
    """``docs`` with one row of each component, all columns as they were.

    The row with the smallest doc_id stays; where this id stands on several
    linked texts, that with the smallest hash, and of rows that agree in id and
    text, any one. Rows with a null doc_id, a null text or a text without words
    are linked with nothing and stay. No text is lost: every row that goes has
    a row that stays among those it reaches over links. Columns may have any
    names. An empty table stays empty.

    Decisions are joined back by id and hash of the text, so texts are not
    copied or shuffled for it.
    """
    th = free_name(docs, "th")
    held = docs.withColumn(th, F.xxhash64("text"))
    rows = _labelled(held, banding, size, th).where(F.col("component").isNotNull())
    rows = written(rows.groupBy("component", "doc_id", "row").agg(F.count("*").alias("m")), "minhash-rows")
    stay = rows.groupBy("component").agg(F.min(F.struct("doc_id", "row")).alias("first")).select(F.col("first.doc_id").alias("i"), F.col("first.row").alias("r"))
    mine = (F.col("doc_id") == F.col("i")) & (F.col("row") == F.col("r"))
    number, text = free_name(held, "gone"), free_name(held, "gone_th")
    named = lambda x: x.select(F.col("doc_id").alias(number), F.col("row").alias(text))
    gone = written(named(rows.join(stay, mine, "left_anti")), "minhash-gone")
    # one row of those that agree with the row that stays in id and text
    twice = written(named(rows.where("m > 1").join(stay, mine, "left_semi")), "minhash-twice")
    release(rows)
    same = (F.col("doc_id") == F.col(number)) & (F.col(th) == F.col(text))
    kept = held.join(gone, same, "left_anti")
    if not twice.isEmpty():
        kept = kept.join(twice, same, "left_anti").unionByName(held.join(twice, same, "left_semi").dropDuplicates(["doc_id", th]))
    return kept.drop(th)


def op6_query(docs: DataFrame) -> DataFrame:
    return components(docs, size=QUERY_SHINGLE)
