"""Merkle manifest of a dataset: a tree of SHA-256 hashes with retained midstates.

A leaf is the hash of a row. Per source, leaves in the order of their ids are
hashed in runs of FAN_OUT into parents until one node, the subroot, remains;
the subroots, in the order of the sources, likewise give the root.

A parent is hashed child by child, and a copy of the hash state is retained
before each child slot. To fold a changed child up, the state of its slot is
resumed with the replacement and the siblings to its right only: what stands to
the left is in the state already.

No task holds a tree. Nodes are ranked by a range sort, and TIER levels are
built at once by tasks of FAN_OUT ** TIER nodes each, whatever the source's
size. The way down carries one path of siblings per such block, from which its
task restores the ancestors' states once for all of its rows.
"""

from __future__ import annotations

import hashlib

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from relcast.llm.common import ascii_lower, bound_batches, written
from relcast.session import release

#: Children of a node.
FAN_OUT = 16
#: Levels that one task builds: a block has FAN_OUT ** TIER nodes at most.
TIER = 3
BLOCK = FAN_OUT ** TIER
#: The columns of a row that its leaf covers, in order.
COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")


# ------------------------------------------------------------------ one block

class Parent:
    """A node with the hash states that stood before each of its child slots."""

    def __init__(self, children: list[str]):
        self.children = children
        self.states = []
        running = hashlib.sha256()
        for child in children:
            self.states.append(running.copy())
            running.update(child.encode())
        self.digest = running.hexdigest()

    def fold(self, slot: int, replacement: str) -> str:
        """The digest with another child in ``slot``: its state resumed, right siblings only."""
        return resume(self.states[slot], replacement, self.right(slot))

    def left(self, slot: int) -> str:
        return "".join(self.children[:slot])

    def right(self, slot: int) -> str:
        return "".join(self.children[slot + 1:])


def resume(state, replacement: str, right: str) -> str:
    running = state.copy()
    running.update((replacement + right).encode())
    return running.hexdigest()


def levels_of(n: int) -> int:
    """Levels above ``n`` nodes until one remains."""
    out = 0
    while n > 1:
        n, out = -(-n // FAN_OUT), out + 1
    return out


def grow(digests: list[str], levels: int) -> list[list[Parent]]:
    """The parents of each of ``levels`` levels over ``digests``."""
    tree = []
    for _ in range(levels):
        tree.append([Parent(digests[i:i + FAN_OUT]) for i in range(0, len(digests), FAN_OUT)])
        digests = [p.digest for p in tree[-1]]
    return tree


# --------------------------------------------------------------------- leaves

def _field(c: Column) -> Column:
    c = c.cast("string")
    return F.when(c.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(c).cast("string"), F.lit(":"), c))


def leaf(text: Column | None = None) -> Column:
    """The leaf hash of a row, hex; ``text`` stands in for the row's own text if given."""
    values = [F.col(c) for c in COLUMNS[:-1]] + [F.col("text") if text is None else text]
    return F.sha2(F.concat(*[_field(v) for v in values]), 256)


def tampered(share: int = 5) -> Column:
    """Whether a row belongs to the tampered ones; rows without an id do not."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % share == 0, F.lit(False))


# -------------------------------------------------------------------- ranking

def ranked(rows: DataFrame, group: str, order: list[str]) -> DataFrame:
    """``rows`` with ``sid`` (rank of the group, null first), ``pos`` (place in the group by ``order``) and ``n`` (size of the group).

    A range sort places the rows; only a count per partition and group is
    added up, so a group may span any number of tasks. ``rows`` must be a
    written table: its rows must not change between jobs.
    """
    spark = rows.sparkSession
    bound_batches(spark)
    keys = [group, *order, "_uid"]
    sortable = rows.withColumn("_uid", F.monotonically_increasing_id())
    placed = sortable.repartitionByRange(*keys).sortWithinPartitions(*keys)
    at = placed.columns.index(group)
    schema = T.StructType([*placed.schema.fields, T.StructField("_part", T.IntegerType()), T.StructField("_seq", T.LongType())])
    from pyspark.sql.pandas.types import to_arrow_schema

    arrow = to_arrow_schema(schema)

    def number(batches):
        from pyspark import TaskContext

        part, last, seq = TaskContext.get().partitionId(), None, 0
        for batch in batches:
            seqs = []
            for value in batch.column(at).to_pylist():
                seq = seq + 1 if last == (value,) else 0
                last = (value,)
                seqs.append(seq)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array([part] * len(seqs), pa.int32()), pa.array(seqs, pa.int64())], schema=arrow)

    numbered = written(placed.mapInArrow(number, schema), "merkle-ranked")
    counts = numbered.groupBy(F.col(group).alias("_g"), F.col("_part").alias("_p")).agg(F.count("*").alias("_c"))
    # a group has a row per partition that it spans; groups are numbered like rows, by a second range sort
    within = Window.partitionBy("_g").orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)
    offsets = written(counts.withColumns({"_before": F.coalesce(F.sum("_c").over(within), F.lit(0)), "n": F.sum("_c").over(Window.partitionBy("_g"))}), "merkle-offsets")
    groups = offsets.select("_g").distinct().orderBy(F.asc_nulls_first("_g")).rdd.zipWithIndex().map(lambda x: (x[0][0], x[1]))
    schema = T.StructType([T.StructField("_h", rows.schema[group].dataType), T.StructField("sid", T.LongType())])
    sids = written(spark.createDataFrame(groups, schema), "merkle-groups")
    offsets = offsets.join(sids, F.col("_g").eqNullSafe(F.col("_h"))).drop("_h", "_c")
    out = numbered.join(offsets, F.col(group).eqNullSafe(F.col("_g")) & (F.col("_part") == F.col("_p")))
    return out.withColumn("pos", F.col("_before") + F.col("_seq")).drop("_g", "_p", "_part", "_seq", "_before", "_uid")


# -------------------------------------------------------------------- up, down

def _up(block: pd.DataFrame) -> pd.DataFrame:
    """The one node that a block of nodes becomes."""
    block = block.sort_values("pos")
    n = int(block["n"].iloc[0])
    tree = grow(block["digest"].tolist(), min(TIER, levels_of(n)))
    digest = tree[-1][0].digest if tree else block["digest"].iloc[0]
    return pd.DataFrame({"sid": [block["sid"].iloc[0]], "pos": [block["pos"].iloc[0] // BLOCK], "n": [-(-n // BLOCK)], "digest": [digest]})


def _tiers(nodes: DataFrame) -> list[DataFrame]:
    """Tables (sid, pos, n, digest), from the given nodes up to one per sid."""
    tiers = [nodes]
    while (tiers[-1].agg(F.max("n")).first()[0] or 1) > 1:
        above = tiers[-1].groupBy("sid", _block()).applyInPandas(_up, "sid long, pos long, n long, digest string")
        tiers.append(written(above, "merkle-tier"))
    return tiers


def _block() -> Column:
    return F.floor(F.col("pos") / BLOCK).alias("block")


def _paths(block: pd.DataFrame, above: pd.DataFrame):
    """The parents of a sorted block level by level, and the siblings left and right of its path above."""
    tree = grow(block["digest"].tolist(), min(TIER, levels_of(int(block["n"].iloc[0]))))
    lefts, rights = list(above["lefts"].iloc[0]), list(above["rights"].iloc[0])
    return tree, lefts, rights


def _down(block: pd.DataFrame, above: pd.DataFrame) -> pd.DataFrame:
    """The path of siblings of every node of a block, its own levels first."""
    block = block.sort_values("pos", ignore_index=True)
    tree, lefts, rights = _paths(block, above)
    out = []
    for i in range(len(block)):
        l, r = [], []
        for parents in tree:
            i, slot = divmod(i, FAN_OUT)
            l.append(parents[i].left(slot))
            r.append(parents[i].right(slot))
        out.append((l + lefts, r + rights))
    return pd.DataFrame({"sid": block["sid"], "block": block["pos"], "lefts": [x[0] for x in out], "rights": [x[1] for x in out],
                         "subroot": above["subroot"].iloc[0], "root": above["root"].iloc[0]})


def _fold(block: pd.DataFrame, above: pd.DataFrame) -> pd.DataFrame:
    """Proof and folded root of every row of a block."""
    block = block.sort_values("pos", ignore_index=True)
    tree, lefts, rights = _paths(block, above)
    ancestors = []  # one retained state per ancestor of the block, for all of its rows
    for left, right in zip(lefts, rights):
        ancestors.append((hashlib.sha256(left.encode()), right))
    beyond = "".join(l + r for l, r in zip(lefts, rights)).encode()
    proofs, folded = [], []
    for i, digest in enumerate(block["given"]):
        proof = hashlib.sha256()
        for parents in tree:
            i, slot = divmod(i, FAN_OUT)
            proof.update((parents[i].left(slot) + parents[i].right(slot)).encode())
            digest = parents[i].fold(slot, digest)
        proof.update(beyond)
        for state, right in ancestors:
            digest = resume(state, digest, right)
        proofs.append(proof.hexdigest())
        folded.append(digest)
    root = above["root"].iloc[0]
    return pd.DataFrame({"doc_id": block["doc_id"], "leaf": block["digest"], "subroot": above["subroot"].iloc[0], "root": root,
                         "proof_sha256": proofs, "folded_root": folded, "verified": [f == root for f in folded]})


_PATH = "sid long, block long, lefts array<string>, rights array<string>, subroot string, root string"
#: Ids travel as text: pandas would turn a column with nulls into floats.
_OUT = "doc_id string, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"


def manifest(docs: DataFrame, given: Column | None = None) -> DataFrame:
    """One row per row: doc_id, leaf, subroot, root, proof_sha256, folded_root, verified.

    ``given`` is the leaf that is folded up along the row's path, by default
    the row's own; ``verified`` says whether it leads to the root. Null values
    are hashed as ``-``, empty ones as ``0:``; null sources are one source,
    the first; null ids come first within theirs. Rows that repeat an id stand
    in the order of their leaves, and equal rows have equal leaves. Columns
    that a leaf does not cover are not read. An empty table gives no rows.
    """
    own = leaf()
    leaves = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"), own.alias("digest"),
                         (own if given is None else given).alias("given"))
    leaves = written(leaves, "merkle-leaves")
    nodes = written(ranked(leaves, "source", ["doc_id", "digest"]).select("sid", "pos", "n", F.col("doc_id").cast("string").alias("doc_id"), "digest", "given"), "merkle-nodes")
    release(leaves)
    tiers = _tiers(nodes.select("sid", "pos", "n", "digest"))
    subroots = tiers[-1].select(F.lit(0).cast("long").alias("sid"), F.col("sid").alias("pos"), F.lit(tiers[-1].count()).cast("long").alias("n"), "digest")
    sources = _tiers(subroots)
    none = F.array().cast("array<string>")
    path = sources[-1].select("sid", F.lit(0).cast("long").alias("block"), none.alias("lefts"), none.alias("rights"), F.lit(None).cast("string").alias("subroot"),
                              F.col("digest").alias("root"))
    for tier in reversed(sources[:-1] or sources):
        path = _descend(tier, path)
    # a source's path is that of its subroot, which stands at place sid among the sources
    path = path.join(tiers[-1].select(F.col("sid").alias("s"), "digest"), F.col("block") == F.col("s"))
    path = written(path.select(F.col("s").alias("sid"), F.lit(0).cast("long").alias("block"), "lefts", "rights", F.col("digest").alias("subroot"), "root"), "merkle-paths")
    for tier in reversed(tiers[1:-1]):
        path = _descend(tier, path)
    out = nodes.groupBy("sid", _block()).cogroup(path.groupBy("sid", "block")).applyInPandas(_fold, _OUT)
    return out.withColumn("doc_id", F.col("doc_id").cast("long"))


def _descend(tier: DataFrame, path: DataFrame) -> DataFrame:
    """The paths of the nodes of a tier, from those of its blocks."""
    return written(tier.groupBy("sid", _block()).cogroup(path.groupBy("sid", "block")).applyInPandas(_down, _PATH), "merkle-paths")


def op11_query(docs: DataFrame) -> DataFrame:
    """The manifest of ``docs``, tampered texts folded in their place."""
    text = F.when(tampered(), ascii_lower(F.col("text"))).otherwise(F.col("text"))
    return manifest(docs, leaf(text))
