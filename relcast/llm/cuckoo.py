"""Exact deduplication by a cuckoo-filter index of live digests.

A text's key is the SHA-256 digest of its normalised form. Keys are dealt to
shards, and each shard is a cuckoo filter: a key has two buckets of four slots,
and its slot holds a short fingerprint, with the stored key beside it. A look-up
compares fingerprints; a hit is verified against the stored keys of the bucket.
An insertion that finds both buckets full moves keys to their other bucket; when
that does not end, the filter is doubled and filled again from the stored keys.
Deletion clears the slot of a key of which no copy lives.

Copies are added up in the tasks that read the texts, so a text that a third of
all rows share reaches its shard as one row per task and not as one per copy.
"""

from __future__ import annotations

from array import array
from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from relcast.llm.common import bound_batches, free_name, written
from relcast.session import release

SLOTS = 4
#: Moves after which an insertion counts as an overflow.
MOST_MOVES = 200
#: Distinct keys of a shard, about.
SHARD_KEYS = 1 << 16
#: Keys whose copies a reading task adds up before it passes them on.
COMBINED_KEYS = 1 << 16


class CuckooFilter:
    """Fingerprints in buckets, each with the number of its stored key.

    ``keys`` are the stored keys, 32 bytes each (uniform, as digests are);
    place ``None`` means deleted.
    """

    def __init__(self, buckets: int = 64):
        self.keys: list[bytes | None] = []
        self.spare: list[int] = []
        self._clear(buckets)

    def _clear(self, buckets: int) -> None:
        self.buckets = buckets
        self.prints = array("H", bytes(2 * SLOTS * buckets))
        self.stored = array("q", bytes(8 * SLOTS * buckets))

    def __len__(self) -> int:
        return len(self.keys) - len(self.spare)

    @staticmethod
    def fingerprint(key: bytes) -> int:
        return int.from_bytes(key[:2], "big") or 1

    def _first(self, key: bytes) -> int:
        return int.from_bytes(key[2:10], "big") & (self.buckets - 1)

    def _other(self, bucket: int, mark: int) -> int:
        return (bucket ^ (mark * 0x5BD1E995 >> 3)) & (self.buckets - 1)

    def may_hold(self, key: bytes) -> bool:
        """Whether the filter alone, without the stored keys, takes the key for present."""
        mark, at = self.fingerprint(key), self._first(key)
        return any(mark in self.prints[SLOTS * b:SLOTS * b + SLOTS] for b in (at, self._other(at, mark)))

    def find(self, key: bytes) -> int:
        """The slot of a key, -1 if it is absent: hits of the filter are verified against the bucket's stored keys."""
        mark, at = self.fingerprint(key), self._first(key)
        for b in (at, self._other(at, mark)):
            for slot in range(SLOTS * b, SLOTS * b + SLOTS):
                if self.prints[slot] == mark and self.keys[self.stored[slot]] == key:
                    return slot
        return -1

    def number(self, key: bytes) -> int:
        """The number of a stored key, -1 if it is absent."""
        slot = self.find(key)
        return self.stored[slot] if slot >= 0 else -1

    def insert(self, key: bytes) -> int:
        """Stores a key that is absent; returns its number."""
        if self.spare:
            number = self.spare.pop()
            self.keys[number] = key
        else:
            number = len(self.keys)
            self.keys.append(key)
        if not self._place(self.fingerprint(key), self._first(key), number):
            self.resize(2 * self.buckets)
        return number

    def delete(self, key: bytes) -> int:
        """Removes a key; returns the number it had, -1 if it was absent."""
        slot = self.find(key)
        if slot < 0:
            return -1
        number = self.stored[slot]
        self.prints[slot] = 0
        self.keys[number] = None
        self.spare.append(number)
        return number

    def resize(self, buckets: int) -> None:
        """Fills a filter of at least ``buckets`` buckets from the stored keys."""
        while True:
            self._clear(buckets)
            if all(key is None or self._place(self.fingerprint(key), self._first(key), i) for i, key in enumerate(self.keys)):
                return
            buckets *= 2

    def _place(self, mark: int, bucket: int, number: int) -> bool:
        prints, stored = self.prints, self.stored
        for move in range(MOST_MOVES):
            for b in (bucket, self._other(bucket, mark)):
                for slot in range(SLOTS * b, SLOTS * b + SLOTS):
                    if not prints[slot]:
                        prints[slot], stored[slot] = mark, number
                        return True
            slot = SLOTS * b + move % SLOTS  # the bucket is full: its key moves on
            mark, prints[slot] = prints[slot], mark
            number, stored[slot] = stored[slot], number
            bucket = self._other(b, mark)
        return False


# -------------------------------------------------------------------- the index

@dataclass
class Index:
    """The live digests of a table.

    ``members`` has a row per live row (uid, doc_id, digest), ``entries`` one
    per live digest (shard, digest, keep_uid, keep_id, copies).
    """

    members: DataFrame
    entries: DataFrame
    shards: int


def normalised(text: str = "text") -> Column:
    """The text with every run of ASCII white space replaced by one space; null counts as empty."""
    return F.regexp_replace(F.coalesce(F.col(text), F.lit("")), r"[\x20\x09-\x0D]+", " ")


def digest() -> Column:
    return F.unhex(F.sha2(normalised().cast("binary"), 256))


def _shard(shards: int) -> Column:
    return F.pmod(F.xxhash64("digest"), F.lit(shards))


#: Rows that stand for the copies of a digest: the smallest (doc_id, uid), ids that are null last, and their number.
_PART = T.StructType([T.StructField("digest", T.BinaryType()), T.StructField("keep_id", T.LongType()), T.StructField("keep_uid", T.LongType()), T.StructField("copies", T.LongType())])


def _order(doc_id: int | None, uid: int) -> tuple:
    return (doc_id is None, doc_id, uid)


def combined(members: DataFrame) -> DataFrame:
    """(digest, keep_id, keep_uid, copies): the copies of each digest added up within the task that reads them."""
    bound_batches(members.sparkSession)
    from pyspark.sql.pandas.types import to_arrow_schema

    arrow = to_arrow_schema(_PART)

    def flush(seen: dict) -> pa.RecordBatch:
        columns = zip(*((d, doc_id, uid, n) for d, ((_, doc_id, uid), n) in seen.items()))
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, arrow)], schema=arrow)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[bytes, tuple] = {}
        for batch in batches:
            for d, doc_id, uid in zip(*(c.to_pylist() for c in batch.columns)):
                place, n = _order(doc_id, uid), 1
                if d in seen:
                    before, n = seen[d]
                    place, n = min(place, before), n + 1
                seen[d] = (place, n)
            if len(seen) > COMBINED_KEYS:
                yield flush(seen)
                seen = {}
        if seen:
            yield flush(seen)

    return members.select("digest", "doc_id", "uid").mapInArrow(run, _PART)


_ENTRY = "shard long, digest binary, keep_id long, keep_uid long, copies long"


def _int(x) -> int | None:
    return None if x is None or pd.isna(x) else int(x)


def _settle(shard: int, live, gone=()) -> pd.DataFrame:
    """The entries of a shard after deletions and insertions."""
    index = CuckooFilter()
    best: list[tuple] = []
    copies: list[int] = []

    def absorb(d: bytes, doc_id: int | None, uid: int, n: int) -> None:
        at = index.number(d)
        if at >= 0:
            best[at], copies[at] = min(best[at], _order(doc_id, uid)), copies[at] + n
            return
        at = index.insert(d)
        if at == len(best):
            best.append(())
            copies.append(0)
        best[at], copies[at] = _order(doc_id, uid), n

    for d, doc_id, uid, n in live:
        absorb(bytes(d), doc_id, uid, n)
    for d, n, doc_id, uid in gone:
        at = index.number(bytes(d))
        if at < 0:
            continue
        copies[at] -= n
        if copies[at] <= 0:
            index.delete(bytes(d))
        else:
            best[at] = _order(doc_id, uid)
    rows = [(shard, d, best[i][1], best[i][2], copies[i]) for i, d in enumerate(index.keys) if d is not None]
    out = pd.DataFrame(rows, columns=["shard", "digest", "keep_id", "keep_uid", "copies"])
    return out.astype({"keep_id": "Int64"})


def _rows(part: pd.DataFrame) -> Iterator[tuple]:
    return zip(part["digest"], part["keep_id"].map(_int), part["keep_uid"], part["copies"])


def _text_ids(df: DataFrame) -> DataFrame:
    """Ids as text: pandas would turn a column with nulls into floats."""
    return df.withColumn("keep_id", F.col("keep_id").cast("string"))


def keyed(docs: DataFrame, uid: Column | None = None) -> DataFrame:
    """(uid, doc_id, digest) of every row."""
    return docs.select((F.monotonically_increasing_id() if uid is None else uid).cast("long").alias("uid"), F.col("doc_id").cast("long").alias("doc_id"), digest().alias("digest"))


def build(members: DataFrame) -> Index:
    """The index of the rows (uid, doc_id, digest) of a written table."""
    parts = written(combined(members), "cuckoo-parts")
    shards = max(1, -(-parts.count() // SHARD_KEYS))
    entries = _text_ids(parts).withColumn("shard", _shard(shards)).groupBy("shard").applyInPandas(lambda p: _settle(int(p["shard"].iloc[0]), _rows(p)), _ENTRY)
    index = Index(members, written(entries, "cuckoo-entries"), shards)
    release(parts)
    return index


def insert(index: Index, members: DataFrame) -> Index:
    """``index`` with further rows (uid, doc_id, digest); uids must be new. Shards are dealt anew once they outgrow their size."""
    parts = index.entries.select("digest", "keep_id", "keep_uid", "copies").unionByName(combined(members))
    parts = written(parts, "cuckoo-parts")
    shards = max(index.shards, -(-parts.count() // SHARD_KEYS))
    entries = _text_ids(parts).withColumn("shard", _shard(shards)).groupBy("shard").applyInPandas(lambda p: _settle(int(p["shard"].iloc[0]), _rows(p)), _ENTRY)
    return Index(written(index.members.unionByName(members), "cuckoo-members"), written(entries, "cuckoo-entries"), shards)


def delete(index: Index, uids: DataFrame) -> Index:
    """``index`` without the rows whose ``uid`` is in ``uids``; a digest without live rows leaves it. Unknown uids change nothing."""
    uids = uids.select(F.col("uid").cast("long").alias("uid")).distinct()
    left = written(index.members.join(uids, "uid", "left_anti"), "cuckoo-members")
    lost = written(combined(index.members.join(uids, "uid", "left_semi")).groupBy("digest").agg(F.sum("copies").alias("lost")), "cuckoo-lost")
    first = F.min(F.struct(F.col("keep_id").isNull().alias("none"), "keep_id", "keep_uid"))
    # what now stands first among the copies of the digests that lost some
    heirs = combined(left.join(lost, "digest", "left_semi")).groupBy("digest").agg(first.alias("h"))
    gone = lost.join(heirs, "digest", "left").select(_shard(index.shards).alias("shard"), "digest", "lost", F.col("h.keep_id").cast("string").alias("keep_id"), F.col("h.keep_uid").alias("keep_uid"))

    def settle(live: pd.DataFrame, gone: pd.DataFrame) -> pd.DataFrame:
        changes = zip(gone["digest"], gone["lost"], gone["keep_id"].map(_int), gone["keep_uid"].map(_int))
        return _settle(int((live if len(live) else gone)["shard"].iloc[0]), _rows(live), changes)

    entries = _text_ids(index.entries).groupBy("shard").cogroup(gone.groupBy("shard")).applyInPandas(settle, _ENTRY)
    return Index(left, written(entries, "cuckoo-entries"), index.shards)


def classes(index: Index) -> DataFrame:
    """uid, doc_id, keep_id, group_size, kept, text_sha256; one row per live row."""
    entries = index.entries.select(F.col("digest").alias("d"), "keep_id", "keep_uid", "copies")
    return index.members.join(entries, F.col("digest") == F.col("d")).select(
        "uid", "doc_id", "keep_id", F.col("copies").alias("group_size"), (F.col("uid") == F.col("keep_uid")).alias("kept"), F.lower(F.hex("digest")).alias("text_sha256"))


def duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256; one row per input row, dropped ones too.

    Of equal texts one row stays: that with the smallest doc_id; null ids come
    last, and of rows that repeat this id the first read stays. A null text
    counts as empty, and the empty texts are copies of each other. Columns
    other than doc_id and text are not read. An empty table gives no rows.
    """
    members = written(keyed(docs), "cuckoo-members")
    return classes(build(members)).drop("uid")


def keep_documents(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that :func:`duplicates` keeps, with all their columns."""
    uid = free_name(docs, "uid")
    held = written(docs.withColumn(uid, F.monotonically_increasing_id()), "cuckoo-docs")
    kept = build(written(keyed(held, F.col(uid)), "cuckoo-members")).entries.select(F.col("keep_uid").alias(free_name(held, "kept")))
    return held.join(kept, F.col(uid) == F.col(kept.columns[0]), "left_semi").drop(uid)


def op12_query(docs: DataFrame) -> DataFrame:
    return duplicates(docs)
