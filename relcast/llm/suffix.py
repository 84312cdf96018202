"""Removal of repeated passages by longest previous factors.

A byte goes if a string of LENGTH bytes that covers it also starts in an
earlier document. In suffix order, the earlier matches of a position are its
previous and next smaller positions; the longest previous factor is its longest
common prefix with either. Only whether it reaches LENGTH matters here, so
suffixes are sorted by their first LENGTH bytes and, where these agree, by
document: then the previous smaller position with a long enough prefix, if
there is one, is at the head of the run of equal prefixes.

A suffix array of the whole corpus does not fit a task, so equal suffixes are
brought together by their content. The smallest hash among the k-mers of a
string of LENGTH bytes is its anchor: equal strings have equal anchors.

1. Anchors of all texts are reduced to those that occur in two documents.
2. Stretches of strings with such an anchor ("pieces") are dealt out by anchor;
   each task sorts the suffixes of its pieces and finds the previous factors.
3. Each document looks up its pieces and drops what is covered.

Copies are settled before and inside each batch, so a passage that a third of
the documents share is sent once per batch. Anchors that would still gather
too many different pieces are dealt out string by string instead.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from relcast.llm.common import map_batches, written
from relcast.session import release

LENGTH = 50
KMER = 20
_SPAN = LENGTH - KMER + 1  # k-mers in a string
_CHUNK = 1 << 15
#: Text bytes per bucket of anchors, at least so many buckets, and slots of pieces per bucket.
BUCKET_BYTES, LEAST_BUCKETS, SLOTS = 32 << 20, 64, 4
#: An anchor in more batches than this, and than a HOT_SHARE of all, is dealt out string by string.
HOT_BATCHES, HOT_SHARE = 4096, 1e-4


def anchors(data: bytes) -> np.ndarray:
    """The anchor of the string of LENGTH bytes at every position."""
    if len(data) < LENGTH:
        return np.empty(0, np.uint64)
    with np.errstate(over="ignore"):
        x = np.frombuffer(data, np.uint8).astype(np.uint64)
        x += np.uint64(1)
        x *= np.uint64(0xC2B2AE3D27D4EB4F)
        power, size = np.uint64(0x9E3779B97F4A7C15), 1
        four = None
        while size < 16:  # hashes of 1, 2, 4, 8, 16 bytes, each from two of the former
            x = x[:-size] * power + x[size:]
            power, size = power * power, size * 2
            if size == 4:
                four, four_power = x, power
        h = x[:len(data) - KMER + 1] * four_power + four[16:]
        h ^= h >> np.uint64(32)
        h *= np.uint64(0xFF51AFD7ED558CCD)
        h ^= h >> np.uint64(29)
    size = 1
    while size * 2 <= _SPAN:
        h = np.minimum(h[:-size], h[size:])
        size *= 2
    rest = _SPAN - size
    return np.minimum(h[:-rest], h[rest:]) if rest else h


def anchored(texts: list[bytes]) -> Iterator[np.ndarray]:
    """Anchors of each text; short texts are hashed together, since a call costs more than a short text."""
    start = 0
    while start < len(texts):
        end, size = start, 0
        while end < len(texts) and (size == 0 or size + len(texts[end]) <= _CHUNK):
            size += len(texts[end])
            end += 1
        found, at = anchors(b"".join(texts[start:end])), 0
        for text in texts[start:end]:
            yield found[at:at + max(0, len(text) - LENGTH + 1)]
            at += len(text)
        start = end


def pieces(found: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last position of each stretch with one anchor, cut to _SPAN positions (longer ones repeat themselves)."""
    if not len(found):
        return np.empty(0, np.int64), np.empty(0, np.int64)
    starts = np.flatnonzero(np.concatenate([[True], found[1:] != found[:-1]]))
    sizes = np.diff(np.append(starts, len(found)))
    if (sizes > _SPAN).any():
        parts = -(-sizes // _SPAN)
        first = np.repeat(starts, parts)
        step = np.arange(len(first)) - np.repeat(np.cumsum(parts) - parts, parts)
        ends = np.repeat(starts + sizes, parts)
        starts = first + step * _SPAN
        return starts, np.minimum(starts + _SPAN, ends) - 1
    return starts, starts + sizes - 1


def previous_factors(texts: list[bytes], docs: np.ndarray) -> list[int]:
    """For each piece a mask of the positions whose string is in a piece of a smaller document."""
    sizes = np.array([len(t) - LENGTH + 1 for t in texts])
    owner = np.repeat(np.arange(len(texts)), sizes)
    offset = np.arange(len(owner)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    begins = np.cumsum([0, *(len(t) for t in texts[:-1])])
    data = np.frombuffer(b"".join(texts), np.uint8)
    suffixes = np.lib.stride_tricks.sliding_window_view(data, LENGTH)[begins[owner] + offset]
    suffixes = np.ascontiguousarray(suffixes).view(f"S{LENGTH}").ravel()
    order = np.argsort(docs[owner], kind="stable")
    order = order[np.argsort(suffixes[order], kind="stable")]  # suffix order, equal prefixes by document
    ranked, by = suffixes[order], docs[owner][order]
    head = np.concatenate([[True], ranked[1:] != ranked[:-1]])
    smaller = by > by[np.maximum.accumulate(np.where(head, np.arange(len(by)), 0))]
    masks = np.zeros(len(texts), np.int64)
    np.bitwise_or.at(masks, owner[order[smaller]], np.int64(1) << offset[order[smaller]])
    return masks.tolist()


def _all(size: int) -> int:
    return (1 << size) - 1


def _text(batch: pa.RecordBatch, name: str) -> list[bytes]:
    return [b"" if t is None else t for t in batch.column(name).cast(pa.binary()).to_pylist()]


# --------------------------------------------------------- 1: shared anchors

_KIND_SEND, _KIND_SHARED, _KIND_HOT = 0, 1, 2
_SENT = T.StructType([T.StructField("kind", T.IntegerType()), T.StructField("bucket", T.IntegerType()),
                      T.StructField("docs", T.BinaryType()), T.StructField("ids", T.BinaryType())])


def _mixed(found: np.ndarray) -> np.ndarray:
    """Anchors are minima, so small values are by far more frequent; this spreads them evenly."""
    with np.errstate(over="ignore"):
        return found * np.uint64(0x9E3779B97F4A7C15)


def _bucket_and_low(mixed: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Bucket and 32 more bits of a mixed anchor; together they stand for it."""
    return (mixed >> np.uint64(64 - bits)).astype(np.int32), (mixed & np.uint64(0xFFFFFFFF)).astype(np.uint32)


def _ids(found: np.ndarray, bits: int) -> np.ndarray:
    bucket, low = _bucket_and_low(_mixed(found), bits)
    return (bucket.astype(np.int64) << 32) | low.astype(np.int64)


def _send(bits: int):
    def send(batch: pa.RecordBatch) -> dict:
        out: dict[str, list] = {c: [] for c in ("kind", "bucket", "docs", "ids")}
        doc_ids = batch.column("doc_id").to_numpy(zero_copy_only=False)
        found = [np.unique(_mixed(a)) for a in anchored(_text(batch, "text"))]
        values = np.concatenate(found) if found else np.empty(0, np.uint64)
        docs = np.repeat(doc_ids, [len(a) for a in found]).astype(np.int64)
        order = np.lexsort((docs, values))
        values, docs = values[order], docs[order]
        if len(values):
            head = np.concatenate([[True], values[1:] != values[:-1]])
            group = np.cumsum(head) - 1
            several = np.bincount(group[np.concatenate([[False], docs[1:] != docs[:-1]]) & ~head], minlength=group[-1] + 1)[group] > 0
            bucket, low = _bucket_and_low(values, bits)
            ids = (bucket.astype(np.int64) << 32) | low.astype(np.int64)
            # anchors of two documents of the batch are shared already; one of them stands for the batch
            for kind, pick, keep in ((_KIND_SEND, head, True), (_KIND_SHARED, several, False)):
                at = np.flatnonzero(pick)
                cuts = np.flatnonzero(np.diff(bucket[at])) + 1 if keep else []
                for part in np.split(at, cuts) if len(at) else []:
                    out["kind"].append(kind)
                    out["bucket"].append(int(bucket[part[0]]))
                    out["docs"].append(docs[part].tobytes())
                    out["ids"].append(low[part].tobytes() if keep else ids[part].tobytes())
        return out

    return send


def _meet(limit: int):
    def meet(rows: pd.DataFrame) -> pd.DataFrame:
        """(kind, doc_id, id): anchors of a bucket that occur in several documents, and the hot ones among them."""
        docs = np.frombuffer(b"".join(rows["docs"]), np.int64)
        low = np.frombuffer(b"".join(rows["ids"]), np.uint32)
        order = np.lexsort((docs, low))
        docs, low = docs[order], low[order]
        head = np.concatenate([[True], low[1:] != low[:-1]])
        starts = np.flatnonzero(head)
        group = np.cumsum(head) - 1
        sizes = np.diff(np.append(starts, len(low)))
        shared = (docs[starts] != docs[starts + sizes - 1])[group]
        hot = starts[sizes > limit]
        base = np.int64(rows["bucket"].iloc[0]) << 32
        ids = base | low.astype(np.int64)
        return pd.DataFrame({
            "kind": np.concatenate([np.full(shared.sum(), _KIND_SHARED), np.full(len(hot), _KIND_HOT)]).astype(np.int32),
            "doc_id": np.concatenate([docs[shared], docs[hot]]), "id": np.concatenate([ids[shared], ids[hot]])})

    return meet


def _unpack(batch: pa.RecordBatch) -> dict:
    docs, ids = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.int64) for c in ("docs", "ids"))
    return {"kind": np.full(len(docs), _KIND_SHARED, np.int32), "doc_id": docs, "id": ids}


_SHARED = T.StructType([T.StructField("kind", T.IntegerType()), T.StructField("doc_id", T.LongType()), T.StructField("id", T.LongType())])


# ------------------------------------------------------- 2: previous factors

_PIECES = T.StructType([T.StructField("slot", T.IntegerType()), T.StructField("doc_id", T.LongType()), T.StructField("th", T.LongType()),
                        T.StructField("anchor", T.LongType()), T.StructField("piece", T.BinaryType()), T.StructField("mask", T.LongType())])


def _hash(piece: bytes) -> int:
    import xxhash

    value = xxhash.xxh64_intdigest(piece)
    return value - (1 << 64) if value >> 63 else value


def _lists(column: pa.ListArray) -> tuple[list[int], np.ndarray]:
    """Offsets and values of a list column without nulls."""
    return column.offsets.to_pylist(), column.values.to_numpy(zero_copy_only=False)


def _cut(bits: int, slots: int, hot: frozenset[int]):
    def cut(batch: pa.RecordBatch) -> dict:
        """The pieces with shared anchors; those equal to a piece of a smaller document of the batch are settled at once (slot -1)."""
        texts = _text(batch, "text")
        docs, hashes = (batch.column(c).to_pylist() for c in ("doc_id", "th"))
        at, ids = _lists(batch.column("ids"))
        first: dict[tuple[int, bytes], tuple[int, int, int]] = {}
        settled: set[tuple[int, int, int, bytes]] = set()
        for doc, th, text, begin, end, found in zip(docs, hashes, texts, at[:-1], at[1:], anchored(texts)):
            starts, lasts = pieces(found)
            own = _ids(found[starts], bits)
            for k in np.flatnonzero(np.isin(own, ids[begin:end])).tolist():
                anchor, a, b = int(own[k]), int(starts[k]), int(lasts[k])
                parts = [(_hash(text[i:i + LENGTH]), text[i:i + LENGTH]) for i in range(a, b + 1)] if anchor in hot else [(anchor, text[a:b + LENGTH])]
                for key in parts:
                    before = first.get(key)
                    if before is None or doc < before[0]:
                        first[key] = (doc, th, anchor)
                        if before is not None:
                            settled.add((*before, key[1]))
                    elif doc > before[0]:
                        settled.add((doc, th, anchor, key[1]))
                    elif th != before[1]:  # another text with the same id: neither is earlier, both are looked up
                        first[(key[0], key[1], th)] = (doc, th, anchor)
        sent = [((key[0] * 0x9E3779B1 >> 7) % slots, *own, key[1], 0) for key, own in first.items()]
        sent += [(-1, *own, piece, _all(len(piece) - LENGTH + 1)) for *own, piece in settled]
        return dict(zip(_PIECES.names, zip(*sent))) if sent else {c: [] for c in _PIECES.names}

    return cut


def _judge(rows: pd.DataFrame) -> pd.DataFrame:
    """(doc_id, th, anchor, piece hash, mask): covered positions of the pieces of one slot."""
    result, first = [], {}
    for doc, th, anchor, piece in zip(rows["doc_id"].tolist(), rows["th"].tolist(), rows["anchor"].tolist(), rows["piece"]):
        piece, own = bytes(piece), (doc, th, anchor)
        before = first.get(piece)
        if before is None:
            first[piece] = [own]
        elif doc < before[0][0]:
            result += [(*o, _hash(piece), _all(len(piece) - LENGTH + 1)) for o in before]
            first[piece] = [own]
        elif doc == before[0][0]:
            before.append(own)
        else:
            result.append((*own, _hash(piece), _all(len(piece) - LENGTH + 1)))
    # the first copy of each piece: suffixes of all different pieces in order, where an anchor has several
    several = Counter(owners[0][2] for owners in first.values())
    texts = [piece for piece, owners in first.items() if several[owners[0][2]] > 1]
    docs = np.array([first[t][0][0] for t in texts], np.int64)
    if texts:
        result += [(*o, _hash(piece), mask) for piece, mask in zip(texts, previous_factors(texts, docs)) if mask for o in first[piece]]
    return pd.DataFrame(result, columns=_COVER.names).astype("int64")


def _settled(batch: pa.RecordBatch) -> dict:
    return {c: batch.column(c) for c in ("doc_id", "th", "anchor", "mask")} | {"piece": [_hash(p) for p in batch.column("piece").to_pylist()]}


_COVER = T.StructType([T.StructField(c, T.LongType()) for c in ("doc_id", "th", "anchor", "piece", "mask")])


# -------------------------------------------------------------- 3: removal

_OUT = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("n_bytes", T.LongType()),
    T.StructField("spans", T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())]))),
    T.StructField("kept", T.BinaryType()),
])


def covered(text: bytes, found: np.ndarray, anchor: np.ndarray, masks: dict[int, int], bits: int, hot: frozenset[int] = frozenset()) -> np.ndarray:
    """Which bytes of a text are covered, given the masks of its pieces and their anchors.

    Pieces whose anchor is hot are looked up string by string.
    """
    edge = np.zeros(len(text) + 1, np.int64)
    starts, lasts = pieces(found)
    own = _ids(found[starts], bits)
    for k in np.flatnonzero(np.isin(own, anchor)).tolist():
        a, b = int(starts[k]), int(lasts[k])
        if int(own[k]) in hot:
            mask = sum(1 << i for i in range(b - a + 1) if masks.get(_hash(text[a + i:a + i + LENGTH])))
        else:
            mask = masks.get(_hash(text[a:b + LENGTH]))
        if mask:
            at = a + np.flatnonzero((mask >> np.arange(b - a + 1)) & 1)
            edge[at] += 1
            edge[at + LENGTH] -= 1
    return np.cumsum(edge[:-1]) > 0


def _remover(bits: int, hot: frozenset[int]):
    def remove(batch: pa.RecordBatch) -> dict:
        texts = _text(batch, "text")
        spans, kept = [], []
        cover = batch.column("cover")
        at, known = cover.offsets.to_pylist(), cover.is_valid().to_pylist()
        anchor, piece, mask = (cover.values.field(c).to_numpy(zero_copy_only=False) for c in ("anchor", "piece", "mask"))
        found = anchored([t if k else b"" for t, k in zip(texts, known)])
        for i, (text, copy, own) in enumerate(zip(texts, batch.column("copy").to_pylist(), found)):
            if copy and len(text) >= LENGTH:
                spans.append([{"start": 0, "end": len(text)}])
                kept.append(b"")
            elif known[i]:
                part = slice(at[i], at[i + 1])
                gone = covered(text, own, anchor[part], dict(zip(piece[part].tolist(), mask[part].tolist())), bits, hot)
                change = np.flatnonzero(np.diff(np.concatenate([[False], gone, [False]]).astype(np.int8)))
                spans.append([{"start": a, "end": b} for a, b in change.reshape(-1, 2).tolist()])
                kept.append(np.frombuffer(text, np.uint8)[~gone].tobytes())
            else:
                spans.append([])
                kept.append(text)
        return {"doc_id": batch.column("doc_id"), "n_bytes": [len(t) for t in texts], "spans": spans, "kept": kept}

    return remove


def deduplicate(docs: DataFrame, hot_batches: int = HOT_BATCHES) -> DataFrame:
    """doc_id, n_bytes, spans (removed byte ranges) and kept (remaining bytes), one row per input row.

    Texts are judged as UTF-8 bytes as they came in, never across documents.
    Null texts are empty; texts under LENGTH bytes lose nothing. Rows without
    a doc_id neither lose bytes nor make others lose any. Rows that repeat a
    doc_id are not earlier than each other. Other columns are not read; an
    empty table gives no rows.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"))
    keyed = rows.withColumn("digest", F.unhex(F.sha2(F.col("text").cast("binary"), 256)))
    light = written(keyed.where(F.col("doc_id").isNotNull()).groupBy("doc_id", "digest").agg(F.first(F.octet_length("text")).alias("n")), "lpf-rows")
    firsts = light.groupBy(F.col("digest").alias("g")).agg(F.min("doc_id").alias("first"))
    light = written(light.join(firsts, F.col("digest") == F.col("g")).select("doc_id", "digest", "n", (F.col("doc_id") > F.col("first")).alias("copy")), "lpf-copies")
    total = light.agg(F.sum("n")).first()[0] or 0
    bits = max(math.ceil(math.log2(LEAST_BUCKETS)), math.ceil(math.log2(max(1, total / BUCKET_BYTES))))

    sent = written(map_batches(rows.where(F.col("doc_id").isNotNull() & (F.octet_length("text") >= LENGTH)), _send(bits), _SENT), "lpf-anchors")
    n_sent = sent.where(F.col("kind") == _KIND_SEND).agg(F.sum(F.octet_length("ids"))).first()[0] or 0
    limit = max(hot_batches, int(HOT_SHARE * n_sent / 4))  # so there are 1 / HOT_SHARE hot anchors at most
    met = sent.where(F.col("kind") == _KIND_SEND).groupBy("bucket").applyInPandas(_meet(limit), _SHARED)
    met = written(met.unionAll(map_batches(sent.where(F.col("kind") == _KIND_SHARED).select("docs", "ids"), _unpack, _SHARED)), "lpf-shared")
    release(sent)  # each table goes as soon as the next one is written
    hot = frozenset(r["id"] for r in met.where(F.col("kind") == _KIND_HOT).select("id").distinct().collect())
    wanted = met.where(F.col("kind") == _KIND_SHARED).groupBy(F.col("doc_id").alias("d")).agg(F.collect_set("id").alias("ids"))
    wanted = light.where(~F.col("copy")).join(wanted, F.col("doc_id") == F.col("d")).select("d", F.col("digest").alias("g"), F.xxhash64("digest").alias("th"), "ids")

    looked = keyed.join(wanted, (F.col("doc_id") == F.col("d")) & (F.col("digest") == F.col("g"))).select("doc_id", "th", "text", "ids")
    slots = SLOTS << bits
    cut = written(map_batches(looked, _cut(bits, slots, hot), _PIECES), "lpf-pieces")
    release(met)
    judged = cut.where(F.col("slot") >= 0).groupBy("slot").applyInPandas(_judge, _COVER)
    judged = judged.unionAll(map_batches(cut.where(F.col("slot") < 0).select("doc_id", "th", "anchor", "piece", "mask"), _settled, _COVER))
    judged = written(judged, "lpf-cover")
    release(cut)
    cover = judged.groupBy(F.col("doc_id").alias("d"), "th").agg(F.collect_list(F.struct("anchor", "piece", "mask")).alias("cover"))
    info = light.withColumn("h", F.xxhash64("digest")).join(cover, (F.col("doc_id") == F.col("d")) & (F.col("h") == F.col("th")) & ~F.col("copy"), "left")
    info = written(info.where(F.col("copy") | F.col("cover").isNotNull()).select(F.col("doc_id").alias("d"), F.col("digest").alias("g"), "copy", "cover"), "lpf-info")
    release(judged)
    release(light)
    full = keyed.join(info, (F.col("doc_id") == F.col("d")) & (F.col("digest") == F.col("g")), "left").select("doc_id", "text", "copy", "cover")
    return map_batches(full, _remover(bits, hot), _OUT)


def op9_query(docs: DataFrame) -> DataFrame:
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    return deduplicate(docs).select("doc_id", "n_bytes", removed.alias("n_removed"), F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))
