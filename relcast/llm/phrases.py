"""Phrase collocations by SON partitioning.

The texts are dealt to a fixed number of shards. Each shard is mined completely,
level by level, at a support lowered to its share of the language's words: a
phrase that reaches the support in the whole corpus reaches the lowered one in
some shard. The union of the phrases frequent in a shard are the candidates,
and these are then counted exactly over the whole corpus.

A shard is a share of the corpus, not a task: its local counts are one Spark
aggregation by shard, so neither its size nor its number grows out of hand, and
the lowered support stays well above one. Pairs are counted only where both
words are candidates, longer phrases where all pairs inside them are. Mining
works on hashes, of the language and the words; bitmaps of fixed size tell tasks
what is a candidate. Both can only let too much through, and the last count is
on the words themselves.

Texts are tokenised and hashed as whole arrays of bytes, a slice at a time, so
every pass over them costs little more than reading them.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from relcast.llm.common import bound_batches, written
from relcast.llm.minhash import mix64, worker_cache
from relcast.session import release

SUPPORT = 100
LONGEST = 5
TOP = 2000
#: Shards; the support of one is about SUPPORT / SHARDS.
SHARDS = 8
#: The candidate bitmap of a level has 2 ** BITMAP_BITS bits (8 MiB), whatever the corpus.
BITMAP_BITS = 26

#: Bytes of text that are worked on at once, cut between pieces.
SLICE = 1 << 20
#: Phrases that a task counts up before it passes them on.
BUFFER = 1 << 20

# What ends a piece, and what separates words in it. A-Z are lower-cased.
_PIECE_ENDS, _SPACES = b".,;:!?\n\x0b\x0c\r", b" \t"
_MARK, _SPACE = 10, 32
_MAPPED = np.array([_MARK if b in _PIECE_ENDS else _SPACE if b in _SPACES else b + 32 if 65 <= b <= 90 else b for b in range(256)], np.uint8)


def bytes_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The mapped bytes of all texts of an Arrow column, one behind the other, and where each starts (and the last ends)."""
    if texts.null_count:
        texts = texts.fill_null("")
    width = np.int64 if pa.types.is_large_string(texts.type) else np.int32
    _, offsets, data = texts.buffers()
    bounds = np.frombuffer(offsets, width)[texts.offset:texts.offset + len(texts) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8)[bounds[0]:bounds[-1]] if data is not None else np.empty(0, np.uint8)
    return _MAPPED[raw], bounds - bounds[0]


def slices(data: np.ndarray, bounds: np.ndarray, size: int = 0) -> Iterator[tuple[int, int]]:
    """Ranges of about ``size`` bytes that end where a text or a piece ends; longer only where a piece is."""
    size, at, end = size or SLICE, int(bounds[0]), int(bounds[-1])
    while at < end:
        stop = min(at + size, end)
        if stop < end:
            k = int(np.searchsorted(bounds, stop, "right")) - 1
            cut = int(bounds[k])
            if cut <= at:  # inside one text: behind its last mark, or else its next
                marks = np.flatnonzero(data[at:stop] == _MARK)
                if len(marks):
                    cut = at + int(marks[-1]) + 1
                else:
                    marks = np.flatnonzero(data[stop:bounds[k + 1]] == _MARK)
                    cut = stop + int(marks[0]) + 1 if len(marks) else int(bounds[k + 1])
            stop = cut
        yield at, stop
        at = stop


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd number and of its inverse, modulo 2 ** 64."""
    cache = worker_cache()
    if len(cache.get("phrase powers", ((),))[0]) < n:
        base = 0x9E3779B97F4A7C15
        both = []
        for number in (base, pow(base, -1, 1 << 64)):
            out = np.full(max(n, SLICE), number, np.uint64)
            out[0] = 1
            both.append(np.multiply.accumulate(out))
        cache["phrase powers"] = tuple(both)
    return cache["phrase powers"]


class Words:
    """The words of a slice: ``start``, ``end``, ``text`` (number of their text), ``piece`` (equal within a piece) and 64-bit ``hash`` (salted by their text's ``salts``)."""

    def __init__(self, data: np.ndarray, bounds: np.ndarray, at: int, stop: int, salts: np.ndarray | None = None):
        self.data = part = data[at:stop]
        solid = (part != _SPACE) & (part != _MARK)
        first = np.zeros(len(part) + 1, bool)
        inside = bounds[(bounds >= at) & (bounds < stop)] - at
        first[inside] = True  # a text's first byte never goes on with a word of the text before
        before = np.concatenate([[False], solid[:-1]])
        after = np.concatenate([solid[1:], [False]])
        self.start = np.flatnonzero(solid & (~before | first[:-1]))
        self.end = np.flatnonzero(solid & (~after | first[1:])) + 1
        self.text = np.searchsorted(bounds, self.start + at, "right") - 1
        self.piece = np.cumsum(part == _MARK, dtype=np.int32)[self.start] + self.text
        power, inverse = _powers(len(part))
        sums = np.zeros(len(part) + 1, np.uint64)
        np.cumsum((part.astype(np.uint64) + np.uint64(1)) * power[:len(part)], out=sums[1:])
        hashes = (sums[self.end] - sums[self.start]) * inverse[self.start]
        self.hash = mix64(hashes if salts is None else hashes ^ salts[self.text])

    def __len__(self) -> int:
        return len(self.start)

    def word(self, i: int) -> bytes:
        return self.data[self.start[i]:self.end[i]].tobytes()

    def numbers(self) -> np.ndarray:
        """Numbers that are equal for equal words only: equal hashes are compared byte by byte."""
        _, first, same = np.unique(self.hash, return_index=True, return_inverse=True)
        head, length = first[same], self.end - self.start
        equal = bool((length == length[head]).all())
        if equal:
            step = np.arange(int(length.sum())) - np.repeat(np.cumsum(length) - length, length)
            equal = bool((self.data[np.repeat(self.start, length) + step] == self.data[np.repeat(self.start[head], length) + step]).all())
        if equal:
            return same.astype(np.int64)
        known: dict[bytes, int] = {}
        return np.array([known.setdefault(self.word(i), len(known)) for i in range(len(self))], np.int64)


def levels(words: Words, longest: int, bitmaps: list[np.ndarray]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(k, places, hashes) of the phrases of k words whose parts of k - 1 words are all in the bitmaps, for k up to ``longest``.

    A level whose bitmap is None lets all of its phrases through.
    """
    at = np.arange(len(words))
    key = words.hash
    k = 1
    while True:
        yield k, at, key[at]
        if k == longest or k > len(bitmaps) or not len(at):
            return
        alive = np.zeros(len(words) + 1, bool)
        alive[at] = True if bitmaps[k - 1] is None else in_bitmap(bitmaps[k - 1], key[at])
        at = at[alive[at] & alive[at + 1]]
        at = at[words.piece[at] == words.piece[at + 1]]
        longer = np.zeros(len(words), np.uint64)
        longer[at] = mix64(key[at] * np.uint64(3) + words.hash[at + k])
        key, k = longer, k + 1


def bitmap(keys: DataFrame) -> np.ndarray:
    """The first BITMAP_BITS bits of the hashes in the column ``key``, as set bits; its size does not depend on the rows."""
    at = F.shiftright("key", HASH_BITS + SHARD_BITS - BITMAP_BITS)
    cells = keys.select(at.alias("at")).select(F.shiftright("at", 6).alias("cell"), F.expr("shiftleft(1L, cast(at & 63 as int))").alias("bit"))
    cells = cells.groupBy("cell").agg(F.bit_or("bit").alias("bits"))
    got = cells.toArrow()
    out = np.zeros(1 << (BITMAP_BITS - 6), np.int64)
    out[got.column(0).to_numpy()] = got.column(1).to_numpy()
    return out.view(np.uint64)


def in_bitmap(bits: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    at = hashes >> np.uint64(64 - BITMAP_BITS)
    return (bits[(at >> np.uint64(6)).astype(np.int64)] >> (at & np.uint64(63))) & np.uint64(1) == 1


def _texts(docs: DataFrame, shards: int) -> DataFrame:
    lang = F.coalesce(F.col("lang").cast("string"), F.lit("und"))
    return docs.select(lang.alias("lang"), F.xxhash64(lang).alias("salt"), F.pmod(F.xxhash64("text"), F.lit(shards)).alias("shard"), F.col("text").cast("string").alias("text"))


def _slices_of(texts: pa.Array, salts: pa.Array) -> Iterator[Words]:
    data, bounds = bytes_of(texts)
    salts = salts.to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)
    for at, stop in slices(data, bounds):
        yield Words(data, bounds, at, stop, salts)


#: Bits of a phrase's hash that are shuffled, and of the shard behind them: a key takes five bytes.
HASH_BITS, SHARD_BITS = 36, 4
MOST_SHARDS = 1 << SHARD_BITS
#: Within a task the number of a group of texts stands behind the hash.
_LOW = np.uint64(255)
_COUNTED = T.StructType([T.StructField("key", T.LongType()), T.StructField("tag", T.LongType()), T.StructField("n", T.LongType())])


def _few_groups(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, list[tuple]]]:
    """Batches with the group (salt, shard, tag) of every row, cut where they have more than the low bits can tell apart."""
    for batch in batches:
        rows = list(zip(*(batch.column(i).to_pylist() for i in range(3))))
        at, seen = 0, set()
        for i, p in enumerate(rows):
            if p not in seen and len(seen) > _LOW:
                yield batch.slice(at, i - at), rows[at:i]
                at, seen = i, set()
            seen.add(p)
        yield batch.slice(at), rows[at:]


def _local_counts(texts: DataFrame, sizes: tuple[int, ...], shared: list) -> DataFrame:
    """(key, tag, n): counts of the phrases of ``sizes`` words of ``texts`` (salt, shard, tag, text), added up within a buffer.

    ``key`` is made of the first bits of the hash of a language's phrase, and the shard.
    """
    schema = pa.schema([("key", pa.int64()), ("tag", pa.int64()), ("n", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bitmaps = [b.value for b in shared]
        bitmaps += [None] * (max(sizes) - 1 - len(bitmaps))  # beyond pairs nothing is known yet
        groups: dict[tuple, int] = {}
        held: list[np.ndarray] = []
        size = 0

        def flush() -> pa.RecordBatch:
            packed, n = np.unique(np.concatenate(held), return_counts=True)
            which = (packed & _LOW).astype(np.int64)
            shards, tags = np.array([g[1] for g in groups], np.uint64)[which], np.array([g[2] for g in groups], np.int64)[which]
            keys = (packed >> np.uint64(8) << np.uint64(SHARD_BITS)) | shards
            return pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), pa.array(tags), pa.array(n)], schema=schema)

        for batch, rows in _few_groups(batches):
            if len(groups | dict.fromkeys(rows)) > _LOW:
                if held:
                    yield flush()
                groups, held, size = {}, [], 0
            codes = np.array([groups.setdefault(p, len(groups)) for p in rows], np.uint64)
            for words in _slices_of(batch.column(3), batch.column(0)):
                for k, at, keys in levels(words, max(sizes), bitmaps):
                    if k in sizes and len(at):
                        held.append((keys >> np.uint64(64 - HASH_BITS) << np.uint64(8)) | codes[words.text[at]])
                        size += len(at)
                if size >= BUFFER:
                    yield flush()
                    held, size = [], 0
        if held:
            yield flush()

    found = texts.select("salt", "shard", "tag", "text").mapInArrow(run, _COUNTED)
    return found.groupBy("key").agg(F.max("tag").alias("tag"), F.sum("n").alias("n"))


_PHRASE = T.StructType([T.StructField("lang", T.StringType()), T.StructField("phrase", T.BinaryType()), T.StructField("m", T.IntegerType()), T.StructField("n", T.LongType())])


def _exact_counts(texts: DataFrame, longest: int, shared: list) -> DataFrame:
    """(lang, phrase, m, n): counts of the candidates of all levels, slice by slice, told apart by their words; with m = 0 of all words."""
    schema = pa.schema([("lang", pa.string()), ("phrase", pa.binary()), ("m", pa.int32()), ("n", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bitmaps = [b.value for b in shared]
        for batch in batches:
            names: dict[str, int] = {}
            codes = np.array([names.setdefault(x, len(names)) for x in batch.column(0).to_pylist()], np.int64)
            langs = pa.array(list(names), pa.string())
            for words in _slices_of(batch.column(2), batch.column(1)):
                lang, ids, label = codes[words.text], words.numbers(), None
                text, start, end = words.data.tobytes(), words.start.tolist(), words.end.tolist()
                total = np.bincount(lang, minlength=len(names))
                yield pa.RecordBatch.from_arrays([langs, pa.array([b""] * len(names), pa.binary()), pa.array(np.zeros(len(names), np.int32)), pa.array(total.astype(np.int64))], schema=schema)
                for k, at, keys in levels(words, longest, bitmaps):
                    if k > len(bitmaps):
                        break
                    at = at[in_bitmap(bitmaps[k - 1], keys)]  # longer phrases start among these
                    if not len(at):
                        break
                    # equal labels are equal words: that of the first k - 1 words (of the language alone) and the last word make a new one
                    pairs = ((lang[at] if label is None else label[at]) << 32) | ids[at + k - 1]
                    _, first, same, n = np.unique(pairs, return_index=True, return_inverse=True, return_counts=True)
                    label = np.full(len(words), -1, np.int64)
                    label[at] = same
                    phrases = [b" ".join([text[start[j]:end[j]] for j in range(i, i + k)]) for i in at[first].tolist()]
                    column = pa.DictionaryArray.from_arrays(pa.array(lang[at[first]].astype(np.int32)), langs).cast(pa.string())
                    yield pa.RecordBatch.from_arrays([column, pa.array(phrases, pa.binary()), pa.array(np.full(len(n), k, np.int32)), pa.array(n)], schema=schema)

    return texts.select("lang", "salt", "text").mapInArrow(run, _PHRASE)


def frequent(docs: DataFrame, support: int = SUPPORT, longest: int = LONGEST, shards: int = SHARDS) -> tuple[DataFrame, DataFrame]:
    """(lang, phrase, m, n) of all phrases of 1 to ``longest`` words that occur ``support`` times, exactly counted, and (lang, n) of all words.

    Occurrences are contiguous, within pieces, and may overlap.
    """
    if not 1 <= shards <= MOST_SHARDS:
        raise ValueError(f"1 to {MOST_SHARDS} shards")
    spark = docs.sparkSession
    bound_batches(spark)
    texts = _texts(docs, shards)
    shard = F.col("key").bitwiseAND(F.lit(MOST_SHARDS - 1))
    words = written(_local_counts(texts.withColumn("tag", F.col("salt")), (1,), []), "phrase-words")
    # the support of a shard: the least whole number that is not below support * words / all words of the language
    sums = words.groupBy(F.col("tag").alias("s"), shard.alias("h")).agg(F.sum("n").alias("words"))
    least = F.expr(f"({support}L * words + total - 1) div total").alias("least")
    local = written(sums.withColumn("total", F.sum("words").over(Window.partitionBy("s"))).select("s", "h", least), "phrase-supports")
    mine = lambda a, b: (a == F.col("s")) & (b == F.col("h"))
    shared: list = []
    kept = words.join(local, mine(F.col("tag"), shard)).where(F.col("n") >= F.col("least"))
    supported = texts.join(local, mine(F.col("salt"), F.col("shard"))).withColumn("tag", F.col("least"))
    for sizes in ((1,), (2,), tuple(range(3, longest + 1))):
        if not sizes or sizes[0] > longest:
            break
        if sizes[0] > 1:
            kept = _local_counts(supported, sizes, shared).where(F.col("n") >= F.col("tag"))
        bits = bitmap(kept)
        if not bits.any():
            break
        shared += [spark.sparkContext.broadcast(bits)] * (1 if sizes[0] < 3 else len(sizes))  # one bitmap for all longer phrases
    release(words)
    counted = _exact_counts(texts, longest, shared).groupBy("lang", "phrase", "m").agg(F.sum("n").alias("n")).where((F.col("n") >= support) | (F.col("m") == 0))
    counted = written(counted.withColumn("phrase", F.col("phrase").cast("string")), "phrase-counts")
    for s in set(shared):
        s.destroy()
    # written apart, so that the planner knows how few languages there are
    return counted.where("m > 0"), written(counted.where("m = 0").select("lang", "n"), "phrase-totals")


def collocations(docs: DataFrame, support: int = SUPPORT, longest: int = LONGEST, top: int = TOP, shards: int = SHARDS) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: the best phrases of every language.

    A phrase of 2 to ``longest`` words with a >= support occurrences is scored
    by its weakest cut, floor(1000 * a * n / (l * r)); ties go to the shortest
    first part. Phrases that never occur outside a longer frequent one are
    dropped. Null texts have no words, a null language is ``und``; repeated
    rows count again; columns other than lang and text are not read. An empty
    table gives no rows.
    """
    counted, totals = frequent(docs, support, longest, shards)
    phrases = counted.where("m > 1").select("lang", "phrase", "m", F.col("n").alias("a"), F.split("phrase", " ").alias("w"))
    joined = lambda start, length: F.array_join(F.slice("w", start, length), " ")
    # inside a longer phrase that occurs as often
    inner = phrases.where("m > 2").select("lang", "a", "w", "m", F.explode(F.sequence(F.lit(2), F.col("m") - 1)).alias("k"))
    inner = inner.select("lang", "a", "w", "k", F.explode(F.sequence(F.lit(1), F.col("m") - F.col("k") + 1)).alias("i"))
    longer = inner.groupBy(F.col("lang").alias("il"), joined(F.col("i"), F.col("k")).alias("ip")).agg(F.max("a").alias("ia"))
    left = phrases.join(longer, (F.col("lang") == F.col("il")) & (F.col("phrase") == F.col("ip")) & (F.col("ia") >= F.col("a")), "left_anti")
    cuts = left.select("lang", "phrase", "a", "w", "m", F.explode(F.sequence(F.lit(1), F.col("m") - 1)).alias("k"))
    cuts = cuts.select("lang", "phrase", "a", "k", joined(F.lit(1), F.col("k")).alias("head"), joined(F.col("k") + 1, F.col("m") - F.col("k")).alias("tail"))
    part = lambda name, n: counted.select(F.col("lang").alias(f"{n}l"), F.col("phrase").alias(f"{n}p"), F.col("n").alias(n))
    cuts = cuts.join(part("head", "l"), (F.col("lang") == F.col("ll")) & (F.col("head") == F.col("lp"))).drop("ll", "lp", "head")
    cuts = cuts.join(part("tail", "r"), (F.col("lang") == F.col("rl")) & (F.col("tail") == F.col("rp"))).drop("rl", "rp", "tail")
    cuts = cuts.join(totals.select(F.col("lang").alias("tl"), "n"), F.col("lang") == F.col("tl")).drop("tl")
    # decimals of 38 digits hold the products of counts below 10^17 exactly
    score = F.expr("cast((cast(1000 as decimal(4,0)) * cast(a as decimal(17,0)) * cast(n as decimal(17,0))) div (cast(l as decimal(19,0)) * cast(r as decimal(19,0))) as bigint)")
    best = cuts.withColumn("score", score).groupBy("lang", "phrase", "a", "n").agg(F.min(F.struct("score", "k", "l", "r")).alias("c"))
    best = best.select("lang", "phrase", "a", F.col("c.l").alias("l"), F.col("c.r").alias("r"), "n", F.col("c.score").alias("score"))
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), F.asc("phrase")))
    return best.withColumn("rank", rank).where(F.col("rank") <= top).select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")


def op13_query(docs: DataFrame) -> DataFrame:
    return collocations(docs)
