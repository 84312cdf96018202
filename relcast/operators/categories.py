"""Frequency-guided spelling correction of a category column.

A rare word ``b`` is corrected to a more frequent word ``a`` when they have
the same phonetic key and an unrestricted Damerau-Levenshtein distance below 3.

Candidate pairs are found without comparing all pairs of a block. Take two
words within two edits and drop the edited characters (one per edit and side):
what is left is the same on both sides, with at most two characters dropped on
either. So every word is indexed by its phonetic key and every string that
dropping up to two of its characters leaves. The whole word counts, not its
start alone: words that share a long prefix (or suffix) do not meet unless they
are near each other.

The index has a row per pair of characters, so words longer than WHOLE are
indexed by both ends instead: END characters from either side, with up to two
characters dropped in all. (An edit inside an end costs one dropped character
on each side; an edit outside leaves it as it is.) That is a bounded number of
rows whatever the length. Lengths of a pair differ by two at most, so words of the
two lengths around the limit are in both indexes, and any pair is in one.

Both take hundreds of rows a word. In a large block (words with one phonetic
key) a short window is enough if the words differ there: the first or the last
WINDOW characters, with up to two dropped, are complete for words of any length,
as a pair's windows leave the same text whatever happens outside them. What a
window would cost, its rows and the pairs that meet, is measured over all words
of the block beforehand; where it is more than the rows of the whole words (a
shared ending, say), the block is indexed as above.

The index holds hashes and numbers, no words. The pairs that meet are made
distinct first; only then are the words joined back and tested, a bounded plain
distance before the exact one.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from relcast.functions.common import as_col
from relcast.functions.text import phonetic_key, within_edits2
from relcast.session import materialise, release

#: Words up to this length are indexed whole (1,276 rows at most).
WHOLE = 50
#: Characters of either end by which longer words are indexed.
END = 24
#: Characters of the one end by which the words of a large block may be indexed instead (56 rows at most).
WINDOW = 10
#: Blocks of so many words are measured; smaller ones cost little either way.
BLOCK = 64
#: Signed sums from which a block's meeting rows are estimated (within some 5%).
CELLS = 1024
#: Rows of the index in a task; in a small index so many, as far as there are cores.
TASK_ROWS, SMALL_ROWS = 1_000_000, 50_000


def _dropped(w: Column, n: Column, k: int) -> Column:
    """The strings that dropping exactly ``k`` (0 to 2) characters of ``w`` (``n`` long) leaves."""
    none = F.array().cast("array<string>")
    if k == 0:
        return F.array(w)
    without = lambda i: F.concat(F.substring(w, F.lit(1), i - 1), F.substring(w, i + 1, n))
    if k == 1:
        return F.when(n < 1, none).otherwise(F.transform(F.sequence(F.lit(1), n), without))
    # characters i and j, i < j
    pair = lambda i, j: F.concat(F.substring(w, F.lit(1), i - 1), F.substring(w, i + 1, j - i - 1), F.substring(w, j + 1, n))
    return F.when(n < 2, none).otherwise(F.flatten(F.transform(
        F.sequence(F.lit(1), n - 1), lambda i: F.transform(F.sequence(i + 1, n), lambda j: pair(i, j)))))


def deletion_variants(c) -> Column:
    """The word and every string made from it by deleting one or two characters."""
    w = as_col(c)
    n = F.length(w)
    return F.array_distinct(F.concat(*[_dropped(w, n, k) for k in range(3)]))


def end_variants(c, end: int = END) -> Column:
    """Both ends of a word, ``end`` characters each, with up to two characters dropped in all."""
    w = as_col(c)
    head, tail, n = F.substring(w, 1, end), F.substring(w, -end, end), F.least(F.length(w), F.lit(end))

    def pairs(left: Column, right: Column) -> Column:
        return F.flatten(F.transform(left, lambda x: F.transform(right, lambda y: F.concat(x, F.lit("\u0000"), y))))

    return F.array_distinct(F.concat(*[pairs(_dropped(head, n, i), _dropped(tail, n, j)) for i in range(3) for j in range(3 - i)]))


def index_rows(length: Column, whole: int = WHOLE, end: int = END) -> Column:
    """Rows that a word of this length has in the indexes of whole words and of both ends (repeats included)."""
    one = length * (length - 1) / 2 + length + 1
    both = end * (2 * end - 1) + 2 * end + 1  # one or two of 2 * end characters
    return F.when(length <= whole, one).otherwise(0) + F.when(length >= whole - 1, both).otherwise(0)


def _window(side: Column, w: Column, window: int) -> Column:
    return F.when(side == "head", F.substring(w, 1, window)).otherwise(F.substring(w, -window, window))


def _meeting(rows: DataFrame) -> DataFrame:
    """(pkey, side, met): of rows (pkey, side, key), the sum of squares of the keys' counts, estimated.

    Every row counts, with a sign by its key, into one of CELLS sums; the sums'
    squares have that expectation. What is shuffled is sums, whatever a key's rows.
    """
    sign = F.when(F.col("key") < 0, F.lit(-1)).otherwise(F.lit(1))
    sums = rows.groupBy("pkey", "side", F.pmod(F.col("key"), F.lit(CELLS)).alias("cell")).agg(F.sum(sign).alias("s"))
    return sums.groupBy("pkey", "side").agg(F.sum(F.pow("s", F.lit(2))).alias("met"))


def window_blocks(keyed: DataFrame, whole: int = WHOLE, end: int = END, window: int = WINDOW, block: int = BLOCK) -> DataFrame:
    """(pkey, side): the blocks of ``keyed`` (word, pkey) that are indexed by one end, and by which.

    A block counts ``block`` words (distinct) at least. There are as many as
    Soundex has codes at most, as input that is its own key is alone in its block.
    """
    length = F.length("word")
    blocks = keyed.groupBy("pkey").agg(F.count(F.lit(1)).alias("words"), F.sum(index_rows(length, whole, end)).alias("rows")).where(F.col("words") >= block)
    blocks = materialise(blocks.select("pkey", "rows"), "blocks")
    words = keyed.join(F.broadcast(blocks.select("pkey")), "pkey")
    # the end with fewer equal texts, of the characters that a window has left when two are dropped
    ends = words.select("pkey", F.explode(F.array(F.lit("head"), F.lit("tail"))).alias("side"), "word")
    ends = ends.select("pkey", "side", F.xxhash64(_window(F.col("side"), F.col("word"), window - 2)).alias("key"))
    better = _meeting(ends).groupBy("pkey").agg(F.min(F.struct("met", "side")).alias("least")).select("pkey", F.col("least.side").alias("side"))
    better = materialise(better, "ends")
    texts = words.join(F.broadcast(better), "pkey").select("pkey", "side", _window(F.col("side"), F.col("word"), window).alias("text"))
    texts = texts.repartition(3 * keyed.sparkSession.sparkContext.defaultParallelism)  # the vocabulary's files are few
    variants = texts.select("pkey", "side", F.explode(deletion_variants("text")).alias("variant"))
    cost = _meeting(variants.select("pkey", "side", F.xxhash64("variant").alias("key")))
    found = materialise(cost.join(blocks, "pkey").where(F.col("met") < F.col("rows")).select("pkey", "side"), "window_blocks")
    release(blocks)
    release(better)
    return found


def vocab(df: DataFrame, word: str, key: str) -> DataFrame:
    """Per word the number of non-null keys; the null word is dropped."""
    return df.where(F.col(word).isNotNull()).groupBy(F.col(word).alias("word")).agg(F.count(key).alias("n"))


def typo_candidates(words: DataFrame, whole: int = WHOLE, end: int = END, window: int = WINDOW, block: int = BLOCK) -> DataFrame:
    """Pairs (a, b) with same phonetic key, distance < 3 and n_a > n_b.

    ``whole`` is the length up to which words are indexed whole (at least
    2 * ``end`` + 2, so that the ends of longer words do not overlap); ``window``
    and ``block`` as in :func:`window_blocks`. The joins of the index are
    sort-merge joins: ``explode`` does not raise the planner's size estimate, so
    it would broadcast an index far larger than it believes.
    """
    if whole < 2 * end + 2:
        raise ValueError("the ends of words that are not indexed whole must not overlap")
    if window < 3:
        raise ValueError("a window must keep a character when two are dropped")
    # The vocabulary feeds every step: written once, so the aggregation is not repeated and its numbers stay.
    keyed = materialise(words.select("word", "n", phonetic_key("word").alias("pkey")).withColumn("id", F.monotonically_increasing_id()), "vocabulary")
    found = window_blocks(keyed, whole, end, window, block)
    sided, windows = keyed.withColumn("side", F.lit(None).cast("string")), not found.isEmpty()
    if windows:
        sided = materialise(keyed.join(F.broadcast(found), "pkey", "left").select(*keyed.columns, "side"), "vocabulary")
        release(keyed)
        keyed = sided
    release(found)
    length, by_window = F.length("word"), F.col("side").isNotNull()
    rows = sided.agg(F.sum(F.when(by_window, window * (window + 1) // 2 + 1).otherwise(index_rows(length, whole, end)))).first()[0] or 0
    # Tasks of bounded size on both sides of the shuffle, so that neither spills however few partitions the session has.
    spark = words.sparkSession
    tasks = math.ceil(rows / TASK_ROWS)
    sided = sided.repartition(max(tasks, min(math.ceil(rows / SMALL_ROWS), spark.sparkContext.defaultParallelism), 1), "id")
    row = ["id", "n", length.cast("int").alias("len"), "pkey"]
    short = sided.where(~by_window & (length <= whole)).select(*row, F.explode(deletion_variants("word")).alias("variant"), F.lit(0).alias("kind"))
    long = sided.where(~by_window & (length >= whole - 1)).select(*row, F.explode(end_variants("word", end)).alias("variant"), F.lit(1).alias("kind"))
    if windows:
        near = sided.where(by_window).withColumn("text", _window(F.col("side"), F.col("word"), window))
        short = short.unionAll(near.select(*row, F.explode(deletion_variants("text")).alias("variant"), F.lit(2).alias("kind")))

    def keys(index: DataFrame) -> DataFrame:
        return index.select("id", "n", "len", F.xxhash64("kind", "pkey", "variant").alias("key"))

    def meet(index: DataFrame) -> DataFrame:
        a, b = index.alias("a"), index.alias("b").hint("merge")
        same = (F.col("a.key") == F.col("b.key")) & (F.col("a.n") > F.col("b.n")) & (F.abs(F.col("a.len") - F.col("b.len")) <= 2)
        return a.join(b, same).select(F.col("a.id").alias("ia"), F.col("b.id").alias("ib"))

    # Where the session's partitions would do, the planner deals the rows out. Long words that share both ends
    # meet in one bucket: their join is always left to it, as it splits skewed partitions.
    index = keys(short)
    index = index.repartition(tasks, "key") if tasks > int(spark.conf.get("spark.sql.shuffle.partitions")) else index
    met = meet(index).unionAll(meet(keys(long))).distinct()
    side = lambda s: keyed.select(F.col("id").alias(f"id_{s}"), F.col("word").alias(s), F.col("n").alias(f"n_{s}"), F.col("pkey").alias(f"pkey_{s}"))
    pairs = met.join(side("a").hint("merge"), F.col("ia") == F.col("id_a")).join(side("b").hint("merge"), F.col("ib") == F.col("id_b"))
    near = (F.levenshtein("a", "b", 4) >= 0) & within_edits2("a", "b")
    return pairs.where(F.col("pkey_a").eqNullSafe(F.col("pkey_b"))).where(near).select("a", "b", "n_a", "n_b")


def best_correction(cands: DataFrame) -> DataFrame:
    """Per rare word the most frequent candidate; ties to the smallest word."""
    best = cands.groupBy("b").agg(F.min(F.struct((-F.col("n_a")).alias("neg"), F.col("a"))).alias("m"))
    return best.select("b", F.col("m.a").alias("a"))


def resolve_chains(best: DataFrame) -> DataFrame:
    """Follow b → a → … to the root by pointer jumping (O(log depth) rounds).

    Ends because counts strictly rise along a chain, so there are no cycles.
    Each round is written to the shared scratch folder, and the one before is removed.
    """
    m = materialise(best.select("b", "a"), "chains")
    while True:
        nxt = m.select(F.col("b").alias("_b"), F.col("a").alias("_a"))
        step = materialise(m.join(nxt, m["a"] == nxt["_b"], "left").select(
            "b", F.coalesce("_a", "a").alias("a"), F.col("_a").isNotNull().alias("_moved")), "chains")
        moved = not step.where("_moved").isEmpty()
        release(m)
        m = step
        if not moved:
            return m.select("b", "a")


def corrections(df: DataFrame, word: str, key: str) -> DataFrame:
    """G2 → J2 → G8 → I1: map of word → corrected root word."""
    return resolve_chains(best_correction(typo_candidates(vocab(df, word, key))))


def apply_corrections(df: DataFrame, word: str, mapping: DataFrame) -> DataFrame:
    """Replace mapped words; unmapped stay, null stays null. How to join is
    left to the planner, which knows the written mapping's size."""
    m = mapping.select(F.col("b").alias("_from"), F.col("a").alias("_to"))
    out = df.join(m, F.col(word) == F.col("_from"), "left")
    return out.withColumn(word, F.coalesce("_to", word)).drop("_from", "_to").select(*df.columns)
