"""Quality rules by compression bands.

zstandard compresses a whole document and each of its fixed chunks. Text whose
ratio (compressed to plain bytes) is under the lower limit repeats itself; over
the upper limit it is noise. Limits depend on the length, since short inputs
compress less.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from relcast.llm.common import map_batches

MIN_WORDS = 50
SYMBOLS = "#*$%&|<>"
SPACES = " \t\n\x0b\x0c\r"


@dataclass(frozen=True)
class Band:
    """Limits of the ratio for inputs of at least ``bytes`` bytes (up to the next band)."""

    bytes: int
    low: float
    high: float


@dataclass(frozen=True)
class Bands:
    """``bands`` by rising size (smaller inputs are not judged). A document is
    rejected if its own ratio, or more than ``share`` of the bytes in its
    chunks, lie outside. Only whole chunks count; a short last chunk has its
    own band."""

    bands: tuple[Band, ...] = (
        Band(256, 0.575, 0.78), Band(362, 0.530, 0.76), Band(512, 0.520, 0.73), Band(724, 0.498, 0.68), Band(1024, 0.480, 0.63),
        Band(1448, 0.458, 0.60), Band(2048, 0.450, 0.57), Band(2896, 0.442, 0.55), Band(4096, 0.430, 0.53), Band(5793, 0.420, 0.52),
        Band(8192, 0.412, 0.50), Band(11585, 0.405, 0.49), Band(16384, 0.398, 0.48), Band(23170, 0.390, 0.48), Band(32768, 0.375, 0.48),
        Band(65536, 0.350, 0.48),
    )
    chunk: int = 4096
    share: float = 0.5
    level: int = 3

    def outside(self, size: int, ratio: float) -> int:
        """-1 too repetitive, 1 incompressible, 0 within its band or too short to judge."""
        limits = None
        for band in self.bands:
            if size < band.bytes:
                break
            limits = band
        if limits is None:
            return 0
        return -1 if ratio < limits.low else 1 if ratio > limits.high else 0


#: The production limits. They are what :func:`fitted` finds on the 3,979 labelled
#: rows of a 10,000-document table of prose in four languages of Latin script,
#: made smooth by hand and widened a little. Of its labelled documents they
#: reject none of the 3,243 good ones that pass the base rule, and 194 of the
#: 291 bad ones that do. Text in other scripts has other ratios: fit anew.
BANDS = Bands()

OUT = T.StructType([
    T.StructField("doc_id", T.LongType()),
    T.StructField("n_words", T.LongType()),
    T.StructField("word_chars", T.LongType()),
    T.StructField("n_symbols", T.LongType()),
    T.StructField("n_dup_lines", T.LongType()),
    T.StructField("n_repeat_words", T.LongType()),
    T.StructField("base_failed", T.BooleanType()),
    T.StructField("kept", T.BooleanType()),
    T.StructField("ratio", T.DoubleType()),
    T.StructField("outside_share", T.DoubleType()),
    T.StructField("reason", T.StringType()),
])


def base_counts(text: str | None) -> dict:
    """The plain counts of one text; null has no words."""
    text = text or ""
    raw = text.encode("utf-8", "surrogatepass")
    words = raw.split()  # bytes split at ASCII white space, as the word rule does
    lines = [line for line in raw.split(b"\n") if line.strip()]
    n = len(words)
    repeated = 0
    if n > 3:
        windows = Counter(zip(words, words[1:], words[2:]))
        if len(windows) < n - 2:
            upto = 0  # words before this index are counted
            for i, window in enumerate(zip(words, words[1:], words[2:])):
                if windows[window] > 1:
                    repeated += i + 3 - max(i, upto)
                    upto = i + 3
    return {
        "n_words": n,
        "word_chars": len(text) - sum(text.count(c) for c in SPACES),
        "n_symbols": sum(text.count(c) for c in SYMBOLS),
        "n_dup_lines": len(lines) - len(set(lines)),
        "n_repeat_words": repeated,
        "base_failed": n < MIN_WORDS or 100 * repeated > 50 * n,
    }


def verdict(raw: bytes, bands: Bands, compressor) -> dict:
    """Ratio of the whole text, share of chunk bytes outside their band, and the reason for a rejection."""
    size = len(raw)
    if not size:
        return {"ratio": None, "outside_share": 0.0, "reason": None}
    ratio = len(compressor.compress(raw)) / size
    outside = 0
    if size > bands.chunk:
        for i in range(0, size, bands.chunk):
            part = raw[i:i + bands.chunk]
            if bands.outside(len(part), len(compressor.compress(part)) / len(part)):
                outside += len(part)
    whole = bands.outside(size, ratio)
    share = outside / size
    reason = "repetitive" if whole < 0 else "incompressible" if whole > 0 else "chunks" if share > bands.share else None
    return {"ratio": ratio, "outside_share": share, "reason": reason}


#: Labelled documents that :func:`fitted` reads at most.
FIT_SAMPLE = 50_000


def fitted(docs: DataFrame, labels: DataFrame, sample: int = FIT_SAMPLE, margin: float = 0.01, tail: float = 0.001, least: int = 20) -> Bands:
    """Limits from the good documents of a bounded sample of labelled ones.

    ``labels`` has (doc_id, quality); 1 is good. Of the labelled documents that
    pass the base rule, ``sample`` are read (those with the smallest hashes of
    their ids). Bands are half powers of two of the size; a band's limits are
    the ``tail`` quantiles of its good documents' ratios, ``margin`` further
    out. Bands with fewer than ``least`` good documents take the limits of the
    next smaller one.
    """
    good = labels.where("quality = 1").select(F.col("doc_id").alias("id")).distinct()
    picked = docs.select("doc_id", "text").join(good, F.col("doc_id") == F.col("id"), "left_semi").orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    rows = judge(picked).join(picked.select(F.col("doc_id").alias("id"), F.octet_length("text").alias("bytes")).dropDuplicates(["id"]), F.col("doc_id") == F.col("id"))
    rows = rows.where(~F.col("base_failed") & (F.col("bytes") >= 256))
    band = F.least(F.floor(2 * F.log2(F.col("bytes") / 256)), F.lit(19)).cast("int")
    limits = rows.groupBy(band.alias("band")).agg(F.count("*").alias("n"), F.percentile("ratio", F.array(F.lit(tail), F.lit(1 - tail))).alias("q"))
    found = {r["band"]: r["q"] for r in limits.collect() if r["n"] >= least}  # 20 rows at most
    out: list[Band] = []
    for k in range(20):
        if k in found:
            out.append(Band(round(256 * 2 ** (k / 2)), found[k][0] - margin, found[k][1] + margin))
    return Bands(tuple(out))


def judge(docs: DataFrame, bands: Bands = BANDS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Counts and verdict of every text, one row per input row.

    Null and empty texts have no words and fail the base rule; their ratio is
    null. Null ids and repeated rows are kept as they are; other columns are
    not read. No shuffle; memory is bounded by one Arrow batch.
    """
    def run(batch: pa.RecordBatch) -> dict:
        import zstandard

        compressor = zstandard.ZstdCompressor(level=bands.level, write_content_size=False, write_checksum=False)
        out: dict[str, list] = {f.name: [] for f in OUT}
        out["doc_id"] = batch.column(0)
        for text in batch.column(1).to_pylist():
            row = base_counts(text) | verdict((text or "").encode("utf-8", "surrogatepass"), bands, compressor)
            row["kept"] = not row["base_failed"] and row["reason"] is None
            for k, v in row.items():
                out[k].append(v)
        return out

    return map_batches(docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")), run, OUT)


def keep_documents(docs: DataFrame, bands: Bands = BANDS, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that pass, with all their columns; judged in place, so nothing is joined or shuffled.

    Null and empty texts do not pass. Null ids and repeated rows are judged
    like others; columns may have any names. An empty table stays empty.
    """
    from pyspark.sql.functions import pandas_udf

    @pandas_udf(T.BooleanType())
    def passes(texts):
        import pandas as pd
        import zstandard

        compressor = zstandard.ZstdCompressor(level=bands.level, write_content_size=False, write_checksum=False)

        def one(text):
            text = text if isinstance(text, str) else ""
            return not base_counts(text)["base_failed"] and verdict(text.encode("utf-8", "surrogatepass"), bands, compressor)["reason"] is None

        return pd.Series([one(t) for t in texts], dtype=bool)

    from relcast.llm.common import bound_batches

    bound_batches(docs.sparkSession)
    return docs.where(passes(F.col(text_col)))


def op2_query(docs: DataFrame) -> DataFrame:
    return judge(docs)
