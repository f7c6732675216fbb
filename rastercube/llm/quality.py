"""Importance resampling: hashed n-gram models of target and raw text, Gumbel top-k."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rastercube.llm.shared import LOWER, Prefix, blocks, bounded_batches, cut, mix, seeded, word_spans

_IS_WORD = np.array([97 <= c <= 122 or 48 <= c <= 57 or c >= 128 for c in LOWER])
_BITS = 14
BUCKETS = 1 << _BITS


def ngram_buckets(texts: list[bytes | None]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(text number, bucket) of every word and every pair of neighbouring words, in blocks."""
    for part in blocks(texts, back=1):
        lowered = [t.translate(LOWER) + b" " for _, t, _ in part]
        arr, starts, ends = word_spans(b"".join(lowered), _IS_WORD)
        if not len(starts):
            continue
        begin = np.cumsum([0] + [len(t) for t in lowered[:-1]])
        piece = np.searchsorted(begin, starts, "right") - 1
        fresh = starts >= begin[piece] + np.array([again for _, _, again in part])[piece]
        h = Prefix(arr).slices(starts, ends)
        pairs = mix(h[:-1] * np.uint64(0x9E3779B97F4A7C15) ^ h[1:])
        inside = (piece[:-1] == piece[1:]) & fresh[1:]
        who = np.array([i for i, _, _ in part])
        keys = np.concatenate([h[fresh], pairs[inside]])
        yield who[np.concatenate([piece[fresh], piece[1:][inside]])], (keys >> np.uint64(64 - _BITS)).astype(np.int64)


def ngram_counts(docs: DataFrame) -> DataFrame:
    """bucket, raw, target: n-grams of all texts and of those with ``is_target``, summed by bucket.

    Each task adds up its own texts and emits one row a bucket.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        raw, target = np.zeros(BUCKETS, np.int64), np.zeros(BUCKETS, np.int64)
        for b in batches:
            hit = np.array(b.column(1).to_pylist(), bool)
            for who, key in ngram_buckets([x.as_py() for x in b.column(0)]):
                raw += np.bincount(key, minlength=BUCKETS)
                target += np.bincount(key[hit[who]], minlength=BUCKETS)
        some = np.flatnonzero(raw)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(raw[some]), pa.array(target[some])], ["bucket", "raw", "target"])

    parts = docs.select(F.col("text").cast("binary").alias("text"), "is_target").mapInArrow(run, "bucket bigint, raw bigint, target bigint")
    return parts.groupBy("bucket").agg(F.sum("raw").alias("raw"), F.sum("target").alias("target"))


def log_ratios(counts: DataFrame, smooth: float = 1.0) -> np.ndarray:
    """log p_target - log p_raw for each bucket; p are add-one estimates. At most BUCKETS rows are fetched."""
    raw, target = np.full(BUCKETS, smooth), np.full(BUCKETS, smooth)
    for r in counts.collect():
        raw[r["bucket"]] += r["raw"]
        target[r["bucket"]] += r["target"]
    return np.log(target / target.sum()) - np.log(raw / raw.sum())


def weigh(docs: DataFrame, ratios: np.ndarray) -> DataFrame:
    """doc_id, n_ngrams and log_weight, the sum of the ratios of the whole text's n-grams."""
    held = docs.sparkSession.sparkContext.broadcast(ratios)  # BUCKETS doubles

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            weight, n = np.zeros(b.num_rows), np.zeros(b.num_rows, np.int64)
            for who, key in ngram_buckets([x.as_py() for x in b.column(1)]):
                weight += np.bincount(who, held.value[key], b.num_rows)
                n += np.bincount(who, minlength=b.num_rows)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(n), pa.array(weight)], ["doc_id", "n_ngrams", "log_weight"])

    bounded_batches(docs.sparkSession)
    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", F.col("text").cast("binary").alias("text")).mapInArrow(run, f"doc_id {kind}, n_ngrams bigint, log_weight double")


def kth_largest(keys: DataFrame, column: str, k: int, bins: int = 1024, small: int = 4096) -> float | None:
    """The k-th largest value of a column without a global sort; None if there are fewer.

    Each round counts the values in equal bins between two bounds and goes on inside the bin
    that holds the k-th; at most ``bins`` counts are fetched a round, and the last at most
    ``small`` values are sorted. If bounds cannot be told apart any more, they are the value.
    """
    low, high, n = keys.agg(F.min(column), F.max(column), F.count(column)).first()
    if k < 1 or n < k:
        return None
    inside = n
    while inside > small and low < high:
        width = (high - low) / bins
        bin_of = F.least(F.floor((F.col(column) - F.lit(low)) / F.lit(width)), F.lit(bins - 1)).cast("int")
        rows = keys.filter((F.col(column) >= low) & (F.col(column) <= high)).groupBy(bin_of.alias("b")).agg(F.count("*").alias("n"), F.min(column).alias("lo"), F.max(column).alias("hi")).collect()
        for r in sorted(rows, key=lambda r: -r["b"]):
            if k <= r["n"]:
                low, high, inside = r["lo"], r["hi"], r["n"]
                break
            k -= r["n"]
    if low == high:
        return low
    return sorted((r[0] for r in keys.filter((F.col(column) >= low) & (F.col(column) <= high)).select(column).collect()), reverse=True)[k - 1]


def resample(docs: DataFrame, labels: DataFrame, share: float = 0.5, max_target: int = 20_000, seed: int = 31) -> DataFrame:
    """Importance weights of all documents, and which of them a resampling keeps.

    The target model counts the n-grams of at most max_target documents that ``labels`` calls
    good (quality 1), chosen by a seeded hash; the raw model counts those of all documents.
    A document's log weight is the sum of its n-grams' log ratios; a Gumbel variable from a
    seeded hash of its doc_id is added, and the share * n documents with the largest sums are
    kept: a sample without replacement in proportion to the weights. Only doc_id, weight and
    key are written between the passes.

    Returns doc_id, n_ngrams, log_weight, key, kept. Null texts and texts without words weigh
    0; rows with equal keys share their verdict, so repeated rows may exceed the share; an
    empty table gives no rows; without good documents the target model is uniform. Other
    columns are ignored.
    """
    good = labels.filter("quality = 1 and doc_id is not null").select("doc_id").distinct()
    good = good.orderBy(seeded(seed, F.col("doc_id")), "doc_id").limit(max_target).withColumn("is_target", F.lit(True))
    # at most max_target ids
    marked = docs.select("doc_id", "text").join(F.broadcast(good), "doc_id", "left").withColumn("is_target", F.coalesce("is_target", F.lit(False)))
    ratios = log_ratios(ngram_counts(marked))
    uniform = (seeded(seed + 1, F.col("doc_id")).cast("double") + 0.5) / float(1 << 60)
    rows = cut(weigh(docs, ratios).withColumn("key", F.col("log_weight") - F.log(-F.log(uniform))), "weights")
    n = rows.count()
    edge = kth_largest(rows, "key", int(round(share * n)))
    return rows.withColumn("kept", F.col("key") >= F.lit(edge) if edge is not None else F.lit(False))
