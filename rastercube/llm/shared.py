"""Helpers that several corpus operators use: shared storage, distributed ranks, word hashing."""

from __future__ import annotations

import contextlib
import ctypes
import gc
import os
import tempfile
import uuid
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Arrow batches are cut again to about this many bytes of text before numpy sees them.
BLOCK_BYTES = 1 << 20


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir`` of the session.

    Only where it is unset and the master is local (tests) a temporary folder is made;
    on a cluster an unset folder is an error, since local disks are not shared.
    """
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        jdir = spark.sparkContext._jsc.sc().getCheckpointDir()
        found = jdir.get() if jdir.isDefined() else None
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        found = "file://" + tempfile.mkdtemp(prefix="rastercube-")
        spark.sparkContext.setCheckpointDir(found)
    return found.rstrip("/")


def shared_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/rastercube/{name}-{uuid.uuid4().hex}"


def cut(df: DataFrame, name: str) -> DataFrame:
    """Write df as Parquet in the shared folder and read it again: lineage ends there."""
    spark = df.sparkSession
    path = shared_path(spark, name)
    df.write.parquet(path)
    give_back()
    return spark.read.schema(df.schema).parquet(path)


def small(df: DataFrame, rows: int = 1 << 18) -> DataFrame:
    """df for a join: broadcast if a count finds at most that many rows (of a few numbers each), else as it is."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


def held_out(doc_id: Column) -> Column:
    """crc32(doc_id as text) mod 5 = 0; false for a null id."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 5 == 0, F.lit(False))


def seeded(seed: int, *cols: Column) -> Column:
    """A 60-bit pseudo-random long from the columns' text: the first 15 hex digits of an md5."""
    text = F.concat_ws("|", F.lit(str(seed)), *[F.coalesce(c.cast("string"), F.lit("")) for c in cols])
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 15), 16, 10).cast("long")


#: seeded() gives 60 bits; a bucket is its leading 12 of them.
BUCKET_SHIFT, BUCKETS = 48, 4096


def bucket_of(h: Column) -> Column:
    return F.shiftright(h, BUCKET_SHIFT).cast("int")


def before(df: DataFrame, group: list[str], bucket: str, amount: Column, order: list[Column], out: str) -> DataFrame:
    """Add ``out``: the sum of amount over the rows of the group that come earlier.

    The order is (bucket, *order). A group is spread over its buckets, so the large
    window sorts one bucket at a time; what comes before a bucket is a running sum over
    one pre-aggregated row for each bucket. Amounts must be longs and not null.
    """
    df = df.withColumn("_amount", amount)
    keys = [*group, bucket]
    sums = df.groupBy(*keys).agg(F.sum("_amount").alias("_sum"))
    over = Window.partitionBy(*group) if group else Window.partitionBy()
    sums = sums.withColumn("_base", F.sum("_sum").over(over.orderBy(bucket).rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.col("_sum"))
    inside = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows = df.withColumn("_in", F.sum("_amount").over(inside) - F.col("_amount"))
    named = sums.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], "_base")
    same = [rows[k].eqNullSafe(named[f"_k{i}"]) for i, k in enumerate(keys)]
    on = same[0]
    for x in same[1:]:
        on = on & x
    return rows.join(named, on).withColumn(out, F.col("_base") + F.col("_in")).drop("_amount", "_in", "_base", *[f"_k{i}" for i in range(len(keys))])


#: Bytes of an Arrow batch that crosses to a worker, where the session leaves Spark's default.
BATCH_BYTES = 4 << 20


def bounded_batches(spark: SparkSession) -> None:
    """Texts cross to the workers in batches of bounded bytes: ten thousand long ones at once would cost both sides much memory."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    if spark.conf.get(name).rstrip("bB") == str(64 << 20):
        spark.conf.set(name, str(BATCH_BYTES))


def with_text_bytes(docs: DataFrame, *columns: str) -> DataFrame:
    bounded_batches(docs.sparkSession)
    return docs.select(*columns, F.col("text").cast("binary").alias("text"))


def give_back() -> None:
    """Return what this process has freed to the system."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # where the C library is not glibc
        ctypes.CDLL("libc.so.6").malloc_trim(0)


_held: dict = {}


def hold(key, make):
    """A worker process' one large object: kept for the next task, until another key is asked for.

    Workers serve one stage after the other; what an earlier one built must not stay beside
    what this one needs, and what it has freed goes back to the system.
    """
    if key not in _held:
        _held.clear()
        give_back()
        _held[key] = make()
    return _held[key]


# ---- numpy: hashes of the words of a block of text -------------------------------------------

#: Fixed odd multiplier of the polynomial hash, and its inverse modulo 2**64.
_R = 0x9E3779B97F4A7C15
_R_INV = pow(_R, -1, 1 << 64)
_powers: dict[str, np.ndarray] = {}


def _power(base: int, n: int) -> np.ndarray:
    """base ** 0 .. n-1 modulo 2**64; kept, and grown by doubling."""
    key = f"{base}"
    have = _powers.get(key)
    if have is None or len(have) < n:
        size = 1 << max(16, (n - 1).bit_length())
        have = np.empty(size, np.uint64)
        have[0] = 1
        done = 1
        while done < size:
            have[done : 2 * done] = have[:done] * np.uint64(pow(base, done, 1 << 64))
            done *= 2
        _powers[key] = have
    return have[:n]


def mix(h: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xFF51AFD7ED558CCD)
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


class Prefix:
    """Hashes of any slices of a byte block in O(1) each, by a running polynomial sum."""

    def __init__(self, block: np.ndarray):
        n = len(block)
        self.sums = np.zeros(n + 1, np.uint64)
        np.cumsum((block.astype(np.uint64) + np.uint64(1)) * _power(_R, n), out=self.sums[1:])
        self.inverse = _power(_R_INV, n + 1)

    def slices(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return mix((self.sums[ends] - self.sums[starts]) * self.inverse[starts])


def blocks(texts, limit: int = BLOCK_BYTES, back: int = 0):
    """Lists of (index, bytes, repeated) of about limit bytes.

    A longer text is cut behind a space where there is one; the next part then begins with
    the last ``back`` pieces between spaces of the one before, and ``repeated`` is the number
    of bytes that are there again.
    """
    out, held = [], 0
    for i, t in enumerate(texts):
        t = t or b""
        at = again = 0
        while len(t) - at > limit:
            end = t.rfind(b" ", at + limit // 2, at + limit) + 1 or at + limit
            if out:
                yield out
                out, held = [], 0
            yield [(i, t[at:end], again)]
            begin = end
            for _ in range(back):
                begin = t.rfind(b" ", at + again, begin - 1) + 1 or end
            at, again = begin, end - begin
        out.append((i, t[at:] if at else t, again))
        held += len(t) - at
        if held >= limit:
            yield out
            out, held = [], 0
    if out:
        yield out


def word_spans(joined: bytes, is_word: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The block as an array, and starts and ends of its maximal runs of bytes with is_word[byte]."""
    arr = np.frombuffer(joined, np.uint8)
    inside = np.empty(len(arr) + 2, np.int8)
    inside[0] = inside[-1] = 0
    inside[1:-1] = is_word[arr]
    edge = np.flatnonzero(inside[1:] != inside[:-1])
    return arr, edge[0::2], edge[1::2]


#: A-Z to a-z; every other byte as it is.
LOWER = bytes(range(256)).lower()


def crc(data: bytes, start: int = 0) -> int:
    return zlib.crc32(data, start)


def tokenizer_path(name: str) -> str:
    """Where the public vocabulary files are: RASTERCUBE_TOKENIZERS, or the installed package."""
    folder = os.environ.get("RASTERCUBE_TOKENIZERS")
    if folder:
        return os.path.join(folder, name)
    import public_tokenizers

    return public_tokenizers.path(name)
