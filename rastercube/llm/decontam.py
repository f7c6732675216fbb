"""Benchmark decontamination: Wu-Manber search for the benchmark's word windows in documents."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rastercube.llm.shared import LOWER, bounded_batches, hold

#: Bytes that belong to words after A-Z is lower-cased; every other byte is a gap.
_TO_WORDS = bytes(c if chr(c).isalnum() and c < 128 or c >= 128 else 32 for c in LOWER)
#: Words of a text that are matched at once.
_PIECE = 1 << 20


def words_of(text: bytes | None) -> list[bytes]:
    return text.translate(_TO_WORDS).split() if text else []


def windows(text: bytes | None, size: int = 10) -> list[tuple[bytes, ...]]:
    """Every run of ``size`` consecutive words; of fewer words, but not none, one run of all."""
    w = words_of(text)
    return [tuple(w[i : i + size]) for i in range(max(1, len(w) - size + 1))] if w else []


class WuManber:
    """Multi-pattern search over words, for patterns of one length m.

    A block is two neighbouring words (one if m is 1). ``shift`` says how far the window can
    move when a block stands at its end: the least distance from an occurrence of the block in
    any pattern to that pattern's end, or m - B + 1 if it occurs in none. A shift of zero
    leads to the bucket of the patterns that end in the block; those whose first block is
    equal too are compared word by word.
    """

    def __init__(self, patterns: dict[tuple[int, ...], set], length: int, base: int):
        self.m, self.base, self.b = length, base, min(2, length)
        self.far = length - self.b + 1
        self.shift: dict[int, int] = {}
        self.bucket: dict[int, dict[int, list]] = {}
        for pattern, items in patterns.items():
            for j in range(self.b - 1, length):
                code = self._code(pattern, j)
                self.shift[code] = min(self.shift.get(code, self.far), length - 1 - j)
            self.bucket.setdefault(self._code(pattern, length - 1), {}).setdefault(self._code(pattern, self.b - 1), []).append((list(pattern), items))

    def _code(self, ids, j: int) -> int:
        return ids[j - 1] * self.base + ids[j] if self.b == 2 else ids[j]

    def find(self, ids: list[int]) -> Iterator[tuple[int, set]]:
        m, base, far, shift, pos, n = self.m, self.base, self.far, self.shift.get, self.m - 1, len(ids)
        two = self.b == 2
        while pos < n:
            code = ids[pos - 1] * base + ids[pos] if two else ids[pos]
            step = shift(code, far)
            if step:
                pos += step
                continue
            first = pos - m + 1
            for pattern, items in self.bucket[code].get(ids[first] * base + ids[first + 1] if two else ids[first], ()):
                if ids[first : pos + 1] == pattern:
                    yield first, items
            pos += 1


class Searcher:
    """Wu-Manber tables of one block of benchmark items, one for each window length."""

    def __init__(self, items: list[tuple[str, bytes]], size: int = 10):
        self.vocabulary: dict[bytes, int] = {}
        by_length: dict[int, dict[tuple[int, ...], set]] = {}
        for item, text in items:
            for w in windows(text, size):
                ids = tuple(self.vocabulary.setdefault(x, len(self.vocabulary) + 1) for x in w)
                by_length.setdefault(len(w), {}).setdefault(ids, set()).add(item)
        base = len(self.vocabulary) + 1
        self.tables = [WuManber(p, m, base) for m, p in sorted(by_length.items())]
        self.longest = max(by_length, default=0)

    def search(self, text: bytes | None) -> tuple[int, list[tuple[int, int]], set]:
        """Number of words, merged spans [start, end) of hit words, items found.

        The text is cut into pieces; the last words of a piece are looked at again before
        the next, so no window is lost at a cut.
        """
        get, spans, items, n, tail = self.vocabulary.get, [], set(), 0, []
        text = (text or b"").translate(_TO_WORDS)
        at = 0
        while at < len(text):
            end = len(text)
            if end - at > _PIECE:
                end = text.rfind(b" ", at, at + _PIECE) + 1 or text.find(b" ", at + _PIECE) + 1 or end
            words = text[at:end].split()
            at = end
            ids = tail + [get(w, 0) for w in words]
            origin = n - len(tail)
            for table in self.tables:
                for first, found in table.find(ids):
                    spans.append((origin + first, origin + first + table.m))
                    items |= found
            n += len(words)
            tail = ids[-(self.longest - 1) :] if self.longest > 1 else []
        return n, merged(spans), items


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def find_contamination(docs: DataFrame, benchmark: DataFrame, size: int = 10, block_bytes: int = 1 << 20, held_bytes: int = 16 << 20) -> DataFrame:
    """All columns of docs, and n_words, spans (array of start, end by turns), items (sorted ids).

    The benchmark is a query set: it is dealt into blocks of about block_bytes of text by a
    hash of the item, each with tables of its own, and broadcast. One pass of a worker over a
    batch of documents asks all blocks in turn; it keeps the tables of held_bytes of blocks
    and builds further ones anew for each batch, so a larger benchmark costs time, not memory.
    Beyond 64 times held_bytes there are several passes. A document's row is never shuffled.

    Null texts and texts without words have no words and no hits; very long texts are searched
    in pieces; benchmark rows without words or id match nothing; rows that repeat an item_id are
    one item; repeated documents keep their rows; equal windows of several items count for each
    item; an empty benchmark leaves every document clean, and an empty table gives no rows.
    Columns named n_words, spans, items or _text are replaced.
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    bench = benchmark.select(F.col("item_id").cast("string").alias("item"), F.col("text").cast("binary").alias("text")).filter("item is not null and text is not null")
    total = bench.agg(F.sum(F.octet_length("text") + 16)).first()[0] or 0
    parts, held = max(1, -(-total // block_bytes)), max(1, held_bytes // block_bytes)
    bench = bench.withColumn("part", F.pmod(F.xxhash64("item"), F.lit(parts)))
    keep = [c for c in docs.columns if c not in ("n_words", "spans", "items", "_text")]
    empty = F.array().cast("array<string>")
    out = docs.select(*keep, F.col("text").cast("binary").alias("_text"), F.lit(0).cast("long").alias("n_words"), F.array().cast("array<bigint>").alias("spans"), empty.alias("items"))
    for low in range(0, parts, 64 * held):
        # at most 64 * held_bytes, whatever the benchmark's size
        some: dict[int, list] = {}
        for r in bench.filter(F.col("part").between(low, low + 64 * held - 1)).toLocalIterator():
            some.setdefault(r["part"], []).append((r["item"], bytes(r["text"])))
        blocks = [some[k] for k in sorted(some)] or [[]]
        key = (hashlib.sha256(repr(blocks).encode()).hexdigest(), size)
        out = _pass(out, spark.sparkContext.broadcast(blocks), size, held, key)
    return out.drop("_text")


def _pass(docs: DataFrame, blocks, size: int, held: int, key) -> DataFrame:
    names = docs.columns
    at = {c: names.index(c) for c in ("_text", "n_words", "spans", "items")}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept = hold(key, lambda: [Searcher(x, size) for x in blocks.value[:held]])
        for b in batches:
            texts = b.column(at["_text"])
            n_words = [0] * b.num_rows
            spans = [list(zip(x[0::2], x[1::2], strict=True)) for x in b.column(at["spans"]).to_pylist()]
            items = [set(x) for x in b.column(at["items"]).to_pylist()]
            for i in range(len(blocks.value)):
                searcher = kept[i] if i < held else Searcher(blocks.value[i], size)
                for j, text in enumerate(texts):
                    n_words[j], found, who = searcher.search(text.as_py())
                    if found:
                        spans[j] = merged(spans[j] + found) if spans[j] else found
                        items[j] |= who
            columns = list(b.columns)
            columns[at["n_words"]] = pa.array(n_words, pa.int64())
            columns[at["spans"]] = pa.array([[x for s in found for x in s] for found in spans], pa.list_(pa.int64()))
            columns[at["items"]] = pa.array([sorted(x) for x in items], pa.list_(pa.string()))
            yield pa.RecordBatch.from_arrays(columns, names)

    return docs.mapInArrow(run, docs.schema)


def verdicts(found: DataFrame) -> DataFrame:
    """find_contamination()'s rows with n_hit, n_items, items_sha256 and contaminated."""
    n_hit = F.expr("aggregate(sequence(0, greatest(size(spans), 2) div 2 - 1), 0L, (a, i) -> a + coalesce(get(spans, 2 * i + 1) - get(spans, 2 * i), 0L))")
    return (
        found.withColumn("n_hit", n_hit)
        .withColumn("n_items", F.size("items").cast("long"))
        .withColumn("items_sha256", F.sha2(F.concat_ws(",", "items").cast("binary"), 256))
        .withColumn("contaminated", F.col("n_hit") > 0)
    )


def digest(items: list[str]) -> str:
    return hashlib.sha256(",".join(sorted(items)).encode()).hexdigest()
