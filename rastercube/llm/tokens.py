"""Token ids in binary segment files with Elias-Fano encoded document boundaries.

A segment is one file, of this layout (little-endian):

    magic "RCTS", version u16, id width in bytes u16
    part u64, seq u64            files in the order (part, seq) hold ascending doc_ids
    n_docs u64, n_ids u64, n_null u64, base i64
    boundaries                   Elias-Fano: n_docs + 1 offsets into the ids, from 0 to n_ids
    doc_ids                      Elias-Fano: doc_id - base of those that are not null
    ids                          n_ids * width bytes

and an Elias-Fano sequence is

    n u64, universe u64, low bits u32, words u32, samples u32, reserved u32
    lower halves (packed bits), upper halves (unary bits, in u64 words), select samples (u32)

where sample k is the position of the (256 k)-th set bit of the upper halves.
"""

from __future__ import annotations

import struct
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rastercube.llm.shared import before, bounded_batches, cut, hold, shared_path, tokenizer_path

_SAMPLE = 256
_EF = struct.Struct("<QQIIII")
_HEAD = struct.Struct("<4sHHQQQQQq")


class EliasFano:
    """A non-decreasing sequence in about n * (2 + log2(universe / n)) bits."""

    def __init__(self, n: int, universe: int, low_bits: int, lows: np.ndarray, highs: np.ndarray, samples: np.ndarray):
        self.n, self.universe, self.low_bits, self.lows, self.highs, self.samples = n, universe, low_bits, lows, highs, samples

    @classmethod
    def encode(cls, values: np.ndarray) -> EliasFano:
        v = np.asarray(values, np.uint64)
        n = len(v)
        universe = int(v[-1]) + 1 if n else 0
        l = max(0, (universe // n).bit_length() - 1) if n else 0
        low = v & np.uint64((1 << l) - 1)
        if l:
            bits = ((low[:, None] >> np.arange(l, dtype=np.uint64)) & np.uint64(1)).astype(np.uint8)
            lows = np.packbits(bits.ravel(), bitorder="little")
        else:
            lows = np.zeros(0, np.uint8)
        at = (v >> np.uint64(l)).astype(np.int64) + np.arange(n)
        size = (int(at[-1]) + 1 if n else 0) + 63 >> 6
        highs = np.zeros(size * 64, np.uint8)
        highs[at] = 1
        return cls(n, universe, l, lows, np.packbits(highs, bitorder="little").view(np.uint64), at[::_SAMPLE].astype(np.uint32))

    def write(self) -> bytes:
        return _EF.pack(self.n, self.universe, self.low_bits, len(self.highs), len(self.samples), len(self.lows)) + self.lows.tobytes() + self.highs.tobytes() + self.samples.tobytes()

    @classmethod
    def read(cls, data: memoryview, at: int) -> tuple[EliasFano, int]:
        n, universe, l, words, samples, lows = _EF.unpack_from(data, at)
        at += _EF.size
        low = np.frombuffer(data, np.uint8, lows, at)
        high = np.frombuffer(data[at + lows : at + lows + 8 * words], np.uint64)
        at += lows + 8 * words
        return cls(n, universe, l, low, high, np.frombuffer(data[at : at + 4 * samples], np.uint32)), at + 4 * samples

    def _low(self, i: int) -> int:
        if not self.low_bits:
            return 0
        first = i * self.low_bits
        chunk = int.from_bytes(self.lows[first >> 3 : (first + self.low_bits + 7) >> 3].tobytes(), "little")
        return chunk >> (first & 7) & ((1 << self.low_bits) - 1)

    def select(self, i: int) -> int:
        """The i-th value: from the nearest sample on, at most 256 set bits are passed."""
        if not 0 <= i < self.n:
            raise IndexError(i)
        at, left = int(self.samples[i // _SAMPLE]), i % _SAMPLE
        word = at >> 6
        bits = int(self.highs[word]) >> (at & 63) << (at & 63)
        while left >= (ones := bits.bit_count()):
            left -= ones
            word += 1
            bits = int(self.highs[word])
        for _ in range(left):
            bits &= bits - 1
        at = (word << 6) + (bits & -bits).bit_length() - 1
        return at - i << self.low_bits | self._low(i)

    def all(self) -> np.ndarray:
        at = np.flatnonzero(np.unpackbits(self.highs.view(np.uint8), bitorder="little"))
        v = (at - np.arange(self.n)).astype(np.uint64) << np.uint64(self.low_bits)
        if self.low_bits:
            bits = np.unpackbits(self.lows, bitorder="little", count=self.n * self.low_bits).reshape(self.n, self.low_bits)
            v |= (bits.astype(np.uint64) << np.arange(self.low_bits, dtype=np.uint64)).sum(1, dtype=np.uint64)
        return v


class Segment:
    """A segment file's content: doc_id(i), ids(i), span(i) without decoding the rest."""

    def __init__(self, data: bytes | memoryview):
        self.data = memoryview(data)
        magic, version, self.width, self.part, self.seq, self.n_docs, self.n_ids, self.n_null, self.base = _HEAD.unpack_from(self.data, 0)
        if magic != b"RCTS" or version != 1:
            raise ValueError("not a token segment")
        self.bounds, at = EliasFano.read(self.data, _HEAD.size)
        self.doc_ids, self.at = EliasFano.read(self.data, at)

    def span(self, i: int) -> tuple[int, int]:
        return self.bounds.select(i), self.bounds.select(i + 1)

    def doc_id(self, i: int) -> int | None:
        return None if i < self.n_null else self.base + self.doc_ids.select(i - self.n_null)

    def ids(self, i: int) -> np.ndarray:
        a, b = self.span(i)
        return np.frombuffer(self.data, f"<u{self.width}", b - a, self.at + a * self.width).astype(np.uint32)

    def rows(self) -> Iterator[tuple[int | None, int, np.ndarray]]:
        """(doc_id, offset in the segment, ids) of every document."""
        ids = np.frombuffer(self.data, f"<u{self.width}", self.n_ids, self.at)
        b = self.bounds.all().tolist()
        who = [None] * self.n_null + [self.base + x for x in self.doc_ids.all().tolist()]
        for i, d in enumerate(who):
            yield d, b[i], ids[b[i] : b[i + 1]].astype("<u4")


def segment(part: int, seq: int, doc_ids: list[int | None], ids: list[bytes], width: int) -> bytes:
    """The bytes of one file; ids: each document's ids, packed in ``width`` bytes each."""
    known = [d for d in doc_ids if d is not None]
    base = known[0] if known else 0
    bounds = np.concatenate([[0], np.cumsum([len(x) // width for x in ids], dtype=np.int64)])
    head = _HEAD.pack(b"RCTS", 1, width, part, seq, len(doc_ids), int(bounds[-1]), len(doc_ids) - len(known), base)
    return b"".join([head, EliasFano.encode(bounds).write(), EliasFano.encode(np.array([d - base for d in known], np.uint64)).write(), *ids])


# ---- the tokenizer, with caches --------------------------------------------------------------

#: How the byte-level tokenizer cuts text before it merges (fixed by its file format).
_PATTERN = regex.compile(r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+""")
#: Characters of which every version of Unicode says the same: ASCII and accented Latin letters.
_PLAIN = regex.compile("[\t\n\r -~À-ÖØ-öø-ſ]*")
_APART = regex.compile(r"(?<=\S)(?= \S)", regex.V1)
_CHUNKS, _WORDS = 350_000, 100_000
#: Marks that are a piece of their own behind a word, whatever follows the space after them.
_MARKS = ".,;:!?"


class _Crowded(Exception):
    pass


class Encoder:
    """The tokenizers library's ids of whole texts, packed; repeated pieces are looked up.

    A byte-level tokenizer never merges across a space that stands before a visible
    character, so a text's ids are those of its pieces between such spaces, one after another.
    Pieces with unusual characters, and whole texts with an added token's string, go to the
    library as they are. The caches are bounded: what comes when one is full is encoded each time.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.added = [t.content for t in self.library.get_added_tokens_decoder().values()]
        self.width = 2 if self.library.get_vocab_size() <= 1 << 16 else 4
        self.fast = "ByteLevel" in str(self.library.pre_tokenizer)[:9] and "add_prefix_space=False" in str(self.library.pre_tokenizer) and "use_regex=True" in str(self.library.pre_tokenizer) and self.library.normalizer is None
        self.model = self.library.model
        self.chunks: dict[str, bytes] = {}
        self.words: dict[str, bytes] = {}
        plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
        self.shown = {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(b for b in range(256) if b not in set(plain))}
        self.marks = {m: self.token(m) for m in _MARKS} if self.fast else {}
        self.line = self.token("\n") if self.fast else b""

    def pack(self, ids: list[int]) -> bytes:
        return array("H" if self.width == 2 else "I", ids).tobytes()

    def direct(self, text: str) -> bytes:
        return self.pack(self.library.encode(text, add_special_tokens=False).ids)

    def token(self, s: str) -> bytes:
        """The ids of one piece, as the tokenizer's pattern cuts it."""
        shown = s if s.isascii() else s.encode().decode("latin-1")
        return self.pack([t.id for t in self.model.tokenize(shown.translate(self.shown))])

    def piece(self, s: str) -> bytes:
        if not _PLAIN.fullmatch(s):
            return self.direct(s)
        got = self.words.get(s)
        if got is None:
            got = b"".join(map(self.token, _PATTERN.findall(s)))
            if len(self.words) < _WORDS:
                self.words[s] = got
        return got

    def spaced(self, c: str) -> bytes:
        """The ids of a space and c, which begins with a visible character."""
        if not c or c[0].isspace():
            raise _Crowded
        plain = c.isascii() or _PLAIN.fullmatch(c)
        if plain and c.isalpha():
            got = self.token(" " + c)
        elif plain and c[-1] in self.marks and (stem := c[:-1]).isalpha():
            return (self.chunks.get(stem) or self.spaced(stem)) + self.marks[c[-1]]
        elif plain and (at := c.find("\n")) > 0 and not c[at - 1].isspace() and not c[at + 1 : at + 2].isspace() and at + 1 < len(c):
            # a line feed between visible characters is a piece of its own
            return (self.chunks.get(c[:at]) or self.spaced(c[:at])) + self.line + self.piece(c[at + 1 :])
        else:
            got = self.piece(" " + c)
        if len(self.chunks) < _CHUNKS:
            self.chunks[c] = got
        return got

    def encode(self, text: str) -> bytes:
        if not text:
            return b""
        if not self.fast or any(x in text for x in self.added):
            return self.direct(text)
        first, *rest = text.split(" ")
        get, miss = self.chunks.get, self.spaced
        try:
            return b"".join([self.piece(first) if first else b"", *[get(c) or miss(c) for c in rest]])
        except _Crowded:  # a space before white space stays with it
            return b"".join(map(self.piece, _APART.split(text)))


# ---- write and read --------------------------------------------------------------------------


def write_segments(docs: DataFrame, path: str, tokenizer: str = "byte_bpe_50k.json", end_id: int = 2, segment_ids: int = 1 << 25) -> None:
    """Encode every document and write segment files under path, in ascending doc_id order.

    Documents are range-partitioned by doc_id and sorted inside a partition; a task streams
    over its range and closes a segment at about segment_ids ids, so it holds one segment at a
    time. Files are written by Spark's own committed writer: a lost task is done again and
    leaves nothing half written, and any file system that Spark knows will do. A binary value
    cast to string keeps its bytes, and one record a file makes a file of it; the writer
    puts one line feed behind, which readers skip.

    A null text is empty: its ids are the end id alone; a very long one is encoded whole. Null
    doc_ids come first. Rows that repeat a doc_id stay next to each other, in the order of a
    hash of the text. An empty table makes no segment. Other
    columns are ignored. doc_id must be an integer type.
    """
    bounded_batches(docs.sparkSession)
    file = tokenizer if "/" in tokenizer else tokenizer_path(tokenizer)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        enc, part, seq = hold(("tokens", file), lambda: Encoder(file)), TaskContext.get().partitionId(), 0
        end = enc.pack([end_id])
        who, ids, held = [], [], 0
        for b in batches:
            for d, t in zip(b.column(0).to_pylist(), b.column(1), strict=True):
                packed = enc.encode(t.as_py() or "") + end
                who.append(d)
                ids.append(packed)
                held += len(packed)
                if held >= segment_ids * enc.width:
                    yield row(segment(part, seq, who, ids, enc.width))
                    who, ids, held, seq = [], [], 0, seq + 1
        if who:
            yield row(segment(part, seq, who, ids, enc.width))

    def row(data: bytes) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([data], pa.binary())], ["data"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").withColumn("_t", F.xxhash64("text"))
    rows = rows.repartitionByRange(F.col("doc_id").asc_nulls_first(), "_t").sortWithinPartitions(F.col("doc_id").asc_nulls_first(), "_t", "text")
    files = rows.select("doc_id", "text").mapInArrow(run, "data binary")
    files.select(F.col("data").cast("string").alias("value")).write.option("maxRecordsPerFile", 1).option("compression", "none").text(path)


def read_segments(spark, path: str) -> DataFrame:
    """part, seq, slot, doc_id, offset, n_tokens, ids_crc32, segment_ids of every document in the files."""
    kind = "part bigint, seq bigint, slot bigint, doc_id bigint, offset bigint, n_tokens bigint, ids_crc32 bigint, segment_ids bigint"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hold("read", dict)
        for b in batches:
            for content in b.column(0):
                s = Segment(content.as_buffer())
                out = [(s.part, s.seq, i, d, at, len(x), zlib.crc32(x.tobytes()), s.n_ids) for i, (d, at, x) in enumerate(s.rows())]
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out, strict=True)], [c.split()[0] for c in kind.split(", ")])

    return spark.read.format("binaryFile").load(path).select("content").mapInArrow(run, kind)


def manifest_path(path: str) -> str:
    return path.rstrip("/") + "-manifest"


def token_index(docs: DataFrame, tokenizer: str = "byte_bpe_50k.json", end_id: int = 2, path: str | None = None) -> DataFrame:
    """Write docs as segments (into the shared folder unless a path is given) and index the files.

    Returns from the files: doc_id, start (ids of all documents before it), n_tokens and
    ids_crc32, and the document's file as (part, seq, slot). The files stay, and beside them
    a manifest with (part, seq, n_docs, n_ids, start) of each, so that a reader of some
    documents need not open the others' files. Null, empty and repeated rows are as
    write_segments() says; an empty table gives no rows.
    """
    spark = docs.sparkSession
    path = path or shared_path(spark, "tokens")
    write_segments(docs, path, tokenizer, end_id)
    rows = cut(read_segments(spark, path), "token-rows")
    files = rows.groupBy("part", "seq").agg(F.count("*").alias("n_docs"), F.first("segment_ids").alias("n_ids"))
    before(files, [], "part", F.col("n_ids"), [F.col("seq")], "start").write.parquet(manifest_path(path))
    bases = spark.read.parquet(manifest_path(path)).select(F.col("part").alias("_p"), F.col("seq").alias("_q"), F.col("start").alias("_first"))
    out = rows.join(bases, (rows["part"] == bases["_p"]) & (rows["seq"] == bases["_q"]))
    return out.select("doc_id", (F.col("_first") + F.col("offset")).alias("start"), "n_tokens", "ids_crc32", "part", "seq", "slot")
