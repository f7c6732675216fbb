"""Language identification by bit-sliced Bloom filters of byte n-grams."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rastercube.llm.shared import LOWER, blocks, cut, held_out, hold, seeded, small, with_text_bytes

#: ASCII letters are lower-cased, bytes of other scripts stay, all else is a gap.
_LETTERS = bytes(c if 97 <= c <= 122 or c >= 128 else 32 for c in LOWER)
_N = 4
#: Odd multipliers of the hash functions (fixed values).
_HASHES = (0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D)


def has_letter(text: bytes | None) -> bool:
    if not text:
        return False
    gone = text.translate(_LETTERS).strip()
    if not gone:
        return False
    return any(97 <= c <= 122 for c in gone) or any(c.isalpha() for c in text.decode("utf-8", "ignore"))


def normal(text: bytes) -> bytes:
    """Words parted by one space, a space before and two behind, so that any word has an n-gram."""
    return b" " + b" ".join(text.translate(_LETTERS).split()) + b"  "


def grams(block: np.ndarray) -> np.ndarray:
    """The n-gram that starts at each byte, as one 32-bit number."""
    a = block.astype(np.uint32)
    return a[:-3] | a[1:-2] << np.uint32(8) | a[2:-1] << np.uint32(16) | a[3:] << np.uint32(24)


def text_grams(text: bytes) -> Iterator[np.ndarray]:
    """The n-grams of a whole text, a block at a time."""
    for part in blocks([text]):
        yield grams(np.frombuffer(b"".join(normal(t) for _, t, _ in part), np.uint8))


def cells(keys: np.ndarray, bits: int) -> Iterator[np.ndarray]:
    """Where each hash function puts the keys in a table of 1 << bits cells."""
    shift = np.uint32(32 - bits)
    for m in _HASHES:
        x = keys * np.uint32(m)
        yield (x ^ (x >> np.uint32(15))) * np.uint32(0x2C1B3C6D) >> shift


class Filters:
    """For all languages at once: cell c of the table has bit l if some hash of an n-gram of language l is c.

    One look-up a hash function returns a mask of languages; the conjunction over the hash
    functions holds all languages whose set has the n-gram, and a few by chance. Beyond 64
    languages there are several planes of masks.
    """

    def __init__(self, languages: list[str], planes: list[np.ndarray], bits: int):
        self.languages, self.planes, self.bits = languages, planes, bits
        self.per = planes[0].dtype.itemsize * 8
        filled = [np.count_nonzero(self.planes[i // self.per] >> planes[0].dtype.type(i % self.per) & planes[0].dtype.type(1)) / (1 << bits) for i in range(len(languages))]
        #: chance that an n-gram outside of a language's set passes its filter
        self.chance = np.array(filled) ** len(_HASHES) if filled else np.zeros(0)

    @classmethod
    def empty(cls, n: int, bits: int) -> list[np.ndarray]:
        """Planes for n languages, of the narrowest integers that hold them."""
        kind = next((k for k, w in ((np.uint8, 8), (np.uint16, 16), (np.uint32, 32)) if n <= w), np.uint64)
        return [np.zeros(1 << bits, kind) for _ in range(-(-n // (np.dtype(kind).itemsize * 8)) or 1)]

    @classmethod
    def of_sets(cls, languages: list[str], sets: list[np.ndarray], bits: int = 20) -> Filters:
        planes = cls.empty(len(languages), bits)
        per = planes[0].dtype.itemsize * 8
        for i, keys in enumerate(sets):
            for c in cells(keys, bits):
                planes[i // per][c] |= planes[0].dtype.type(1 << i % per)
        return cls(languages, planes, bits)

    def counts(self, keys: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """For each range of keys and each language, how many keys pass; shape (ranges, languages)."""
        at = list(cells(keys, self.bits))
        out = np.zeros((len(starts), len(self.languages)), np.int64)
        for p, plane in enumerate(self.planes):
            mask = plane[at[0]]
            for c in at[1:]:
                mask &= plane[c]
            for l in range(p * self.per, min(len(self.languages), (p + 1) * self.per)):
                run = np.concatenate([[0], np.cumsum(mask >> mask.dtype.type(l % self.per) & mask.dtype.type(1), dtype=np.int64)])
                out[:, l] = run[ends] - run[starts]
        return out

    def corrected(self, counts: np.ndarray, totals: np.ndarray) -> np.ndarray:
        """Expected true members: what passes by chance is taken off."""
        return np.maximum(0, (counts - totals[:, None] * self.chance) / np.maximum(1e-9, 1 - self.chance))


class Model:
    """Filters and the languages' order of preference in a tie (the more frequent one)."""

    def __init__(self, filters: Filters):
        self.filters = filters

    @classmethod
    def fit(cls, rows: list[tuple[bytes, str]], share: float = 0.2, least: int = 2) -> Model:
        """rows: (text, language), held in memory. An n-gram belongs to each language in which its
        rate is at least ``share`` of its highest rate in any, and which has it ``least`` times."""
        by: dict[str, list[bytes]] = {}
        for text, lang in rows:
            by.setdefault(lang, []).append(text)
        order = sorted(by, key=lambda k: (-len(by[k]), k))
        found = []
        for lang in order:
            keys, n = np.unique(np.concatenate([g for t in by[lang] for g in text_grams(t)]), return_counts=True)
            found.append((keys, n, n / max(1, n.sum())))
        every = np.unique(np.concatenate([k for k, _, _ in found])) if found else np.zeros(0, np.uint32)
        top = np.zeros(len(every))
        for keys, _, rate in found:
            at = np.searchsorted(every, keys)
            top[at] = np.maximum(top[at], rate)
        sets = [keys[(rate >= share * top[np.searchsorted(every, keys)]) & (n >= least)] for keys, n, rate in found]
        return cls(Filters.of_sets(order, sets))

    def predict(self, texts: list[bytes | None]) -> tuple[list[str], list[float]]:
        langs = self.filters.languages
        total = np.zeros(len(texts), np.int64)
        passed = np.zeros((len(texts), len(langs)), np.int64)
        for part in blocks(texts):
            cleaned = [normal(t) for _, t, _ in part]
            ends = np.cumsum([len(x) for x in cleaned])
            starts = ends - [len(x) for x in cleaned]
            keys = grams(np.frombuffer(b"".join(cleaned), np.uint8))
            who = np.array([i for i, _, _ in part])
            np.add.at(passed, who, self.filters.counts(keys, starts, ends - 3))
            np.add.at(total, who, ends - 3 - starts)
        good = self.filters.corrected(passed, total)
        best = good.argmax(1) if len(langs) else np.zeros(len(texts), int)
        whole = good.sum(1)
        names, scores = [], []
        for i, t in enumerate(texts):
            if not langs or not has_letter(t):
                names.append("und")
                scores.append(0.0)
            else:
                names.append(langs[best[i]])
                scores.append(float(good[i, best[i]] / whole[i]) if whole[i] else 0.0)
        return names, scores


def training_rows(docs: DataFrame, per_language: int, seed: int = 23) -> DataFrame:
    """doc_id, lang and whole text of at most per_language training rows of each language, by a seeded hash.

    Training rows have a text, a lang, and a crc32(doc_id) that is not 0 modulo 5. A rank limit
    cuts every partition before the shuffle, so a hot language costs no more than another.
    """
    rows = docs.filter("text is not null and lang is not null and doc_id is not null").filter(~held_out(F.col("doc_id")))
    ids = rows.select("doc_id", "lang", seeded(seed, F.col("doc_id")).alias("_h")).distinct()
    top = ids.withColumn("_r", F.row_number().over(Window.partitionBy("lang").orderBy("_h", "doc_id"))).filter(F.col("_r") <= per_language).select("doc_id", "lang")
    return rows.join(small(top), ["doc_id", "lang"]).groupBy("doc_id", "lang").agg(F.min("text").alias("text"))


def fit(docs: DataFrame, per_language: int = 1500, share: float = 0.2, least: int = 2, bits: int = 20) -> Model:
    """Model.fit() of training_rows(), counted by Spark: the driver gets names and the cells of the filters.

    Each task counts its own texts' n-grams by language; the counts are summed, an n-gram's
    rates compared, and the cells of those that belong somewhere combined by bit_or, so what
    reaches the driver is the table itself, whatever the texts and however many n-grams.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hold("langid", dict)
        for b in batches:
            held: dict[str, list[np.ndarray]] = {}
            for lang, text in zip(b.column(0).to_pylist(), b.column(1), strict=True):
                for g in text_grams(text.as_py()):
                    held.setdefault(lang, []).append(g)
                    if len(held[lang]) == 256:
                        yield summed(lang, held.pop(lang))
            for lang, parts in held.items():
                yield summed(lang, parts)

    def summed(lang: str, parts: list[np.ndarray]) -> pa.RecordBatch:
        keys, n = np.unique(np.concatenate(parts), return_counts=True)
        return pa.RecordBatch.from_arrays([pa.array([lang] * len(keys), pa.string()), pa.array(keys.astype(np.int64)), pa.array(n, pa.int64())], ["lang", "k", "n"])

    rows = with_text_bytes(training_rows(docs, per_language), "lang")
    order = [r["lang"] for r in rows.groupBy("lang").agg(F.count("*").alias("c")).orderBy(F.col("c").desc(), "lang").collect()]
    planes = Filters.empty(len(order), bits)
    per = planes[0].dtype.itemsize * 8
    if not order:
        return Model(Filters(order, planes, bits))
    counts = cut(rows.mapInArrow(run, "lang string, k bigint, n bigint").groupBy("lang", "k").agg(F.sum("n").alias("n")), "ngrams")
    total = counts.groupBy("lang").agg(F.sum("n").alias("total"))
    place = docs.sparkSession.createDataFrame([(x, i) for i, x in enumerate(order)], "lang string, i int")
    rated = counts.join(F.broadcast(total.join(place, "lang")), "lang").withColumn("rate", F.col("n") / F.col("total"))
    top = rated.groupBy("k").agg(F.max("rate").alias("top"))
    member = rated.join(top, "k").filter((F.col("rate") >= share * F.col("top")) & (F.col("n") >= least))

    def place_cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keys = b.column(0).to_numpy().astype(np.uint32)
            for c in cells(keys, bits):
                yield pa.RecordBatch.from_arrays([b.column(1), b.column(2), pa.array(c.astype(np.int32))], ["plane", "bit", "cell"])

    member = member.select("k", F.floor(F.col("i") / per).cast("int").alias("plane"), F.expr(f"shiftleft(1L, i % {per})").alias("bit"))
    found = member.mapInArrow(place_cells, "plane int, bit bigint, cell int").groupBy("plane", "cell").agg(F.bit_or("bit").alias("mask"))
    table = found.toArrow()  # at most 1 << bits rows a plane of up to 64 languages
    plane, cell, mask = (table.column(c).to_numpy() for c in ("plane", "cell", "mask"))
    for p, own in enumerate(planes):
        at = plane == p
        own[cell[at]] = mask[at].astype(own.dtype)
    return Model(Filters(order, planes, bits))


def identify(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, lang_pred and score of every row's whole text; see predict_languages()."""
    spark = docs.sparkSession
    held = spark.sparkContext.broadcast(model)  # a table of fixed size a plane

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hold("langid", dict)
        for b in batches:
            names, scores = held.value.predict([x.as_py() for x in b.column(1)])
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(names, pa.string()), pa.array(scores, pa.float64())], ["doc_id", "lang_pred", "score"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return with_text_bytes(docs, "doc_id").mapInArrow(run, f"doc_id {kind}, lang_pred string, score double")


def predict_languages(docs: DataFrame, per_language: int = 1500) -> DataFrame:
    """Language of every whole text, learned from at most per_language training rows a language.

    Every n-gram of a text asks the filters which languages have it; for each language the
    positives are counted and corrected for false ones, the highest count decides, of equal
    ones that of the language with more training rows, and the score is its share of all
    counts. ``und`` with score 0 for a null or empty text or one without a letter, or if there
    is no training row; a text of which no n-gram is known goes to the most frequent language
    with score 0. A very long text is counted in blocks. Repeated rows stay; an empty table
    gives no rows; other columns are ignored.
    """
    return identify(docs, fit(docs, per_language)).withColumn("held_out", held_out(F.col("doc_id")))
