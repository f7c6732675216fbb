"""SimHash near-duplicates: 64-bit fingerprints, linked through BK-trees of pigeonhole shards."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rastercube.llm.components import connected
from rastercube.llm.shared import LOWER, cut, with_text_bytes

_BYTE_BITS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little").astype(np.int64)
#: Shingles that are counted at once: bounds the memory that one text needs.
_SLAB = 1 << 15


def bit_counts(hashes: np.ndarray) -> np.ndarray:
    """How many of the hashes have each of the 64 bits: a histogram for each byte position."""
    seen = hashes.view(np.uint8).reshape(-1, 8)
    if len(seen) < 256:
        return np.unpackbits(seen, axis=1, bitorder="little").sum(0, dtype=np.int64)
    return np.concatenate([np.bincount(seen[:, k], minlength=256) @ _BYTE_BITS for k in range(8)])


def fingerprint(text: bytes | None, width: int = 3, seed: int = 42) -> int:
    """The SimHash of a whole text: bit i is set if over half of its shingles' XXH64 have it.

    Words are runs of bytes other than ASCII white space after A-Z is lower-cased; shingles
    are ``width`` words joined by a space, repeats counted; of fewer words, one shingle of
    all of them; of none (null too), 0.
    """
    total, n = np.zeros(64, np.int64), 0
    for h in shingle_hashes(words_of(text), width, seed):
        total += bit_counts(h)
        n += len(h)
    return int(majority(total, n).view(np.uint64)[0])


def words_of(text: bytes | None) -> list[bytes]:
    return text.translate(LOWER).split() if text else []


def shingle_hashes(words: list[bytes], width: int, seed: int) -> Iterator[np.ndarray]:
    """XXH64 of the shingles of a list of words, in slabs."""
    if not words:
        return
    width, digest = min(width, len(words)), xxhash.xxh64_intdigest
    for at in range(0, len(words) - width + 1, _SLAB):
        part = words[at : at + _SLAB + width - 1]
        joined = b" ".join(part)
        ends = np.cumsum(np.fromiter(map(len, part), np.int64, len(part)) + 1) - 1
        starts = np.concatenate([[0], ends[:-1] + 1])
        got = [digest(joined[s:e], seed) for s, e in zip(starts[: len(part) - width + 1].tolist(), ends[width - 1 :].tolist(), strict=True)]
        yield np.array(got, np.uint64)


def majority(total: np.ndarray, n: int) -> np.ndarray:
    """The bits that over half of n hashes have, as bytes."""
    return np.packbits((total * 2 > n).astype(np.uint8), bitorder="little")


def fingerprints(docs: DataFrame, width: int = 3, seed: int = 42) -> DataFrame:
    """doc_id and fp (the fingerprint's 64 bits as a signed long) of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fps = np.fromiter((fingerprint(t, width, seed) for t in (x.as_py() for x in b.column(1))), np.uint64, b.num_rows)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(fps.view(np.int64))], ["doc_id", "fp"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return with_text_bytes(docs, "doc_id").mapInArrow(run, f"doc_id {kind}, fp bigint")


class BKTree:
    """A Burkhard-Keller tree of 64-bit integers under the Hamming distance.

    A node is [value, {distance: child}]; a child keyed d, and all below it, lie at distance
    d from the node's value, so by the triangle inequality a search within radius r around x
    need only follow the keys d with |d - distance(node, x)| <= r.
    """

    __slots__ = ("root",)

    def __init__(self):
        self.root = None

    def add(self, x: int) -> None:
        if self.root is None:
            self.root = [x, {}]
            return
        node = self.root
        while True:
            d = (node[0] ^ x).bit_count()
            if not d:
                return
            child = node[1].get(d)
            if child is None:
                node[1][d] = [x, {}]
                return
            node = child

    def within(self, x: int, radius: int) -> Iterator[int]:
        stack = [self.root] if self.root else []
        while stack:
            value, children = stack.pop()
            d = (value ^ x).bit_count()
            if d <= radius:
                yield value
            if children:
                if len(children) <= 2 * radius:
                    stack.extend(c for k, c in children.items() if d - radius <= k <= d + radius)
                else:
                    stack.extend(c for k in range(max(1, d - radius), d + radius + 1) if (c := children.get(k)) is not None)


def _find(parent: dict[int, int], x: int) -> int:
    while parent[x] != x:
        parent[x] = parent[parent[x]]
        x = parent[x]
    return x


def shard_links(values: list[int], radius: int) -> list[tuple[int, int]]:
    """A spanning forest of the links within one shard: (value, another) pairs, fewer than values."""
    out = []
    if len(values) == 2:
        return [(values[0], values[1])] if (values[0] ^ values[1]).bit_count() <= radius else []
    tree, parent = BKTree(), {}
    for x in values:
        if x in parent:
            continue
        parent[x] = x
        for y in tree.within(x, radius):
            a, b = _find(parent, x), _find(parent, y)
            if a != b:
                parent[max(a, b)] = min(a, b)
                out.append((x, y))
        tree.add(x)
    return out


_MASK = (1 << 64) - 1


def _cuts(lo: int, hi: int, parts: int) -> list[tuple[int, int]]:
    return [(lo + (hi - lo) * i // parts, lo + (hi - lo) * (i + 1) // parts) for i in range(parts)]


def _levels(radius: int, depth: int) -> list[list[list[tuple[int, int]]]]:
    """For each depth, what paths of bit ranges can key a shard; a path lists (low, high) ranges.

    Values within the radius agree on one of radius + 1 ranges of their bits. In a shard by
    one range, the bits outside of it are dealt out again in the same way.
    """
    out = [[[r] for r in _cuts(0, 64, radius + 1)]]
    for _ in range(depth - 1):
        nxt = []
        for path in out[-1]:
            free = [b for b in range(64) if not any(lo <= b < hi for lo, hi in path)]
            for lo, hi in _cuts(0, len(free), radius + 1):
                bits, runs = free[lo:hi], []
                for b in bits:
                    if runs and runs[-1][1] == b:
                        runs[-1] = (runs[-1][0], b + 1)
                    else:
                        runs.append((b, b + 1))
                nxt.append(path + runs)
        out.append(nxt)
    return out


def _masked(path: list[tuple[int, int]]) -> int:
    mask = 0
    for lo, hi in path:
        mask |= ((1 << hi) - 1) & ~((1 << lo) - 1)
    return mask - (1 << 64) if mask >> 63 else mask


def links(fps: DataFrame, radius: int = 3, split_above: int = 1024, depth: int = 3) -> DataFrame:
    """Pairs (u, v) of distinct fingerprints at most radius apart whose closure is that of all such pairs.

    fps: column fp (long), distinct. Fingerprints within the radius agree on one of radius + 1
    bit ranges, so each is sent to radius + 1 shards by the ranges' bits. A shard with more than
    split_above members is dealt again by the ranges of its other bits, up to ``depth`` times;
    so a hot bit pattern is spread by data, and no pair is lost. Each shard inserts its members
    into a BK-tree of its own and asks it for the neighbours of each; a spanning forest of the
    links leaves it, never all pairs. Only (key, value) pairs are shuffled; no tree is broadcast,
    since trees over all documents have no bound.
    """
    levels = _levels(radius, depth)
    branch = radius + 1
    masks = [[_masked(p) for p in lv] for lv in levels]
    keyed = None
    wave = fps.select("fp", F.explode(F.array(*[F.struct(F.lit(i).alias("p"), F.col("fp").bitwiseAND(F.lit(m)).alias("k")) for i, m in enumerate(masks[0])])).alias("s")).select("fp", "s.*")
    for d in range(depth):
        if d == depth - 1:
            done = wave
        else:
            big = wave.groupBy("p", "k").agg(F.count("*").alias("n")).filter(F.col("n") > split_above).select("p", "k", F.lit(True).alias("big"))
            marked = wave.join(big, ["p", "k"], "left")
            done = marked.filter("big is null").drop("big")
            table = F.array(*[F.lit(m) for m in masks[d + 1]])
            child = F.expr(f"explode(transform(sequence(0, {branch - 1}), i -> cast(p * {branch} + i as int)))")
            wave = marked.filter("big").select("fp", child.alias("p")).select("fp", "p", F.col("fp").bitwiseAND(F.element_at(table, F.col("p") + 1)).alias("k"))
        done = done.select("fp", F.lit(d).alias("d"), "p", "k")
        keyed = done if keyed is None else keyed.unionByName(done)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, key = [], None
        for b in batches:
            found: list[tuple[int, int]] = []
            dpk = np.stack([b.column(i).to_numpy(zero_copy_only=False).astype(np.int64) for i in (1, 2, 3)])
            fp = b.column(0).to_numpy().view(np.uint64)
            at = np.flatnonzero(np.any(dpk[:, 1:] != dpk[:, :-1], axis=0)) + 1
            ends = [*at.tolist(), b.num_rows]
            start = 0
            for e in ends:
                k = tuple(dpk[:, start].tolist())
                if k != key:
                    if len(held) > 1:
                        found += shard_links(held, radius)
                    held, key = [], k
                if e - start > 1 or held or e == b.num_rows:
                    held += fp[start:e].tolist()
                start = e
            if found:
                yield pairs(found)
        if len(held) > 1:
            yield pairs(shard_links(held, radius))

    def pairs(found: list[tuple[int, int]]) -> pa.RecordBatch:
        a = np.array(found, np.uint64).reshape(-1, 2).view(np.int64)
        return pa.RecordBatch.from_arrays([pa.array(a[:, 0].copy()), pa.array(a[:, 1].copy())], ["u", "v"])

    return keyed.repartition("d", "p", "k").sortWithinPartitions("d", "p", "k", "fp").mapInArrow(run, "u bigint, v bigint")


def near_duplicates(docs: DataFrame, width: int = 3, radius: int = 3, seed: int = 42) -> DataFrame:
    """doc_id, fp and component_id of every row: the least doc_id reachable over linked fingerprints.

    Equal fingerprints are one node, so copies cost one row in the search however many they
    are. Null and empty texts have the fingerprint 0 and are linked like any other; a very long
    text is hashed whole, in slabs; a bit that exactly half of the shingles have is 0; repeated
    rows stay; of equal doc_ids the component is one all the same; a null doc_id is never the least unless its component has no other; an empty
    table gives no rows. Other columns are ignored.
    """
    fps = cut(fingerprints(docs, width, seed), "fingerprints")
    nodes = cut(fps.groupBy("fp").agg(F.min("doc_id").alias("rep")), "nodes")
    roots = connected(links(nodes.select("fp"), radius))
    named = nodes.join(roots, nodes["fp"] == roots["node"], "left").select(nodes["fp"], "rep", F.coalesce("root", nodes["fp"]).alias("root"))
    least = named.groupBy("root").agg(F.min("rep").alias("component_id"))
    of = named.join(least, "root").select(F.col("fp").alias("_fp"), "component_id")
    return fps.join(of, fps["fp"] == of["_fp"]).select("doc_id", "fp", "component_id")


def hex16(fp):
    return F.lpad(F.lower(F.hex(fp)), 16, "0")
