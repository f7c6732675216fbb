"""Near copies of documents: fingerprints within a few bits, or shingle sets of a Jaccard similarity.

Sets of at least the similarity share a shingle of their prefixes (Chaudhuri et al., 2006), so
the prefixes' shingles deal the documents into groups that lose no pair; bitmaps of the sets
rule out most pairs of a group without loss, and the texts' sets decide.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rastercube.llm.components import connected
from rastercube.llm.shared import Prefix, cut, hold, mix, small, with_text_bytes
from rastercube.llm.simhash import fingerprint, links, words_of

#: Words that are hashed at once, and the narrowest and widest bitmaps in bits.
_SLAB, _NARROW, _WIDE = 1 << 15, 64, 1 << 17
_SLACK = 1e-9


def shingle_set(text: bytes | None, width: int = 5) -> np.ndarray:
    """64-bit hashes of a text's distinct shingles of ``width`` words, rising; of fewer words, one of all."""
    words = words_of(text)
    if not words:
        return np.zeros(0, np.uint64)
    width, out = min(width, len(words)), []
    for at in range(0, len(words) - width + 1, _SLAB):
        part = words[at : at + _SLAB + width - 1]
        ends = np.cumsum(np.fromiter(map(len, part), np.int64, len(part)) + 1) - 1
        starts = np.concatenate([[0], ends[:-1] + 1])
        out.append(Prefix(np.frombuffer(b" ".join(part), np.uint8)).slices(starts[: len(part) - width + 1], ends[width - 1 :]))
    return np.unique(np.concatenate(out))


def similar(a: np.ndarray, b: np.ndarray, similarity: float) -> bool:
    """Whether two shingle sets have at least that Jaccard similarity."""
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both >= similarity * (len(a) + len(b) - both) - _SLACK


def prefix(ids: np.ndarray, common: np.ndarray, count: np.ndarray, similarity: float) -> np.ndarray:
    """The first shingles of a set in an order that all sets share: rare before common, then by hash.

    Sets of at least that similarity share ceil(similarity * n) shingles of either set's n, so
    in any such order the first n - ceil(similarity * n) + 1 of both have one in common.
    """
    n = len(ids) - math.ceil(similarity * len(ids) - _SLACK) + 1
    if not len(common):
        return ids[:n]
    at = np.minimum(np.searchsorted(common, ids), len(common) - 1)
    return ids[np.argsort(np.where(common[at] == ids, count[at], 0), kind="stable")[:n]]


def bitmap(ids: np.ndarray) -> np.ndarray:
    """The parity of the shingles that fall on each bit; four to eight bits a shingle.

    Two bitmaps differ in no more bits than their sets in shingles, also when the wider one
    is folded onto the other's width.
    """
    width = min(_WIDE, max(_NARROW, 4 << (len(ids) - 1).bit_length() if len(ids) else 0))
    odd = np.bincount((ids % np.uint64(width)).astype(np.int64), minlength=width) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").view(np.uint64)


def fold(bits: np.ndarray, words: int) -> np.ndarray:
    """Bitmaps (rows, 64-bit words) on fewer words."""
    return np.bitwise_xor.reduce(bits.reshape(len(bits), -1, words), axis=1)


def possible(n: np.ndarray, m: np.ndarray, apart: np.ndarray, similarity: float) -> np.ndarray:
    """Whether sets of n and m shingles can be similar if they differ in at least ``apart`` of them."""
    return (np.minimum(n, m) >= similarity * np.maximum(n, m) - _SLACK) & (apart <= (1 - similarity) / (1 + similarity) * (n + m) + 1e-6)


def matches(own: tuple, others: tuple, similarity: float, block: int = 1 << 19) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Row numbers of the pairs of (n, bitmaps) lists that sizes and bitmaps allow, and in how many bits they differ; none is lost."""
    wide = [np.array([len(b) for b in bits], np.int64) for _, bits in (own, others)]
    for w in np.unique(np.concatenate(wide)).tolist():
        # pairs of which the narrower bitmap has w words; sizes beyond the similarity need no look
        most = w * 2 if similarity > 0.5 else _WIDE
        pick = [np.flatnonzero((x >= w) & (x <= most)) for x in wide]
        if not (len(pick[0]) and len(pick[1])):
            continue
        flat = [np.stack([fold(bits[i][None], w)[0] for i in p]) for (_, bits), p in zip((own, others), pick, strict=True)]
        n, m = own[0][pick[0]], others[0][pick[1]]
        step = max(1, block // max(1, flat[1].size))
        for at in range(0, len(n), step):
            apart = np.bitwise_count(flat[0][at : at + step, None, :] ^ flat[1][None]).sum(2, dtype=np.int64)
            ok = possible(n[at : at + step, None], m[None], apart, similarity)
            ok &= (wide[0][pick[0][at : at + step]] == w)[:, None] | (wide[1][pick[1]] == w)[None]
            x, y = np.nonzero(ok)
            yield pick[0][at + x], pick[1][y], apart[x, y]


def row_key(docs: DataFrame):
    """128 bits of a hash of all columns: rows with equal keys are equal."""
    parts = []
    for c in docs.columns:
        text = F.col(c).cast("string")
        parts.append(F.coalesce(F.concat(F.length(text).cast("string"), F.lit(":"), text), F.lit("-")))
    return F.unhex(F.md5(F.concat_ws("|", *parts).cast("binary")))


def _longs(x) -> pa.Array:
    return pa.array(np.ascontiguousarray(x).view(np.int64))


def _batch(columns: dict) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(list(columns.values()), list(columns))


def common_shingles(docs: DataFrame, share: int = 64, floor: int = 5000, least: int = 3, most: int = 1 << 19) -> tuple[np.ndarray, np.ndarray, int]:
    """Shingles that several of a sample of the documents have, rising, how many have them, and its size.

    The sample is every ``share``-th row by hash, but about ``floor`` rows of a smaller table;
    of its shingles the ``most`` frequent come to the driver. They only order prefix()'s
    shingles, so that a passage or line that many documents have does not make candidates of
    them all, and say which shingles to deal out twice; no result depends on the sample.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hold("copies", dict)
        for b in batches:
            for t in b.column(0):
                yield _batch({"h": _longs(shingle_set(t.as_py()))})

    rows = docs.count()
    every = max(1, min(share, rows // floor))
    some = with_text_bytes(docs.filter(F.pmod(F.xxhash64(F.lit(7), *docs.columns), F.lit(every)) == 0))
    seen = some.mapInArrow(run, "h bigint").groupBy("h").agg(F.count("*").alias("n")).filter(F.col("n") >= least)
    got = seen.orderBy(F.col("n").desc(), "h").limit(most).toArrow()
    h, n = got.column("h").to_numpy().view(np.uint64), got.column("n").to_numpy()
    order = np.argsort(h)
    return h[order], n[order], max(1, rows // every)


def set_rows(docs: DataFrame, similarity: float, common, width: int = 3) -> DataFrame:
    """key (row_key()), doc_id, node, fp and, where a task meets a node first, n, bits, narrow and head of its set.

    A node is a fingerprint with a shingle set, numbered by the task that met it: copies
    that one task reads are one node, so a large group of them is dealt out once a task. n is
    the number of shingles, bits the bitmap, narrow the same on a quarter of its bits, ``head`` the
    prefix.
    """
    schema = f"key binary, doc_id {docs.schema['doc_id'].dataType.simpleString()}, node bigint, fp bigint, n bigint, bits binary, narrow binary, head array<bigint>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        hold("copies", dict)
        first, seen = TaskContext.get().partitionId() << 33, {}
        table, count = common.value
        for b in batches:
            fps, nodes, n, bits, narrow, head = [], [], [], [], [], []
            for t in (x.as_py() for x in b.column(2)):
                ids = shingle_set(t)
                fps.append(fingerprint(t, width))
                name = (fps[-1], xxhash.xxh3_128_digest(ids.tobytes()))
                fresh = name not in seen
                nodes.append(seen.setdefault(name, first + len(seen)))
                n.append(len(ids) if fresh else None)
                wide = bitmap(ids) if fresh else None
                bits.append(wide.tobytes() if fresh else None)
                narrow.append(fold(wide[None], max(1, len(wide) // 4)).tobytes() if fresh else None)
                head.append(prefix(ids, table, count, similarity).view(np.int64) if fresh else None)
            yield _batch({"key": b.column(0), "doc_id": b.column(1), "node": pa.array(nodes, pa.int64()), "fp": _longs(np.array(fps, np.uint64)), "n": pa.array(n, pa.int64()), "bits": pa.array(bits, pa.binary()), "narrow": pa.array(narrow, pa.binary()), "head": pa.array(head, pa.list_(pa.int64()))})

    return with_text_bytes(docs.withColumn("key", row_key(docs)), "key", "doc_id").mapInArrow(run, schema)


def groups(nodes: DataFrame, hot: np.ndarray, deals: int = 64) -> DataFrame:
    """(k, node, first): the nodes of each shingle that several nodes' prefixes have, and one of them.

    A shingle's nodes arrive sorted and leave as they come, so none is held but the first. Hot
    shingles are dealt into ``deals`` parts; their parts' first nodes then meet.
    """
    k = nodes.select("node", F.explode("head").alias("k"))
    if len(hot):
        # of bounded length: those of common_shingles() that over a hundredth of its sample have
        part = F.when(F.col("k").isin(hot.view(np.int64).tolist()), F.pmod(F.xxhash64("node"), F.lit(deals))).otherwise(0).cast("int")
    else:
        part = F.lit(0)
    k = k.withColumn("part", part)
    keep = set(hot.view(np.int64).tolist())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = None
        for b in batches:
            k, part, node = (b.column(i).to_numpy() for i in (0, 1, 2))
            same = (k[1:] == k[:-1]) & (part[1:] == part[:-1])
            # only rows next to one of the same group matter, and those at the batch's ends
            near = np.concatenate([[True], same]) | np.concatenate([same, [True]])
            if keep:
                near |= np.isin(k, hot.view(np.int64))
            out = []
            for x, p, y in zip(k[near].tolist(), part[near].tolist(), node[near].tolist(), strict=True):
                if last is None or (x, p) != last[:2]:
                    if x in keep:
                        out.append((x, y, y))
                    last, alone = (x, p, y), x not in keep
                else:
                    if alone:
                        out.append((x, last[2], last[2]))
                        alone = False
                    out.append((x, y, last[2]))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out, strict=True)], ["k", "node", "first"])

    return k.select("k", "part", "node").repartition("k", "part").sortWithinPartitions("k", "part", "node").mapInArrow(run, "k bigint, node bigint, first bigint")


def plausible(pairs: DataFrame, nodes: DataFrame, similarity: float) -> DataFrame:
    """The pairs (u, v) that sizes and bitmaps allow."""
    size = lambda c: nodes.select(F.col("node").alias(c), F.col("n").alias(f"n_{c}"), F.col("bits").alias(f"b_{c}"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            u, v, n, m = (b.column(i).to_numpy() for i in range(4))
            ok = []
            for i, (x, y) in enumerate(zip(b.column(4), b.column(5), strict=True)):
                x, y = (np.frombuffer(z.as_buffer(), np.uint64)[None] for z in (x, y))
                w = min(x.shape[1], y.shape[1])
                ok.append(possible(n[i], m[i], np.bitwise_count(fold(x, w) ^ fold(y, w)).sum(), similarity))
            ok = np.array(ok, bool)
            yield _batch({"u": pa.array(u[ok]), "v": pa.array(v[ok])})

    sized = pairs.join(size("u"), "u").join(size("v"), "v").filter(F.least("n_u", "n_v") >= similarity * F.greatest("n_u", "n_v") - _SLACK)
    return sized.select("u", "v", "n_u", "n_v", "b_u", "b_v").mapInArrow(run, "u bigint, v bigint")


def confirmed(docs: DataFrame, nodes: DataFrame, pairs: DataFrame, similarity: float, deal: int = 512) -> DataFrame:
    """The pairs (u, v) whose shingle sets, from their texts, have at least that Jaccard similarity.

    Texts that no pair asks for are not moved. The set of u goes to where that of v is; a v
    with more than ``deal`` partners is in several places.
    """
    many = pairs.groupBy("v").agg(F.ceil(F.count("*") / deal).cast("int").alias("places"))
    near = pairs.join(many, "v").select("u", "v", F.pmod(F.xxhash64("u"), F.col("places")).cast("int").alias("place"))
    asks = near.select(F.col("u").alias("node"), "v", "place").unionByName(many.select(F.col("v").alias("node"), "v", F.explode(F.sequence(F.lit(0), F.col("places") - 1)).alias("place")))
    asks = cut(asks.join(nodes.select("node", F.col("key").alias("_key")), "node"), "asks")
    texts = docs.withColumn("key", row_key(docs)).join(small(asks), F.col("key") == F.col("_key"))

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hold("copies", dict)
        last, ids = None, b""
        for b in batches:
            node, v, place = (b.column(i).to_numpy() for i in range(3))
            at, sets, held = 0, [], 0
            for i, t in enumerate(b.column(3)):
                if node[i] != last:
                    last, ids = node[i], shingle_set(t.as_py()).tobytes()
                sets.append(ids)
                held += len(ids)
                if held > 1 << 22 or i == b.num_rows - 1:
                    cutout = slice(at, i + 1)
                    yield _batch({"v": pa.array(v[cutout]), "place": pa.array(place[cutout]), "u": pa.array(node[cutout]), "ids": pa.array(sets, pa.binary())})
                    at, sets, held = i + 1, [], 0

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, mine = None, None
        for b in batches:
            out = []
            for v, place, u, ids in zip(*(b.column(i) for i in range(4)), strict=True):
                v, u, ids = (v.as_py(), place.as_py()), u.as_py(), np.frombuffer(ids.as_buffer(), np.uint64)
                if u == v[0]:
                    at, mine = v, ids.copy()
                elif v == at and similar(mine, ids, similarity):
                    out.append((u, v[0]))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out, strict=True)], ["u", "v"])

    sent = with_text_bytes(texts, "node", "v", "place").mapInArrow(send, "v bigint, place int, u bigint, ids binary")
    dealt = sent.withColumn("other", F.col("u") != F.col("v")).repartition("v", "place").sortWithinPartitions("v", "place", "other").drop("other")
    return dealt.mapInArrow(compare, "u bigint, v bigint").distinct()


def mixed(live: DataFrame, roots: DataFrame, deal: int) -> DataFrame:
    """k, node, root, family, parts of the groups that hold several components; of groups of the same nodes, one.

    family is the root of a group's largest component, whose nodes are its main ones. A group
    that isn't here will never be, since components only grow.
    """
    of = live.select("k", "node").join(roots.withColumnRenamed("node", "_n"), F.col("node") == F.col("_n"), "left").select("k", "node", F.coalesce("root", "node").alias("root")).distinct()
    of = cut(of, "members")
    held = of.groupBy("k", "root").agg(F.count("*").alias("c"), F.sum(F.xxhash64("node").cast("decimal(38,0)")).alias("h"), F.sum(F.xxhash64("node", F.lit(1)).cast("decimal(38,0)")).alias("i"))
    held = held.groupBy("k").agg(F.max_by("root", F.struct("c", "root")).alias("main"), F.sum("c").alias("members"), F.count("*").alias("roots"), F.sum("h").alias("h"), F.sum("i").alias("i")).filter("roots > 1")
    once = held.groupBy("h", "i", "members").agg(F.min(F.struct("k", "main")).alias("_")).select(F.col("_.k").alias("_k"), F.col("_.main").alias("family"), "members")
    # as many parts for all groups of a family, so that a pair meets in the same part of each
    most = once.groupBy("family").agg(F.ceil(F.max("members") / deal).cast("int").alias("parts")).withColumnRenamed("family", "_f")
    once = once.join(most, F.col("family") == F.col("_f")).select("_k", "family", "parts")
    rows = of.join(once, F.col("k") == F.col("_k")).select("k", "node", "root", "family", "parts")
    return cut(rows, "mixed")


def across(rows: DataFrame, nodes: DataFrame, similarity: float, pick: int | None = None) -> DataFrame:
    """Pairs (u, v), u > v, of nodes of one group in different components that sizes and narrow bitmaps allow.

    rows: mixed(). With ``pick``, one pair for each node that is not main: the closest by
    bitmaps for 0, else one by a hash of the pair and pick; without, all pairs. The main nodes
    meet only the others, so a linked group costs nothing. A group of several parts is dealt
    out: in each part some nodes meet all others that are not main. The groups of a family go to
    one place, a part at a time, and there a pair leaves once, however many shingles it shares.
    """
    own = F.pmod(F.xxhash64("node"), F.col("parts")).cast("int")
    rows = rows.withColumn("main", F.col("root") == F.col("family")).withColumn("own", own).withColumn("part", F.explode(F.when(F.col("main"), F.array("own")).otherwise(F.sequence(F.lit(0), F.col("parts") - 1))))
    rows = rows.join(nodes.select(F.col("node").alias("_n"), "n", "narrow"), F.col("node") == F.col("_n")).select("family", "part", "k", "node", "root", "main", (F.col("own") == F.col("part")).alias("own"), "n", "narrow")

    def meet(held: list[tuple]) -> Iterator[pa.RecordBatch]:
        node, root, main, own, n, bits = zip(*held, strict=True)
        node, root, main, own, n = np.array(node), np.array(root), np.array(main), np.array(own), np.array(n)
        x, y = np.flatnonzero(own), np.flatnonzero(~main)
        best = np.zeros((3, 0), np.int64)  # node's number, rank of its pair, the other's number
        for a, b, apart in matches((n[x], [bits[i] for i in x]), (n[y], [bits[i] for i in y]), similarity):
            a, b = x[a], y[b]
            ok = (root[a] != root[b]) & (main[a] | (node[a] < node[b]))
            a, b, apart = a[ok], b[ok], apart[ok]
            if pick is None:
                if len(a):
                    yield pairs(node[a], node[b])
                continue
            rank = apart if pick == 0 else (mix((node[a] ^ node[b]).view(np.uint64) * np.uint64(2 * pick + 1)) >> np.uint64(2)).astype(np.int64)
            best = np.concatenate([best, [b, rank, a], [a[~main[a]], rank[~main[a]], b[~main[a]]]], axis=1)
            best = best[:, np.lexsort(best[1::-1])]
            best = best[:, np.concatenate([[True], best[0, 1:] != best[0, :-1]])] if best.shape[1] else best
        if best.shape[1]:
            yield pairs(node[best[0]], node[best[2]])

    def pairs(a: np.ndarray, b: np.ndarray) -> pa.RecordBatch:
        return _batch({"u": pa.array(np.maximum(a, b)), "v": pa.array(np.minimum(a, b))})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hold("copies", dict)
        key, held, left = None, [], set()
        for b in batches:
            k = list(zip(*(b.column(i).to_pylist() for i in range(3)), strict=True))
            rest = zip(*(b.column(i).to_pylist() for i in range(3, 8)), (np.frombuffer(x.as_py(), np.uint64) for x in b.column(8)), strict=True)
            for x, row in zip(k, rest, strict=True):
                if x != key:
                    if len(held) > 1:
                        yield from once(meet(held), left)
                    if key is None or x[:2] != key[:2]:
                        left = set()
                    key, held = x, []
                held.append(row)
        if len(held) > 1:
            yield from once(meet(held), left)

    def once(found: Iterator[pa.RecordBatch], left: set) -> Iterator[pa.RecordBatch]:
        for b in found:
            new = list(dict.fromkeys(p for p in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True) if p not in left))
            left.update(new)
            if new:
                yield _batch({"u": pa.array([u for u, _ in new], pa.int64()), "v": pa.array([v for _, v in new], pa.int64())})

    dealt = rows.repartition("family", "part").sortWithinPartitions("family", "part", "k", "node")
    return dealt.mapInArrow(run, "u bigint, v bigint").distinct()


def near_copies(docs: DataFrame, similarity: float = 0.8, radius: int = 3, deal: int = 4096) -> DataFrame:
    """key, doc_id and component of every row, over links of two kinds.

    key is row_key(): equal rows have one, others have their own. component is the same number
    for the rows of a component, whatever their doc_id.

    Fingerprints (three-word shingles) within radius bits, as simhash.near_duplicates() has
    them, and sets of five-word shingles with a Jaccard similarity of at least ``similarity``.
    First every node is held against the node that most of its prefix's groups begin with.
    Then, where a shingle's nodes are not yet one component, nodes of different components
    are held against one another: bitmaps first, and what these leave by the texts' sets. Two
    rounds take one pair a node from some groups, which joins most of what belongs together; the
    last takes all pairs of all groups that are left, so no link is lost, whatever their size. ``deal`` nodes of a
    group meet the others in one task.

    Null and empty texts have no shingles and the fingerprint 0, and are linked like any other;
    a text of fewer than five words has one shingle; a long text is hashed in slabs. Rows that
    repeat are one node in a task and linked by their fingerprint across tasks. Ties, of equal
    counts or first nodes, change which pairs are compared, not what is linked. An empty table
    gives no rows. All columns enter the key, and no name clashes.
    """
    spark = docs.sparkSession
    h, n, sample = common_shingles(docs)
    hot = h[n >= max(3, sample // 100)]
    common = spark.sparkContext.broadcast((h, n))  # at most as many shingles as common_shingles() gives
    rows = cut(set_rows(docs, similarity, common), "set-rows")
    common.destroy()
    nodes = rows.filter("n is not null").select("node", "fp", "n", "bits", "narrow", "key", "head")
    head = cut(nodes.groupBy("fp").agg(F.min("node").alias("head")), "fingerprint-heads")
    same = nodes.select("node", "fp").join(head, "fp").select(F.col("node").alias("u"), F.col("head").alias("v"))
    near = links(head.select("fp"), radius)
    a, b = head.select(F.col("fp").alias("_a"), F.col("head").alias("_u")), head.select(F.col("fp").alias("_b"), F.col("head").alias("_v"))
    near = near.join(a, near["u"] == F.col("_a")).join(b, F.col("v") == F.col("_b")).select(F.col("_u").alias("u"), F.col("_v").alias("v"))

    live = cut(groups(nodes.select("node", "head"), hot), "groups")
    nodes = nodes.drop("head")
    least = live.groupBy("k").agg(F.min("first").alias("_m"), F.max("first").alias("_x")).filter("_m < _x").select(F.col("k").alias("_k"), "_m")
    firsts = live.select("k", "first").distinct().join(small(least), F.col("k") == F.col("_k")).select(F.col("first").alias("node"), F.col("_m").alias("first"))
    most = live.groupBy("node", "first").agg(F.count("*").alias("c")).unionByName(firsts.groupBy("node", "first").agg(F.count("*").alias("c"))).filter("node <> first")
    star = most.groupBy("node").agg(F.max_by("first", F.struct("c", "first")).alias("v")).select(F.greatest("node", "v").alias("u"), F.least("node", "v").alias("v")).distinct()
    known = cut(same.unionByName(near).filter("u <> v"), "fingerprint-links")
    tested = cut(plausible(star, nodes, similarity), "star-pairs")
    roots = connected(known.unionByName(confirmed(docs, nodes, tested, similarity)))

    for pick in (0, 1, None):
        live = mixed(live, roots, deal)
        if live.isEmpty():
            break
        # in the rounds every eighth shingle will do: near copies share many
        some = live if pick is None else live.filter(F.pmod(F.xxhash64("k", F.lit(pick)), F.lit(8)) == 0)
        fresh = plausible(across(some, nodes, similarity, pick).join(tested, ["u", "v"], "left_anti"), nodes, similarity)
        fresh = cut(fresh, "cross-pairs")
        found = confirmed(docs, nodes, fresh, similarity)
        roots = cut(connected(roots.select(F.col("node").alias("u"), F.col("root").alias("v")).unionByName(found)), "roots")
        tested = tested.unionByName(fresh)
    of = roots.select(F.col("node").alias("_node"), "root")
    return rows.join(of, rows["node"] == of["_node"], "left").select("key", "doc_id", F.coalesce("root", rows["node"]).alias("component"))


def one_of_each(docs: DataFrame, similarity: float = 0.8, radius: int = 3) -> DataFrame:
    """Of each component of near_copies(), the row with the least doc_id, nulls last, then the least row_key().

    Of wholly equal rows one stays. The rows that go are told from a list of their keys, which
    is broadcast if a count finds it short, so the texts are moved only if it is long.
    """
    found = cut(near_copies(docs, similarity, radius), "components")
    first = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "key")).alias("_first")
    kept = found.groupBy("component").agg(first).select(F.col("_first.key").alias("_kept"))
    times = found.groupBy("key").agg(F.count("*").alias("_n"))
    gone = times.join(kept, F.col("key") == F.col("_kept"), "left").filter("_kept is null or _n > 1").select(F.col("key").alias("_gone"), F.col("_kept").isNotNull().alias("_again"))
    gone = cut(gone, "gone")
    rows = docs.withColumn("_key", row_key(docs))
    stay = rows.join(small(gone), F.col("_key") == F.col("_gone"), "left_anti")
    again = gone.filter("_again").select("_gone")
    once = rows.join(small(again), F.col("_key") == F.col("_gone")).groupBy("_key").agg(*[F.first(c).alias(c) for c in docs.columns])
    return stay.select(*docs.columns).unionByName(once.select(*docs.columns))
