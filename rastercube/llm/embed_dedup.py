"""Embedding near-duplicates: a navigable small-world graph for each shard, audited against brute force."""

from __future__ import annotations

import io
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rastercube.llm.components import connected
from rastercube.llm.shared import cut

_M = 16


class SmallWorld:
    """A hierarchical navigable small-world graph (Malkov and Yashunin) over unit vectors.

    Rows are in the order of insertion, by falling level; layer l holds the first ``sizes[l]``
    of them. Vectors are inserted in batches that are searched together, and a node's links
    are chosen for diversity: a candidate is taken if it is nearer to the node than to any
    link already taken, and free places go to the nearest of the rest. Batches grow no faster
    than the graph, and the vectors of a batch are candidates for one another.
    """

    def __init__(self, unit: np.ndarray, width: int = 48, seed: int = 3):
        n = len(unit)
        self.n = n
        levels = (-np.log(np.random.default_rng(seed).random(n)) / np.log(_M)).astype(int)
        self.order = np.argsort(-levels, kind="stable")
        self.x = np.ascontiguousarray(unit[self.order], np.float32)
        levels = levels[self.order]
        top = int(levels[0]) if n else 0
        self.sizes = [int((levels >= l).sum()) for l in range(top + 1)]
        self.links = [np.full((s, 2 * _M if l == 0 else _M), -1, np.int32) for l, s in enumerate(self.sizes)]
        self._build(width)

    @classmethod
    def of(cls, unit: np.ndarray, order: np.ndarray, sizes: list[int], links: list[np.ndarray]) -> SmallWorld:
        """A graph that was built before."""
        self = cls.__new__(cls)
        self.n, self.order, self.sizes, self.links = len(unit), order, sizes, links
        self.x = np.ascontiguousarray(unit[order], np.float32)
        return self

    def _build(self, width: int) -> None:
        n, done = self.n, 1
        while done < n:
            end = min(n, done + min(256, done))
            self._insert(done, end, width)
            done = end

    def _insert(self, a: int, b: int, width: int) -> None:
        new = np.arange(a, b)
        mates = self.x[a:b] @ self.x[a:b].T
        np.fill_diagonal(mates, -2)
        for l in range(len(self.sizes)):
            here = new[new < self.sizes[l]]
            if not len(here):
                break
            present = min(a, self.sizes[l])
            ids, sims = self._beam(self.x[here], l, width if l == 0 else _M, present)
            near = np.argsort(-mates[: len(here), : len(here)], axis=1)[:, :_M]
            ids = np.concatenate([ids, (near + a).astype(np.int64)], 1)
            sims = np.concatenate([sims, np.take_along_axis(mates[: len(here), : len(here)], near, 1)], 1)
            ids[sims < -1.5] = -1
            chosen = self._diverse(ids, sims, _M)
            self.links[l][here, :_M] = chosen
            self._back(here, chosen, l)

    def _diverse(self, ids: np.ndarray, sims: np.ndarray, most: int) -> np.ndarray:
        """For each row, up to ``most`` of its candidates (-1: none) by the diversity rule."""
        order = np.argsort(np.where(ids < 0, 3, -sims), axis=1, kind="stable")
        ids, sims = np.take_along_axis(ids, order, 1), np.take_along_axis(sims, order, 1)
        rows, k = ids.shape
        v = self.x[np.maximum(ids, 0)]
        among = v @ v.transpose(0, 2, 1)
        taken = np.zeros((rows, k), bool)
        closest = np.full((rows, k), -2, np.float32)
        for j in range(k):
            ok = (ids[:, j] >= 0) & (sims[:, j] > closest[:, j]) & (taken.sum(1) < most)
            taken[:, j] = ok
            closest = np.where(ok[:, None], np.maximum(closest, among[:, j]), closest)
        rank = np.argsort(np.where(ids < 0, 2, np.where(taken, 0, 1)), axis=1, kind="stable")[:, :most]
        out = np.take_along_axis(ids, rank, 1)
        return np.pad(out, ((0, 0), (0, most - out.shape[1])), constant_values=-1)

    def _back(self, src: np.ndarray, chosen: np.ndarray, l: int) -> None:
        """Links from the chosen nodes to src; a full node chooses again."""
        table = self.links[l]
        to, frm = chosen.ravel(), np.repeat(src, chosen.shape[1])
        to, frm = to[to >= 0], frm[to >= 0]
        if not len(to):
            return
        sim = np.einsum("ij,ij->i", self.x[to], self.x[frm])
        by = np.lexsort((-sim, to))
        to, frm = to[by], frm[by]
        nodes, first, n = np.unique(to, return_index=True, return_counts=True)
        place = np.arange(len(to)) - np.repeat(first, n)
        for at in range(0, len(nodes), 512):
            own = nodes[at : at + 512]
            lo, hi = first[at], first[at] + n[at : at + 512].sum()
            wide = min(int(n[at : at + 512].max()), 2 * _M)
            extra = np.full((len(own), wide), -1, np.int64)
            fits = place[lo:hi] < wide
            extra[(np.searchsorted(own, to[lo:hi]))[fits], place[lo:hi][fits]] = frm[lo:hi][fits]
            have = table[own].astype(np.int64)
            both = np.concatenate([have, extra], 1)
            # a node that already links back is not linked twice
            dup = (extra[:, :, None] == have[:, None, :]).any(2) & (extra >= 0)
            both[:, have.shape[1] :][dup] = -1
            over = (both >= 0).sum(1) > table.shape[1]
            if (~over).any():
                keep = np.argsort(both[~over] < 0, axis=1, kind="stable")[:, : table.shape[1]]
                table[own[~over]] = np.take_along_axis(both[~over], keep, 1)
            if over.any():
                rows = both[over]
                s = np.einsum("ikd,id->ik", self.x[np.maximum(rows, 0)], self.x[own[over]])
                table[own[over]] = self._diverse(rows, s, table.shape[1])

    def _beam(self, q: np.ndarray, layer: int, width: int, present: int) -> tuple[np.ndarray, np.ndarray]:
        """Best ``width`` of the first ``present`` nodes of a layer for each query, by beam search.

        Starts from what a walk through the higher layers finds. All queries advance together,
        each by its four best nodes that it has not expanded yet.
        """
        start = np.zeros(len(q), np.int64)
        for l in range(len(self.sizes) - 1, layer, -1):
            start = self._walk(q, start, l, min(present, self.sizes[l]))
        b = len(q)
        ids = np.full((b, width), -1, np.int64)
        sims = np.full((b, width), -3, np.float32)
        ids[:, 0] = start
        sims[:, 0] = np.einsum("ij,ij->i", q, self.x[start])
        open_ = ids >= 0
        seen = np.zeros((b, present), bool)
        seen[np.arange(b), start] = True
        stamp = np.empty(b * present, np.int32)
        active = np.arange(b)
        links = self.links[layer]
        while len(active):
            rank = np.argsort(np.where(open_[active], -sims[active], 9), axis=1, kind="stable")[:, :4]
            can = np.take_along_axis(open_[active], rank, 1)
            rows = np.repeat(active, rank.shape[1]).reshape(rank.shape)
            at = (rows[can], rank[can])
            open_[at] = False
            hop = links[ids[at]]
            who = np.repeat(at[0], hop.shape[1])
            hop = hop.ravel().astype(np.int64)
            ok = (hop >= 0) & (hop < present)
            who, hop = who[ok], hop[ok]
            fresh = ~seen[who, hop]
            who, hop = who[fresh], hop[fresh]
            # of a node that several of a query's links lead to, one stays: the last to stamp its place
            place = who * present + hop
            stamp[place] = np.arange(len(place), dtype=np.int32)
            once = stamp[place] == np.arange(len(place), dtype=np.int32)
            who, hop = who[once], hop[once]
            seen[who, hop] = True
            if len(who):
                s = np.einsum("ij,ij->i", q[who], self.x[hop])
                first = np.flatnonzero(np.concatenate([[True], who[1:] != who[:-1]]))  # queries stand in order
                rowsid, n = who[first], np.diff(np.append(first, len(who)))
                place = np.arange(len(who)) - np.repeat(first, n)
                wide = int(n.max())
                cid = np.full((len(rowsid), wide), -1, np.int64)
                cs = np.full((len(rowsid), wide), -3, np.float32)
                r = np.repeat(np.arange(len(rowsid)), n)
                cid[r, place], cs[r, place] = hop, s
                alls = np.concatenate([sims[rowsid], cs], 1)
                best = np.argpartition(-alls, width - 1, axis=1)[:, :width]
                allo = np.concatenate([open_[rowsid], cid >= 0], 1)
                alli = np.concatenate([ids[rowsid], cid], 1)
                sims[rowsid] = np.take_along_axis(alls, best, 1)
                ids[rowsid] = np.take_along_axis(alli, best, 1)
                open_[rowsid] = np.take_along_axis(allo, best, 1)
            active = active[open_[active].any(1)]
        return ids, sims

    def _walk(self, q: np.ndarray, start: np.ndarray, layer: int, present: int) -> np.ndarray:
        here, links = start.copy(), self.links[layer]
        best = np.einsum("ij,ij->i", q, self.x[here])
        active = np.arange(len(q))
        while len(active):
            hop = links[here[active]].astype(np.int64)
            ok = (hop >= 0) & (hop < present)
            s = np.where(ok, np.einsum("ikd,id->ik", self.x[np.maximum(hop, 0)], q[active]), -3)
            k = s.argmax(1)
            value = s[np.arange(len(active)), k]
            better = value > best[active]
            here[active[better]] = hop[np.arange(len(active)), k][better]
            best[active[better]] = value[better]
            active = active[better]
        return here

    def near(self, q: np.ndarray, least: float, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Pairs (query, row) with a product of at least ``least`` that beams of that width find.

        Also the queries whose beam is full of such rows: they stand in a large group, and their
        pairs are left out here.
        """
        who, rows, full = [], [], []
        width = min(width, self.n)
        step = max(1, min(256, (1 << 24) // max(1, self.n)))
        for at in range(0, len(q), step):
            ids, sims = self._beam(q[at : at + step], 0, width, self.n)
            hit = (sims >= least) & (ids >= 0)
            over = hit.all(1) & (width < self.n)
            i, k = np.nonzero(hit & ~over[:, None])
            who.append(at + i)
            rows.append(self.order[ids[i, k]])
            full.append(at + np.flatnonzero(over))
        return np.concatenate(who), np.concatenate(rows), np.concatenate(full)


def unit_rows(x: np.ndarray) -> np.ndarray:
    return x / np.sqrt((x * x).sum(1, keepdims=True))


#: Products that are held at once.
_HELD = 1 << 22


class Shard:
    """A shard's graph, vectors in double precision, ids and multiplicities."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, copies: np.ndarray, graph: SmallWorld | None = None):
        self.ids, self.copies, self.vectors, self.unit = ids, copies, vectors, unit_rows(vectors.astype(np.float64))
        self.graph = SmallWorld(self.unit) if graph is None else graph

    def write(self) -> bytes:
        """Plain arrays, with nothing that runs when they are read."""
        out = io.BytesIO()
        layers = {f"links{i}": x for i, x in enumerate(self.graph.links)}
        np.savez(out, ids=self.ids, vectors=self.vectors, copies=self.copies, order=self.graph.order, sizes=np.array(self.graph.sizes, np.int64), **layers)
        return out.getvalue()

    @classmethod
    def read(cls, data) -> Shard:
        x = np.load(io.BytesIO(data), allow_pickle=False)
        unit, sizes = unit_rows(x["vectors"].astype(np.float64)), x["sizes"].tolist()
        return cls(x["ids"], x["vectors"], x["copies"], SmallWorld.of(unit, x["order"], sizes, [x[f"links{i}"] for i in range(len(sizes))]))

    def links(self, ids: np.ndarray, vectors: np.ndarray, least: float, width: int, recall: float = 0.995) -> tuple[np.ndarray, np.ndarray, int]:
        """Pairs (query, row of the shard) that are linked, by query, and the beam width that passed the audit.

        A query whose beam is full of links stands in a large group: the products with all rows
        find its links, which is exact and costs less than wider beams. Audit: brute force lists
        the links of up to 64 queries spread over the block, and of up to 64 each of those that
        found nothing, that found fewer than 8, and that found more. Recall is a query's own
        share, so that a large group doesn't outvote pairs; its mean, among queries with fewer
        than 8 links and among the others, must be ``recall`` or more. Otherwise the block is
        searched again with beams twice as wide, in the end by brute force.
        """
        unit = unit_rows(vectors.astype(np.float64))
        while True:
            if width >= len(self.ids):
                who = row = np.zeros(0, np.int64)
                full = np.arange(len(unit))
            else:
                who, row, full = self.graph.near(unit.astype(np.float32), least - 1e-4, width)
            step = max(1, _HELD // len(self.ids))
            parts = [(who, row)]
            for at in range(0, len(full), step):
                i, r = np.nonzero(unit[full[at : at + step]] @ self.unit.T >= least - 1e-9)
                parts.append((full[at + i], r))
            who, row = (np.concatenate(x) for x in zip(*parts, strict=True))
            ok = np.zeros(len(who), bool)
            for at in range(0, len(who), _HELD // 64):
                cut_ = slice(at, at + _HELD // 64)
                ok[cut_] = np.einsum("ij,ij->i", unit[who[cut_]], self.unit[row[cut_]]) >= least
            ok &= self.ids[row] != ids[who]
            who, row = who[ok], row[ok]
            order = np.argsort(who, kind="stable")
            who, row = who[order], row[order]
            if width >= len(self.ids):
                return who, row, width
            n = np.bincount(who, minlength=len(unit))
            strata = [np.arange(len(n)), np.flatnonzero(n == 0), np.flatnonzero((n > 0) & (n < 8)), np.flatnonzero(n >= 8)]
            pick = np.unique(np.concatenate([x[np.linspace(0, len(x) - 1, min(64, len(x))).astype(np.int64)] for x in strata]))
            want = np.zeros(len(pick), np.int64)
            for at in range(0, len(pick), step):
                part = pick[at : at + step]
                want[at : at + step] = ((unit[part] @ self.unit.T >= least) & (self.ids[None, :] != ids[part][:, None])).sum(1)
            share = n[pick] / np.maximum(want, 1)
            if all(share[x].mean() >= recall for x in ((want > 0) & (want < 8), want >= 8) if x.any()):
                return who, row, width
            width *= 2


def _valid(vec: str):
    c = F.col(vec)
    good = F.forall(c, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return c.isNotNull() & good & F.exists(c, lambda x: x != 0)


def _matrix(column: pa.Array) -> np.ndarray:
    """Vectors as they are, in single or double precision."""
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def near_duplicates(vectors: DataFrame, least: float = 0.95, shards: int | None = None, blocks: int | None = None, width: int = 24, shard_bytes: int = 1 << 26) -> DataFrame:
    """vec_id, n_links, component_id, kept for every row of (vec_id, embedding).

    Equal vectors become one node with a multiplicity. Nodes are dealt into ``shards`` by a
    hash of their id; each shard's graph is built once, by one task, and written to the
    shared folder. Every node queries every shard, in ``blocks`` blocks of queries a shard:
    a task holds one graph and streams its queries, which travel in the precision they have.
    Unless they are given, there are 4 shards, and more as soon as their vectors would exceed
    shard_bytes in double precision, and enough blocks for two tasks a core, and more as soon as
    a block would exceed 8 * shard_bytes; so neither a graph nor a task outgrows its memory, and
    the work is rows x shards. What it finds is verified as a cosine in double precision. Of each
    query it emits the number of its links and of all its links a spanning forest, never the
    pairs, so a group of g near copies costs g rows a task.

    Vectors that are null, empty, zero, or hold null or non-finite components link with
    nothing, and neither do vectors of different lengths or rows without vec_id (their component_id is
    null and they are not kept). Rows that repeat both vec_id and vector are one vector; rows that
    repeat a vec_id with another vector are vectors of their own, compared with all, and each row
    gets its vector's result. An empty table gives no rows. Other columns are ignored.
    """
    spark = vectors.sparkSession
    kind = vectors.schema["embedding"].dataType.simpleString()
    kind = kind if kind == "array<float>" else "array<double>"
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast(kind).alias("e"))
    each = rows.filter(F.col("vec_id").isNotNull()).filter(_valid("e")).distinct()
    nodes = cut(each.groupBy("e").agg(F.min("vec_id").alias("least"), F.count("*").alias("copies")).withColumns({"dim": F.size("e"), "node": F.monotonically_increasing_id()}), "vectors")
    n, dim = nodes.agg(F.count("*"), F.max("dim")).first()
    shards = shards or max(4, -(-n * (dim or 0) * 8 // shard_bytes))
    blocks = blocks or max(-(-2 * spark.sparkContext.defaultParallelism // shards), -(-n * (dim or 0) // shard_bytes))
    nodes = nodes.withColumn("shard", F.pmod(F.xxhash64("node"), F.lit(shards)).cast("int"))

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held = None, []
        for b in batches:
            dims, where = b.column(0).to_numpy(), b.column(1).to_numpy()
            edge = [0, *(np.flatnonzero((dims[1:] != dims[:-1]) | (where[1:] != where[:-1])) + 1).tolist(), b.num_rows]
            for a, z in zip(edge, edge[1:], strict=False):
                if a == z:
                    continue
                k = (int(dims[a]), int(where[a]))
                if k != key and held:
                    yield graph(key, held)
                    held = []
                key = k
                part = b.slice(a, z - a)
                held.append((part.column(2).to_numpy(), _matrix(part.column(4)), part.column(3).to_numpy()))
        if held:
            yield graph(key, held)

    def graph(key, held) -> pa.RecordBatch:
        ids, vecs, copies = (np.concatenate(x) for x in zip(*held, strict=True))
        data = Shard(ids, vecs, copies).write()
        return pa.RecordBatch.from_arrays([pa.array([key[0]], pa.int32()), pa.array([key[1]], pa.int32()), pa.array([data], pa.binary())], ["dim", "shard", "graph"])

    ready = nodes.repartitionById(shards, F.col("shard")).sortWithinPartitions("dim", "shard", "node").select("dim", "shard", "node", "copies", "e")
    graphs = cut(ready.mapInArrow(build, "dim int, shard int, graph binary"), "graphs")
    block = F.pmod(F.xxhash64("node", F.lit(1)), F.lit(blocks)).cast("int")
    asks = nodes.select("dim", F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("shard"), block.alias("block"), F.lit(None).cast("binary").alias("graph"), "node", "e")
    gives = graphs.select("dim", "shard", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"), "graph", F.lit(None).cast("long").alias("node"), F.lit(None).cast(kind).alias("e"))
    tasks = gives.unionByName(asks).repartitionById(shards * blocks, F.col("shard") * blocks + F.col("block")).sortWithinPartitions("dim", F.col("node").asc_nulls_first())

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, first, wide = None, None, width
        for b in batches:
            blob = b.column(0)
            starts = [i for i in range(b.num_rows) if blob[i].is_valid] if blob.null_count < b.num_rows else []
            for a, z in zip([0, *starts], [*starts, b.num_rows], strict=True):
                if a < b.num_rows and blob[a].is_valid:
                    shard, wide = Shard.read(blob[a].as_buffer()), width
                    first = np.full(len(shard.ids), -1)
                    a += 1
                if a >= z or shard is None:
                    continue
                part = b.slice(a, z - a)
                ids = part.column(1).to_numpy(zero_copy_only=False).astype(np.int64)
                who, row, wide = shard.links(ids, _matrix(part.column(2)), least, wide)
                if not len(who):
                    continue
                asked, at = np.unique(who, return_index=True)
                u, v = [ids[asked]], [np.zeros(len(asked), np.int64)]
                n = np.add.reduceat(shard.copies[row], at)
                for i, x, y in zip(ids[asked].tolist(), at.tolist(), [*at[1:].tolist(), len(row)], strict=True):
                    # rows that nothing in this task reached before, and for the others what reached them first
                    r = row[x:y]
                    before = first[r]
                    new = r[before < 0]
                    first[new] = i
                    others = np.concatenate([shard.ids[new], np.unique(before[before >= 0])])
                    u.append(np.full(len(others), i))
                    v.append(others)
                u, v = np.concatenate(u), np.concatenate(v)
                counted = np.arange(len(u)) < len(asked)
                yield pa.RecordBatch.from_arrays([pa.array(u), pa.array(v, mask=counted), pa.array(np.concatenate([n, np.zeros(len(u) - len(n), np.int64)]))], ["u", "v", "n"])

    found = cut(tasks.select("graph", "node", "e").mapInArrow(search, "u bigint, v bigint, n bigint"), "links")
    roots = connected(found.filter("v is not null and u <> v").select("u", "v")).withColumnRenamed("node", "_n")
    degree = found.filter("v is null").groupBy("u").agg(F.sum("n").alias("n"))
    named = nodes.select("node", "e", "least", "copies").join(roots, F.col("node") == F.col("_n"), "left").withColumn("root", F.coalesce("root", "node"))
    component = named.groupBy("root").agg(F.min("least").alias("component_id")).withColumnRenamed("root", "_r")
    known = named.join(component, F.col("root") == F.col("_r")).join(degree, F.col("node") == F.col("u"), "left")
    known = known.select(F.col("e").alias("_e"), (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links"), "component_id")
    asked = F.when(F.col("vec_id").isNotNull() & _valid("e"), F.col("e"))
    out = rows.withColumn("e", asked).join(known, F.col("e") == F.col("_e"), "left")
    component = F.coalesce("component_id", "vec_id")
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"), F.coalesce(F.col("vec_id") == component, F.lit(False)).alias("kept"))
