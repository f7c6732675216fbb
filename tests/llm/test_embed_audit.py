"""The recall audit of op1: a hot group doesn't hide that pairs are missed."""

import numpy as np

from rastercube.llm.embed_dedup import Shard, near_duplicates


def test_audit_sees_missed_pairs_beside_a_hot_group():
    r = np.random.default_rng(2)
    hot = r.normal(size=32) + 0.01 * r.normal(size=(400, 32))
    pairs = np.repeat(r.normal(size=(400, 32)), 2, axis=0) + 0.001 * r.normal(size=(800, 32))
    x = np.concatenate([hot, pairs])
    ids = np.arange(len(x))
    shard = Shard(ids, x, np.ones(len(x), np.int64))
    found = shard.graph.near

    def near(q, least, width):
        """Misses the pairs as long as beams are narrow."""
        who, row, full = found(q, least, width)
        n = np.bincount(who, minlength=len(q))
        ok = (n[who] > 2) | (width > 100)
        return who[ok], row[ok], full

    shard.graph.near = near
    who, _, width = shard.links(ids, x, 0.95, 24)
    assert width > 100
    assert np.bincount(who, minlength=len(x)).tolist() == [399] * 400 + [1] * 800


def test_cosines_at_the_threshold():
    """A cosine of exactly 0.95 links; the next ones below it don't."""
    c = 0.95
    base = np.array([1.0, 0.0, 0.0])
    rows = [base] + [np.array([x, np.sqrt(1 - x * x), 0.0]) for x in (c + 1e-12, c - 1e-7, c - 1e-5, 0.9)]
    rows.append(np.array([19.0, np.sqrt(400 - 361), 0.0]))
    x = np.array(rows)
    unit = x / np.sqrt((x * x).sum(1, keepdims=True))
    want = {(i, j) for i in range(len(x)) for j in range(len(x)) if i != j and np.einsum("i,i", unit[i], unit[j]) >= c}
    who, row, _ = Shard(np.arange(len(x)), x, np.ones(len(x), np.int64)).links(np.arange(len(x)), x, c, 24)
    assert set(zip(who.tolist(), row.tolist(), strict=True)) == want and (0, 1) in want and (0, 2) not in want


def test_shards_are_written_as_plain_arrays():
    r = np.random.default_rng(3)
    x = r.normal(size=(300, 8)).astype(np.float32)
    one = Shard(np.arange(300), x, np.ones(300, np.int64))
    two = Shard.read(one.write())
    assert two.vectors.dtype == np.float32 and all((a == b).all() for a, b in zip(one.graph.links, two.graph.links, strict=True))
    a, b = (s.links(np.arange(300), x, 0.8, 24) for s in (one, two))
    assert a[2] == b[2] and all((p == q).all() for p, q in zip(a[:2], b[:2], strict=True))


def test_many_shards_and_blocks_give_the_same(spark):
    """Beyond the usual number of shards and blocks, with a family of a third of all, copies and repeated ids."""
    r = np.random.default_rng(5)
    hot = r.normal(size=12) + 0.02 * r.normal(size=(130, 12))
    x = np.concatenate([hot, r.normal(size=(260, 12))]).astype(np.float32)
    x[200:230] = x[230:260] * 2
    rows = [(i, v.tolist()) for i, v in enumerate(x)] + [(7, (-x[7]).tolist()), (7, x[7].tolist())]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    e = np.array([v for _, v in rows], np.float32).astype(np.float64)
    unit, who = e / np.sqrt((e * e).sum(1, keepdims=True)), [i for i, _ in rows]
    link = unit @ unit.T >= 0.95
    n, root = [], list(range(len(rows) - 1))
    for i in root:
        n.append(int(link[i, :-1].sum()) - 1)
    for i in range(len(root)):
        for j in np.flatnonzero(link[i, :-1]):
            lo, hi = sorted((root[i], root[j]))
            root = [lo if k == hi else k for k in root]
    least = {k: min(who[i] for i in range(len(root)) if root[i] == k) for k in set(root)}
    want = sorted([(who[i], n[i], least[root[i]]) for i in range(len(root))] + [(7, n[7], least[root[7]])])
    for shards, blocks in ((None, None), (23, 5)):
        got = near_duplicates(df, shards=shards, blocks=blocks).collect()
        assert sorted((x["vec_id"], x["n_links"], x["component_id"]) for x in got) == want
