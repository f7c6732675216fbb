"""Corpus operators that learn or sample, against plain versions of their parts."""

import hashlib
import math
import random
import re

import numpy as np
import pytest

from rastercube.llm import copies, langid, quality, toxicity
from rastercube.llm.shared import LOWER, Prefix, blocks, mix
from test_operators import DOCS, fold

# ---- op7 -------------------------------------------------------------------------------------


def plain_buckets(text):
    """Buckets of all words and of pairs of neighbours, one by one."""
    words = re.findall(rb"[a-z0-9\x80-\xff]+", (text or b"").translate(LOWER))
    one = [int(Prefix(np.frombuffer(w, np.uint8)).slices(np.array([0]), np.array([len(w)]))[0]) for w in words]
    two = [int(mix(np.array([a * 0x9E3779B97F4A7C15 % (1 << 64) ^ b], np.uint64))[0]) for a, b in zip(one, one[1:])]
    return [x >> (64 - quality._BITS) for x in one + two]


def test_resampling_against_plain_counts(spark):
    r = random.Random(11)
    rows = [(i, " ".join(r.choice(["tin", "oak", "élan", "Fig", "9", "sea"]) + r.choice(["", ",", "!"]) for _ in range(r.randrange(0, 25))) or None, "en", "s", 0) for i in range(120)]
    labels = [(i, int(i % 3 == 0), 0) for i in range(0, 120, 2)]
    got = {x["doc_id"]: x for x in quality.resample(spark.createDataFrame(rows, DOCS), spark.createDataFrame(labels, "doc_id long, quality int, toxic int"), share=0.3).collect()}
    raw, target = np.ones(quality.BUCKETS), np.ones(quality.BUCKETS)
    grams = {i: plain_buckets(t.encode() if t else None) for i, t, *_ in rows}
    good = {i for i, q, _ in labels if q}
    for i, g in grams.items():
        for b in g:
            raw[b] += 1
            target[b] += i in good
    keys = {}
    for i, g in grams.items():
        weight = sum(math.log(target[b] / target.sum()) - math.log(raw[b] / raw.sum()) for b in g)
        uniform = (int(hashlib.md5(f"32|{i}".encode()).hexdigest()[:15], 16) + 0.5) / (1 << 60)
        keys[i] = weight - math.log(-math.log(uniform))
        assert got[i]["n_ngrams"] == len(g) and got[i]["log_weight"] == pytest.approx(weight, abs=1e-9) and got[i]["key"] == pytest.approx(keys[i], abs=1e-9)
    assert {i for i in got if got[i]["kept"]} == set(sorted(keys, key=lambda i: -keys[i])[:36])


# ---- op8 -------------------------------------------------------------------------------------


def small_network(seed=3):
    n = toxicity.Network(seed)
    n.emb *= 10
    texts = [np.random.default_rng(seed + i).integers(0, 40, (k, 3)).astype(np.int32) for i, k in enumerate((5, 1, 0, 2, 9))]
    return n, texts, np.concatenate([[0], np.cumsum([len(t) for t in texts])])


def test_pooling_against_a_loop():
    n, texts, bounds = small_network()
    got = n.pooled(np.concatenate(texts), bounds)
    for i, t in enumerate(texts):
        x = n.emb[t].sum(1)
        for k, w in enumerate(toxicity._WIDTHS):
            for f in range(toxicity._FILTERS):
                best = 0.0
                for at in range(len(t)):
                    best = max(best, n.dense[f"bias{w}"][f] + sum(float(x[at + d] @ n.dense[f"conv{w}"][d, :, f]) for d in range(w) if at + d < len(t)))
                assert got[i, k * toxicity._FILTERS + f] == pytest.approx(best, abs=1e-4)


def test_gradients_against_finite_differences():
    n, texts, bounds = small_network()
    n.emb, n.dense = n.emb.astype(np.float64), {k: v.astype(np.float64) for k, v in n.dense.items()}
    ids, y, weight = np.concatenate(texts), np.array([1.0, 0, 1, 0, 1]), np.array([1.0, 2, 1, 1, 0.5])

    def loss():
        x = n.logits(n.pooled(ids, bounds))
        return float((weight * (np.log1p(np.exp(x)) - y * x)).mean())

    g, buckets, rows, _ = n.gradients(ids, bounds, y, weight)
    r = np.random.default_rng(1)
    for table, want in [*((n.dense[k], g[k]) for k in n.dense), (n.emb, None)]:
        for _ in range(12):
            at = tuple(r.integers(0, s) for s in table.shape) if want is not None else (buckets[r.integers(len(buckets))], r.integers(toxicity._DIM))
            old, e = table[at], 1e-3  # pooled() keeps single precision
            table[at] = old + e
            up = loss()
            table[at] = old - e
            down = loss()
            table[at] = old
            expect = want[at] if want is not None else rows[np.searchsorted(buckets, at[0]), at[1]]
            assert (up - down) / (2 * e) == pytest.approx(expect, abs=2e-3)


def test_training_alone_tells_the_classes_apart():
    r = np.random.default_rng(4)
    texts = [r.integers(0, 3000, (r.integers(20, 90), 3)).astype(np.int32) for _ in range(600)]
    y = np.arange(600) % 4 == 0
    for t, bad in zip(texts, y, strict=True):
        if bad:
            t[r.integers(len(t)), 1] = 60_000
    n = toxicity.Network()
    before = [n.logits(n.pooled(t, np.array([0, len(t)])))[0] for t in texts[500:]]
    n.train(texts[:500], y[:500].astype(float), steps=400)
    after = np.array([n.logits(n.pooled(t, np.array([0, len(t)])))[0] for t in texts[500:]])
    auc = lambda s: np.mean([(a > s[~y[500:]]).mean() for a in s[y[500:]]])
    assert auc(np.array(before)) < 0.75 and auc(after) > 0.95


def test_folds_hold_every_class():
    y = np.array([1, 0, 0, 0, 1, 0, 1, 0, 0, 0, 0])
    f = toxicity.fold_of(y, 3)
    assert sorted(f[y == 1]) == [0, 1, 2] and np.bincount(f[y == 0]).tolist() == [3, 3, 2]


def test_training_rows_are_whole_and_bounded(spark):
    rows = [(i, "x" * (1000 if i % 2 else 10), "en", "s", 0) for i in range(200)]
    labels = spark.createDataFrame([(i, 1, i % 2) for i in range(300)], "doc_id long, quality int, toxic int")
    docs = spark.createDataFrame(rows, DOCS)
    got = toxicity.training_rows(docs, labels, 50, 20_000)
    assert sum(y for *_, y in got) == 20 and len(got) == 70 and {len(t) for t, *_ in got} == {10, 1000}
    assert sum(y for *_, y in toxicity.training_rows(docs, labels, 50, 5)) == 1  # the first of a class comes whatever its length
    assert not any(fold(i) for i in range(200) if ("x" * i,) in [(t,) for t, *_ in got])


# ---- op9 -------------------------------------------------------------------------------------


def plain_model(rows, share=0.2, least=2):
    """Languages by preference, and their exact sets of n-grams."""
    count, n = {}, {}
    for text, lang in rows:
        n[lang] = n.get(lang, 0) + 1
        c = langid.normal(text)
        for i in range(len(c) - 3):
            own = count.setdefault(lang, {})
            own[c[i : i + 4]] = own.get(c[i : i + 4], 0) + 1
    order = sorted(n, key=lambda k: (-n[k], k))
    rate = {k: {g: x / sum(own.values()) for g, x in own.items()} for k, own in count.items()}
    top = {}
    for own in rate.values():
        for g, x in own.items():
            top[g] = max(top.get(g, 0), x)
    return order, {k: {g for g, x in rate[k].items() if x >= share * top[g] and count[k][g] >= least} for k in order}


def test_languages_against_exact_sets(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = docs.collect()
    train = [(r["text"].encode(), r["lang"]) for r in rows if r["text"] is not None and r["lang"] is not None and not fold(r["doc_id"])]
    order, sets = plain_model(train)
    fitted, local = langid.fit(docs).filters, langid.Model.fit(train).filters
    assert fitted.languages == local.languages == order
    assert all((a == b).all() for a, b in zip(fitted.planes, local.planes, strict=True)) and (fitted.chance == local.chance).all()
    got = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in langid.predict_languages(docs).collect()}
    for r in rows:
        c = langid.normal((r["text"] or "").encode())
        hits = [sum(c[i : i + 4] in sets[k] for i in range(len(c) - 3)) for k in order]
        if langid.has_letter((r["text"] or "").encode()) and sum(hits):
            best = max(range(len(order)), key=lambda i: (hits[i], -i))
            rest = sorted(hits)[-2] if len(hits) > 1 else 0
            assert got[r["doc_id"]][1] == pytest.approx(hits[best] / sum(hits), abs=0.05)
            if hits[best] - rest > 0.02 * len(c):  # beyond what the correction can err by
                assert got[r["doc_id"]][0] == order[best]


# ---- the pipeline's near copies --------------------------------------------------------------


def test_bitmaps_never_rule_out_a_similar_pair():
    r = np.random.default_rng(6)
    sets, n = [], []
    for base in range(40):
        ids = np.unique(r.integers(0, 1 << 62, r.integers(1, 900)).astype(np.uint64))
        for k in range(4):
            keep = ids[r.random(len(ids)) > 0.06 * k]
            sets.append(np.unique(np.concatenate([keep, r.integers(0, 1 << 62, int(0.04 * k * len(ids))).astype(np.uint64)])))
    n, bits = np.array([len(s) for s in sets]), [copies.bitmap(s) for s in sets]
    found = {(int(a), int(b)) for x, y, _ in copies.matches((n, bits), (n, bits), 0.8, block=1 << 12) for a, b in zip(x, y, strict=True)}
    close = {(a, b) for a in range(len(sets)) for b in range(len(sets)) if copies.similar(sets[a], sets[b], 0.8)}
    assert close <= found and len(found) < len(close) * 1.2 + 50


def test_near_copies_when_every_group_is_dealt_out(spark, monkeypatch):
    """A third of the rows is one family of near copies, all share a passage; groups are split as if they were huge."""
    r = random.Random(8)
    passage = [f"p{i}" for i in range(30)]
    base = [f"w{r.randrange(9000)}" for _ in range(90)]
    texts = []
    for i in range(150):
        words = list(base) if i % 3 == 0 else [f"w{r.randrange(9000)}" for _ in range(90)]
        for _ in range(r.randrange(8)):
            words[r.randrange(90)] = f"v{r.randrange(9000)}"
        texts.append(" ".join(words + passage))
    docs = spark.createDataFrame([(i, t, "en", "s", 0) for i, t in enumerate(texts)], DOCS)
    sets = [copies.shingle_set(t.encode()) for t in texts]
    fps = [copies.fingerprint(t.encode()) for t in texts]
    root = list(range(len(texts)))
    for a in range(len(texts)):
        for b in range(a):
            if copies.similar(sets[a], sets[b], 0.8) or (fps[a] ^ fps[b]).bit_count() <= 3:
                lo, hi = sorted((root[a], root[b]))
                root = [lo if x == hi else x for x in root]
    confirmed = copies.confirmed
    monkeypatch.setattr(copies, "confirmed", lambda *a: confirmed(*a, deal=5))
    monkeypatch.setattr(copies, "small", lambda df, rows=0: df)
    none = (np.zeros(0, np.uint64), np.zeros(0, np.int64), 1)
    for common in (copies.common_shingles, lambda docs: none):
        monkeypatch.setattr(copies, "common_shingles", common)
        found = copies.near_copies(docs.repartition(7), deal=7).collect()
        least = {}
        for x in found:
            least[x["component"]] = min(least.get(x["component"], 999), x["doc_id"])
        assert sorted(x["doc_id"] for x in found) == list(range(150))
        assert {x["doc_id"]: least[x["component"]] for x in found} == dict(enumerate(root))


def test_long_texts_have_the_sets_of_short_ones(monkeypatch):
    text = " ".join(f"w{i % 700}" for i in range(3000)).encode()
    whole = copies.shingle_set(text)
    monkeypatch.setattr(copies, "_SLAB", 100)
    assert (copies.shingle_set(text) == whole).all() and len(whole) == 700


def test_blocks_cover_a_text_once():
    text = b"ab cd " * 1000
    assert b"".join(t[again:] for part in blocks([text], limit=100, back=2) for _, t, again in part) == text


def test_row_key_tells_rows_apart(spark):
    rows = [("a", None), ("a", ""), (None, "a"), ("", "a"), ("1:a", "b"), ("a", "1:b"), ("a|", "b"), ("a", "|b")]
    df = spark.createDataFrame(rows, "x string, y string")
    assert df.select(copies.row_key(df).alias("k")).distinct().count() == len(rows)
