"""The dedup and mixing stages against plain versions over rows: true similarities, null and repeated ids."""

import random

import corpus_pipeline as cp
from rastercube.llm import simhash

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def table(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def shingles(text):
    w = text.split()
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))}


def jaccard(a, b):
    a, b = shingles(a), shingles(b)
    return len(a & b) / len(a | b)


def test_dedup_stage_by_true_similarity(spark):
    """Pairs from 0.7 to 0.9: those from 0.8 up lose one, those below lose none."""
    r = random.Random(4)
    rows, want = [], set()
    passage = [f"p{i}" for i in range(40)]
    for g in range(150):
        words = [f"w{r.randrange(9000)}" for _ in range(r.randrange(100, 300))] + passage
        target, copy = 0.7 + 0.2 * g / 150, list(words)
        while jaccard(" ".join(words), " ".join(copy)) > target:
            copy[r.randrange(len(copy))] = f"v{r.randrange(9000)}"
        a, b = " ".join(words), " ".join(copy)
        rows += [(2 * g, a, "en", "s", 0), (2 * g + 1, b, "en", "s", 0)]
        close = (simhash.fingerprint(a.encode()) ^ simhash.fingerprint(b.encode())).bit_count() <= 3
        want |= {2 * g} if close or jaccard(a, b) >= 0.8 else {2 * g, 2 * g + 1}
    got = cp.one_of_each_group(spark, table(spark, rows), "").collect()
    assert sorted(x["doc_id"] for x in got) == sorted(want)


def test_dedup_stage_links_along_chains(spark):
    """Components that the first comparisons, with a shingle's least node, leave apart."""
    r = random.Random(5)
    rows, texts = [], []
    for _ in range(12):
        words = [f"w{r.randrange(9000)}" for _ in range(120)]
        for _ in range(12):
            words = list(words)
            for _ in range(r.randrange(1, 5)):
                words[r.randrange(120)] = f"v{r.randrange(9000)}"
            texts.append(" ".join(words))
            rows.append((len(rows), texts[-1], "en", "s", 0))
    fp = [simhash.fingerprint(t.encode()) for t in texts]
    root = list(range(len(texts)))
    for a in range(len(texts)):
        for b in range(a):
            if (fp[a] ^ fp[b]).bit_count() <= 3 or jaccard(texts[a], texts[b]) >= 0.8:
                lo, hi = sorted((root[a], root[b]))
                root = [lo if x == hi else x for x in root]
    got = cp.one_of_each_group(spark, table(spark, rows), "").collect()
    assert sorted(x["doc_id"] for x in got) == sorted(set(root))


def test_dedup_stage_with_null_and_repeated_ids(spark):
    r = random.Random(6)
    t = [" ".join(f"w{r.randrange(9000)}" for _ in range(80)) for _ in range(6)]
    rows = [
        *[(None, t[0], "en", "s", k) for k in range(4)],  # a component without ids: one row
        (None, t[1], "en", "s", 0), (7, t[1], "en", "s", 0),  # the row with an id
        *[(8, t[2], "en", "s", 0)] * 3,  # repeated rows: one
        (9, t[3], "en", "s", 0), (9, t[4], "en", "s", 0), (3, t[4], "en", "s", 0),  # 9 stays for t[3] only
        *[(None, t[5], "en", "s", 0)] * 2,
    ]
    got = [(x["doc_id"], x["text"]) for x in cp.one_of_each_group(spark, table(spark, rows), "").collect()]
    want = [(None, t[0]), (7, t[1]), (8, t[2]), (9, t[3]), (3, t[4]), (None, t[5])]
    assert sorted(got, key=str) == sorted(want, key=str)


def test_mixing_stage_with_null_and_repeated_ids(spark):
    r = random.Random(7)
    text = lambda: " ".join(f"w{r.randrange(900)}" for _ in range(r.randrange(5, 40)))
    rows = [(None, text(), "en", "a", 0) for _ in range(60)] + [(5, text(), "en", "a", 0) for _ in range(40)]
    rows += [(100 + k // 3, text(), "en", "b", 0) for k in range(60)] + [(900, "", "en", "a", 0), (901, None, "en", "b", 0)]
    docs = table(spark, rows)
    want = []
    for x in cp.mixing.curriculum(docs, carry=["text"]).collect():
        want += [(x["doc_id"], x["text"], x["source"])] * (len(x["positions"]) if x["size"] else 1)
    got = cp.mix_sources(spark, docs, "").collect()
    assert sorted(((x["doc_id"], x["text"], x["source"]) for x in got), key=str) == sorted(want, key=str)
    for source, goal in {(x["source"], x["target"]) for x in cp.mixing.curriculum(docs).collect()}:
        taken = sum(len((x["text"] or "").split()) for x in got if x["source"] == source)
        assert abs(taken - goal) <= 20
