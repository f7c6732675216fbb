"""The pipeline's stages and its result against a plain version of each."""

import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline as cp
from rastercube.llm import decontam, mixing, simhash, toxicity
from rastercube.llm.shared import LOWER, tokenizer_path

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    """The table before each stage, and the last result."""
    tables = [spark.read.parquet(f"{SF}/documents.parquet")]
    for _, f in cp.STAGES:
        tables.append(cp.cut(f(spark, tables[-1], SF), "t"))
    return tables


def ids(df):
    return sorted(r["doc_id"] for r in df.select("doc_id").collect())


def test_names_and_columns(stages):
    assert [n for n, _ in cp.STAGES] == ["toxicity", "simhash near-dedup", "benchmark decontamination", "mixing", "token ids"]
    assert all(t.columns == cp.COLUMNS for t in stages[:-1])


def test_toxicity_stage(spark, stages):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    model = toxicity.fit(stages[0], labels)
    rows = stages[0].collect()
    s = model.score([r["text"].encode() for r in rows])
    assert ids(stages[1]) == sorted(r["doc_id"] for r, x in zip(rows, s, strict=True) if x < 0.5)


def test_dedup_stage(stages):
    """All pairs by the definition: fingerprints within three bits, or five-word similarity of 0.8 or more."""
    text = {r["doc_id"]: r["text"] for r in stages[1].collect()}
    fp = {i: simhash.fingerprint(t.encode()) for i, t in text.items()}
    sets = {}
    for i, t in text.items():
        w = t.encode().translate(LOWER).split()
        sets[i] = {tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if w else set()

    def near(a, b):
        both = len(sets[a] & sets[b])
        return (fp[a] ^ fp[b]).bit_count() <= 3 or both and both >= 0.8 * (len(sets[a]) + len(sets[b]) - both)

    root = {i: i for i in fp}
    for a in sorted(fp):
        for b in sorted(fp):
            if a < b and root[a] != root[b] and near(a, b):
                x, y = root[a], root[b]
                for k, v in root.items():
                    if v == max(x, y):
                        root[k] = min(x, y)
    assert ids(stages[2]) == sorted({i for i in root if root[i] == i})


def jaccard(a, b):
    a, b = ({tuple(w[i : i + 5]) for i in range(len(w) - 4)} for w in (a.split(), b.split()))
    return len(a & b) / len(a | b)


def test_dedup_stage_finds_near_copies_and_leaves_others(spark):
    import random

    r = random.Random(1)
    rows, want = [], set()
    for g in range(60):
        words = [f"w{r.randrange(5000)}" for _ in range(r.randrange(60, 400))]
        want.add(10 * g)
        for k in range(4):
            copy = list(words)
            for _ in range(k * len(words) // 300):
                copy[r.randrange(len(copy))] = "other"
            rows.append((10 * g + k, " ".join(copy), "en", "s", 0))
            assert jaccard(rows[-1][1], " ".join(words)) > 0.85
        half = words[: len(words) // 2] + [f"v{r.randrange(5000)}" for _ in range(len(words) // 2)]
        rows.append((10 * g + 9, " ".join(half), "en", "s", 0))
        want.add(10 * g + 9)
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    got = set(ids(cp.one_of_each_group(spark, docs, SF)))
    assert want <= got and len(got - want) <= 3


def test_decontamination_stage(spark, stages):
    items = [(str(r["item_id"]), r["text"].encode()) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    windows = {w for _, t in items for w in decontam.windows(t)}
    hit = lambda t: any(w in windows for w in decontam.windows(t.encode()) if len(w) == 10)
    assert all(len(w) == 10 for w in windows)
    assert ids(stages[3]) == sorted(r["doc_id"] for r in stages[2].collect() if not hit(r["text"]))


def test_mixing_stage(stages):
    want = []
    for r in mixing.curriculum(stages[3]).collect():
        want += [r["doc_id"]] * len(r["positions"])
    assert ids(stages[4]) == sorted(want)


def test_token_stage_and_run(spark, stages):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(tokenizer_path("byte_bpe_50k.json"))
    want, at = [], 0
    for r in stages[4].orderBy("doc_id").collect():
        x = np.array([*library.encode(r["text"], add_special_tokens=False).ids, 2], "<u4")
        want.append((r["doc_id"], at, len(x), zlib.crc32(x.tobytes())))
        at += len(x)
    assert sorted(map(tuple, stages[5].collect())) == want
    assert sorted(map(tuple, cp.run(spark, SF).collect())) == want


def test_stages_with_odd_rows_and_none(spark):
    rows = [(1, None, "en", "a", 0), (1, None, "en", "a", 0), (2, "", None, None, 0), (None, "x y", "en", "a", 3), (4, "w " * 50_000, "en", "b", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").withColumn("fp", F.lit(1))
    for d in (docs, docs.filter("1=0")):
        for _, f in cp.STAGES:
            out = f(spark, d, SF)
            out.collect()
            if f is not cp.STAGES[-1][1]:
                assert out.columns == cp.COLUMNS
