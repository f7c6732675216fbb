"""The corpus operators on small tables with every odd row, against brute force and SQL."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from rastercube.llm import chat, components, decontam, embed_dedup, langid, mixing, quality, sharding, simhash, tokens, toxicity
from rastercube.llm import queries as q
from rastercube.llm.oracle import ORACLE
from rastercube.llm.shared import LOWER, tokenizer_path

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def fold(i):
    return zlib.crc32(str(i).encode()) % 5 == 0


def norm(v):
    if isinstance(v, float):
        return repr(v)
    return tuple(map(norm, v)) if isinstance(v, (list, tuple)) else v if v is None else str(v)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_sql(spark, duck, name):
    df = q.queries()[name](spark, SF)
    cols = sorted(df.columns)
    got = sorted((tuple(norm(r[c]) for c in cols) for r in df.collect()), key=repr)
    r = duck.execute(ORACLE[name])
    names = [c[0] for c in r.description]
    assert sorted(names) == cols
    assert got == sorted((tuple(norm(dict(zip(names, x, strict=True))[c]) for c in cols) for x in r.fetchall()), key=repr)


@pytest.fixture(scope="module")
def odd_rows():
    r = random.Random(1)
    prose = lambda n: " ".join(r.choices(["alpha", "beta", "Gamma", "delta,", "épée", "x"], k=n))
    rows = [(i, prose(r.randrange(1, 60)), r.choice(["en", "fr", None]), r.choice(["hot", "hot", "a", None])) for i in range(60)]
    rows += [(60, None, "en", "a"), (61, "", "en", "hot"), (62, " \n\t", None, None), (63, rows[3][1], "en", "a"), (64, rows[3][1].upper(), "fr", "hot"), (65, prose(30_000), "en", "a")]
    rows += [(None, "no id at all", "en", "hot"), rows[5], rows[5], (70, "12 . !", "en", "one")]
    return [(i, t, l, s, len(t or "")) for i, t, l, s in rows]


@pytest.fixture(scope="module")
def odd(spark, odd_rows):
    """Documents with every odd row, and columns whose names operators use inside."""
    df = spark.createDataFrame(odd_rows, DOCS)
    for c in ("_h", "_b", "fp", "rep", "root", "node", "score", "predicted", "spans", "items", "n_words", "size", "key", "u", "v", "_text", "target", "label"):
        df = df.withColumn(c, F.lit("clash"))
    return df.repartition(3)


@pytest.fixture(scope="module")
def none(odd):
    return odd.filter("1 = 0")


def test_interleave(odd, none, odd_rows):
    got = sharding.interleave(odd, shards=4).collect()
    n = len(odd_rows)
    assert sorted((-1 if r["doc_id"] is None else r["doc_id"], r["size"], r["text_crc32"]) for r in got) == sorted((i if i is not None else -1, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t, *_ in odd_rows)
    by = {k: sorted(r["slot"] for r in got if r["shard"] == k) for k in range(4)}
    assert all(v == list(range(len(v))) for v in by.values()) and {len(v) for v in by.values()} <= {n // 4, n // 4 + 1}
    for s in {x[3] for x in odd_rows}:
        share = sum(x[3] == s for x in odd_rows) / 4
        assert all(abs(sum(r["source"] == s and r["shard"] == k for r in got) - share) <= 2 for k in range(4))
    assert sharding.interleave(none).count() == 0
    assert sorted(map(tuple, sharding.interleave(odd, shards=4).collect()), key=repr) == sorted(map(tuple, got), key=repr)


def test_interleave_is_native(odd):
    plan = sharding.interleave(odd)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow|CartesianProduct|BroadcastNestedLoopJoin", plan)


def fill(sizes, cap=3):
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    w = {s: (1, 2, 3)[i % 3] for i, s in enumerate(order)}
    out, open_, left = {}, set(order), float(sum(sizes.values()))
    while open_:
        share = {s: left * w[s] / sum(w[x] for x in open_) for s in open_}
        over = {s for s in open_ if share[s] > cap * sizes[s]}
        if not over:
            return out | share
        for s in over:
            out[s] = float(cap * sizes[s])
            left -= out[s]
        open_ -= over
    return out


def test_curriculum(odd, none, odd_rows):
    got = mixing.curriculum(odd).collect()
    count = lambda t: len(re.findall(rb"[^\x20\x09-\x0D]+", (t or "").encode()))
    sizes = {}
    for _, t, _, s, _ in odd_rows:
        sizes[s] = sizes.get(s, 0) + count(t)
    goal = fill(sizes)
    assert sorted((-1 if r["doc_id"] is None else r["doc_id"], r["size"]) for r in got) == sorted((i if i is not None else -1, count(t)) for i, t, *_ in odd_rows)
    for s in sizes:
        own = [r for r in got if r["source"] == s]
        assert own[0]["source_size"] == sizes[s] and own[0]["target"] == pytest.approx(goal[s])
        assert abs(sum(r["taken"] for r in own) - goal[s]) <= max(r["size"] for r in own) / 2 + 1e-6
    for r in got:
        assert r["taken"] == r["size"] * len(r["positions"]) <= 3 * r["size"] and all(0 <= p <= 1 for p in r["positions"])
    ranked = mixing.training_ranks(mixing.curriculum(odd)).collect()
    order = sorted((r for r in ranked if r["training_rank"] is not None), key=lambda r: r["training_rank"])
    assert [r["training_rank"] for r in order] == list(range(sum(len(r["positions"]) for r in got)))
    assert [r["position"] for r in order] == sorted(r["position"] for r in order) == sorted(p for r in got for p in r["positions"])
    assert len(ranked) - len(order) == sum(not r["positions"] for r in got) and sum(r["copy"] in (None, 0) for r in ranked) == len(got)
    assert mixing.curriculum(none).count() == 0


@pytest.mark.parametrize("sizes", [{"a": 1, "b": 1000, "c": 5}, {"a": 0, "b": 10}, {"x": 7}, {"a": 0}, {"a": 10, "b": 20, "c": 30, "d": 1, None: 4}])
def test_targets_equal_resharing_step_by_step(spark, sizes):
    df = spark.createDataFrame(list(sizes.items()), "source string, source_size long")
    got = {r["source"]: r["target"] for r in mixing.targets(df).collect()}
    assert got == pytest.approx(fill(sizes))


def plain_components(ids, near):
    root = {i: i for i in ids}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in ids:
        for b in ids:
            if a < b and near(a, b):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {i: find(i) for i in ids}


def test_simhash_equals_brute_force(spark, odd, none, odd_rows):
    fp = {i: simhash.fingerprint((t or "").encode()) for i, t, *_ in odd_rows if i is not None}
    want = plain_components(sorted(fp), lambda a, b: (fp[a] ^ fp[b]).bit_count() <= 3)
    got = simhash.near_duplicates(odd).collect()
    assert len(got) == len(odd_rows)
    assert {r["doc_id"]: r["component_id"] for r in got if r["doc_id"] is not None} == want
    assert {r["doc_id"]: r["fp"] & (1 << 64) - 1 for r in got if r["doc_id"] is not None} == fp
    assert simhash.near_duplicates(none).count() == 0


def test_simhash_query_equals_brute_force(spark):
    docs = {r["doc_id"]: (r["text"] or "").encode() for r in q.table(spark, SF, "documents").collect()}
    fp = {i: simhash.fingerprint(t) for i, t in docs.items()}
    want = plain_components(sorted(fp), lambda a, b: (fp[a] ^ fp[b]).bit_count() <= 3)
    got = {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in q.op4_simhash_bktree(spark, SF).collect()}
    assert got == {i: (f"{fp[i]:016x}", want[i]) for i in docs}


@pytest.mark.parametrize("split_above", [2, 5, 10_000])
def test_hot_shards_are_dealt_again_without_loss(spark, split_above):
    r = random.Random(3)
    base, values = r.getrandbits(64), set()
    for _ in range(150):  # one dense group, in which nearly all shards are hot
        v = base
        for b in r.sample(range(64), r.randrange(0, 4)):
            v ^= 1 << b
        values.add(v)
    values |= {r.getrandbits(64) for _ in range(50)}
    signed = sorted(v - (1 << 64) if v >> 63 else v for v in values)
    found = simhash.links(spark.createDataFrame([(v,) for v in signed], "fp long"), split_above=split_above)
    linked = {(x["u"], x["v"]) for x in found.collect()}
    mask = (1 << 64) - 1
    assert all(((a ^ b) & mask).bit_count() <= 3 for a, b in linked)
    linked |= {(b, a) for a, b in linked}
    assert plain_components(signed, lambda a, b: (a, b) in linked) == plain_components(signed, lambda a, b: ((a ^ b) & mask).bit_count() <= 3)


def test_components_of_a_path_a_star_and_a_pair(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 30)] + [(-5, -9), (7, 7), (None, 3)]
    got = {r["node"]: r["root"] for r in components.connected(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {i: 0 for i in range(1, 41)} | {100 + i: 100 for i in range(1, 30)} | {-5: -9}
    assert components.connected(spark.createDataFrame([], "u long, v long")).count() == 0


def test_decontamination(spark, odd, none):
    long = " ".join(f"w{i}" for i in range(40))
    bench = spark.createDataFrame([(1, long), (1, "alpha beta gamma delta épée x alpha beta gamma delta épée x"), (2, "no id"), (3, None), (4, " . "), (None, "x"), (10, long)], "item_id long, text string")
    docs = spark.createDataFrame([(1, "W3 w4-w5 " + " ".join(f"w{i}" for i in range(6, 20)) + " end"), (2, "w1 w2"), (3, None), (4, "")], "doc_id long, text string").unionByName(odd.select("doc_id", "text"))
    for block in (1 << 20, 60):
        got = {(r["doc_id"], r["n_words"], r["n_hit"], r["n_items"], r["items_sha256"], r["contaminated"]) for r in decontam.verdicts(decontam.find_contamination(docs, bench, block_bytes=block)).collect() if r["doc_id"] in (None, 1, 2, 3, 4) and r["n_words"] in (0, 2, 4, 18)}
        sha = lambda *x: hashlib.sha256(",".join(x).encode()).hexdigest()
        assert {(1, 18, 17, 2, sha("1", "10"), True), (2, 2, 0, 0, sha(), False), (3, 0, 0, 0, sha(), False), (4, 0, 0, 0, sha(), False), (None, 4, 2, 1, sha("2"), True)} <= got
    kept = decontam.find_contamination(odd, bench.filter("1=0"))
    assert kept.count() == odd.count() and kept.filter("size(items) > 0").count() == 0 and set(kept.columns) == set(odd.columns) - {"_text"}
    assert decontam.find_contamination(none, bench).count() == 0


def test_toxicity(spark, odd, none):
    r = random.Random(4)
    rows, marks = [], []
    for i in range(500):
        bad = i % 3 == 0
        w = [f"w{r.randrange(300)}" for _ in range(r.randrange(4, 40))] + ["vilest" if r.random() < 0.5 else "vileness"] * bad
        r.shuffle(w)
        rows.append((i, " ".join(w), r.choice(["en", "fr", None]), "s", 0))
        marks.append((i, 1, int(bad)))
    docs, labels = spark.createDataFrame(rows, DOCS), spark.createDataFrame([*marks, (None, 1, 1), (3, 1, None), (4, None, None)], "doc_id long, quality int, toxic int")
    got = toxicity.classify(docs, labels).collect()
    assert all(x["held_out"] == fold(x["doc_id"]) and 0 <= x["score"] <= 1 and x["predicted"] == (x["score"] >= 0.5) for x in got)
    test = [x for x in got if x["held_out"]]
    assert np.mean([x["predicted"] == (x["doc_id"] % 3 == 0) for x in test]) > 0.95
    model = toxicity.fit(docs, labels)
    scored = toxicity.score_documents(odd, model)
    assert scored.count() == odd.count() and scored.filter("score is null").count() == 0 and scored.schema["text"].dataType.simpleString() == "string"
    assert toxicity.classify(none, labels).count() == 0 and toxicity.classify(odd, labels.filter("1=0")).filter("predicted = 1").count() == 0


def test_toxicity_never_learns_from_held_out_labels(spark):
    rows = [(i, "same words here " + ("bad" if i % 2 else "good"), "en", "s", 0) for i in range(100)]
    docs = spark.createDataFrame(rows, DOCS)
    flip = lambda i: (i % 2) if not fold(i) else 1 - i % 2
    one, two = (spark.createDataFrame([(i, 1, f(i)) for i in range(100)], "doc_id long, quality int, toxic int") for f in (lambda i: i % 2, flip))
    assert toxicity.training_rows(docs, one, 1000) == toxicity.training_rows(docs, two, 1000) and len(toxicity.training_rows(docs, one, 7)) == 14


def test_languages(spark, odd, none):
    docs = q.table(spark, "/root/testdata/sf0.01", "documents")
    got = {r["doc_id"]: r for r in langid.predict_languages(docs).collect()}
    truth = {r["doc_id"]: r["lang"] for r in docs.select("doc_id", "lang").collect()}
    held = [i for i in truth if got[i]["held_out"]]
    assert all(got[i]["held_out"] == fold(i) for i in truth) and np.mean([got[i]["lang_pred"] == truth[i] for i in held]) > 0.95
    rows = langid.predict_languages(odd).collect()
    assert len(rows) == odd.count()
    assert {r["lang_pred"] for r in rows if r["doc_id"] in (60, 61, 62, 70)} == {"und"} and all(0 <= r["score"] <= 1 for r in rows)
    assert langid.predict_languages(none).count() == 0


def test_resampling_prefers_text_like_the_target(spark, odd, none):
    r = random.Random(5)
    rows = [(i, " ".join(r.choices(["good", "fine", "well"] if i % 2 else ["bad", "poor", "ill"], k=8)), "en", "s", 0) for i in range(400)]
    docs = spark.createDataFrame(rows, DOCS)
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(100)] + [(None, 1, 0)], "doc_id long, quality int, toxic int")
    got = quality.resample(docs, labels, share=0.25).collect()
    kept = [x["doc_id"] for x in got if x["kept"]]
    assert len(got) == 400 and len(kept) == 100 and all(i % 2 for i in kept)
    keys = sorted((x["key"] for x in got), reverse=True)
    assert min(x["key"] for x in got if x["kept"]) == keys[99]
    assert [tuple(x) for x in quality.resample(docs, labels, share=0.25).orderBy("doc_id").collect()] == sorted(map(tuple, got))
    rows = quality.resample(odd, labels).collect()
    assert len(rows) == odd.count() and {x["log_weight"] for x in rows if x["doc_id"] in (60, 61, 62)} == {0.0}
    assert quality.resample(none, labels).count() == 0


@pytest.mark.parametrize("k", [1, 7, 500, 1000, 1001])
def test_kth_largest(spark, k):
    r = np.random.default_rng(6)
    v = np.concatenate([r.normal(size=700) ** 5, np.full(300, 0.25)])
    df = spark.createDataFrame([(float(x),) for x in v], "x double")
    want = None if k > 1000 else sorted(v, reverse=True)[k - 1]
    assert quality.kth_largest(df, "x", k, bins=16, small=10) == want


def test_token_files(spark, odd, none, odd_rows, tmp_path):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(tokenizer_path("byte_bpe_50k.json"))
    path = f"file://{tmp_path}/ids"
    got = [tuple(r)[:4] for r in tokens.token_index(odd, path=path).orderBy("start").collect()]
    want, at = [], 0
    ids = {}
    for i, t, *_ in odd_rows:
        ids.setdefault(i, []).append(np.array([*library.encode(t or "", add_special_tokens=False).ids, 2], "<u4"))
    for i in sorted(ids, key=lambda i: (i is not None, i or 0)):
        for x in ids[i]:
            want.append((i, at, len(x), zlib.crc32(x.tobytes())))
            at += len(x)
    assert got == want
    import glob

    files = [tokens.Segment(open(f, "rb").read()) for f in glob.glob(f"{tmp_path}/ids/part-*")]
    files.sort(key=lambda s: (s.part, s.seq))
    again = [s.ids(i).tolist() for s in files for i in range(s.n_docs)]
    assert [len(x) for x in again] == [w[2] for w in want] and [s.doc_id(i) for s in files for i in range(s.n_docs)] == [w[0] for w in want]
    assert tokens.token_index(none).count() == 0


def test_tokens_are_cut_into_several_segments(spark, odd, tmp_path):
    path = f"file://{tmp_path}/small"
    tokens.write_segments(odd, path, segment_ids=500)
    rows = tokens.read_segments(spark, path)
    assert rows.select("part", "seq").distinct().count() > 4 and rows.count() == odd.count()


def test_embeddings(spark):
    r = np.random.default_rng(7)
    x = r.normal(size=(120, 16))
    x[10:30] = x[10] + r.normal(size=(20, 16)) * 0.05
    x[40] = x[41] * 3
    x[50] = x[51]
    rows = [(i, [float(v) for v in e]) for i, e in enumerate(x)]
    rows += [(200, None), (201, [0.0] * 16), (202, [float("nan")] * 16), (203, [None] * 16), (204, []), (205, [1.0, 0.0]), (206, [2.0, 0.0]), (None, rows[0][1]), rows[60], (207, [float("inf")] + [1.0] * 15)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("label", F.lit(1)).withColumn("rep", F.lit("clash"))
    valid = {i: np.array(e) for i, e in rows if i is not None and (i < 200 or i in (205, 206))}
    unit = {i: e / np.sqrt((e * e).sum()) for i, e in valid.items()}
    near = lambda a, b: len(unit[a]) == len(unit[b]) and unit[a] @ unit[b] >= 0.95
    comp = plain_components(sorted(unit), near)
    want = {i: (sum(near(i, j) for j in unit if j != i), comp[i]) for i in unit} | {i: (0, i) for i in (200, 201, 202, 203, 204, 207)}
    got = embed_dedup.near_duplicates(df, shards=3, blocks=2).collect()
    assert len(got) == len(rows)
    assert {g["vec_id"]: (g["n_links"], g["component_id"]) for g in got if g["vec_id"] is not None} == want
    assert all(g["kept"] == (g["vec_id"] is not None and g["vec_id"] == g["component_id"]) for g in got)
    assert embed_dedup.near_duplicates(df.filter("1=0")).count() == 0


def test_conversations(spark):
    rows = [(1, 0, "user", "hi [INST]"), (1, 1, "assistant", None), (2, 1, "assistant", "b\\"), (2, 0, "system", "s"), (None, 0, "user", "x"), (3, 0, None, "tool text"), (4, 0, "user", "q"), (4, 0, "user", "q")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("segment", F.lit("clash")).withColumn("loss", F.lit(1))
    segments = chat.format_conversations(df)
    one, two = ({r["conv_id"]: r for r in chat.read_back(segments, ordered=o).collect()} for o in (True, False))
    assert one == two and set(one) == {1, 2, 3, 4, None}
    sha = lambda *t: hashlib.sha256("".join(f"{a}\n{b}\n" for a, b in t).encode()).hexdigest()
    assert one[1]["turns_sha256"] == sha(("user", "hi [INST]"), ("assistant", "")) and one[1]["valid"] and one[1]["loss_chars"] == 0
    assert one[2]["turns_sha256"] == sha(("system", "s"), ("assistant", "b\\")) and not one[2]["valid"] and one[2]["loss_sha256"] == hashlib.sha256(b"b\\").hexdigest()
    assert one[3]["turns_sha256"] == sha(("", "tool text")) and one[4]["n_turns"] == 2 and not one[4]["valid"]
    assert chat.format_conversations(df.filter("1=0")).count() == 0 and chat.read_back(chat.format_conversations(df.filter("1=0"))).count() == 0


def test_every_operator_has_its_query():
    names = q.queries()
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 11))


def test_lowering_touches_ascii_letters_only():
    assert "AZÉ[`".encode().translate(LOWER) == "azÉ[`".encode()
