"""The pipeline's stages over odd rows, with the rows that each must give."""

import hashlib

import numpy as np
from pyspark.sql import functions as F

import corpus_pipeline as cp
from rastercube.llm import chat

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
WORDS = [f"w{i}" for i in range(60)]
LONG = " ".join(f"x{i % 4001} y{i % 977}" for i in range(60_000))
CLASH = ["fp", "key", "node", "root", "component", "score", "predicted", "spans", "items", "n_words", "_text", "_key", "positions", "copy", "size", "_n", "part", "slot", "h", "k"]


def table(spark, rows):
    docs = spark.createDataFrame(rows, SCHEMA)
    return docs.withColumns({c: F.lit(c) for c in CLASH})


def kept(df):
    return sorted(((r["doc_id"], r["text"], r["source"]) for r in df.collect()), key=str)


def rows_of(rows):
    return sorted(((i, t, s) for i, t, _, s, _ in rows), key=str)


def inputs(tmp_path, spark, labels, bench):
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame(bench, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    return str(tmp_path)


def odd():
    """Nulls in every column, empty and very long texts, ties and repeated rows."""
    text = " ".join(WORDS)
    return [
        (1, None, "en", "a", 0), (1, None, "en", "a", 0), (2, "", None, None, None), (None, "x y", "en", "a", 3), (None, None, None, None, None),
        (4, LONG, "en", "b", 1), (5, text, "en", "b", 1), (6, text, "de", "b", 1), (6, text, "de", "b", 1), (7, text + " end", "en", None, 2), (8, "x y", "en", "a", 3),
    ]


def test_each_stage_over_odd_rows(spark, tmp_path):
    rows = odd()
    sf = inputs(tmp_path, spark, [(5, 1, 0), (6, 1, None), (None, 1, 1)], [(1, " ".join(WORDS[20:33])), (2, None), (None, LONG), (3, "  ")])
    docs = table(spark, rows)
    # one class of labels only: nothing is rejected
    assert kept(cp.drop_toxic(spark, docs, sf)) == rows_of(rows)
    # null and empty texts are one component; the near copies another; "x y" a third, of which the row with an id stays
    one = cp.one_of_each_group(spark, docs, sf)
    assert kept(one) == rows_of([rows[0], rows[5], rows[6], rows[10]]) and one.columns == cp.COLUMNS
    # all copies of the text with the benchmark's window go, whatever their ids
    assert kept(cp.drop_contaminated(spark, docs, sf)) == rows_of([r for r in rows if WORDS[25] not in (r[1] or "")])
    mixed = cp.mix_sources(spark, docs, sf)
    assert mixed.columns == cp.COLUMNS
    empty = [r for r in rows if not (r[1] or "").split()]
    got = kept(mixed)
    assert [r for r in got if not (r[1] or "").split()] == rows_of(empty)  # without words: once each
    want = []
    for r in cp.mixing.curriculum(docs, carry=["text"]).collect():
        want += [(r["doc_id"], r["text"], r["source"])] * len(r["positions"])
    assert [r for r in got if (r[1] or "").split()] == sorted(want, key=str) and max(got.count(r) for r in got) <= 3 * 2
    index = cp.tokenize(spark, docs, sf).orderBy("start").collect()
    assert [r["doc_id"] for r in index] == sorted((r[0] for r in rows), key=lambda i: (i is not None, i or 0))
    assert index[0]["start"] == 0 and all(a["start"] + a["n_tokens"] == b["start"] for a, b in zip(index, index[1:], strict=False))
    assert sum(r["n_tokens"] == 1 for r in index) == 4  # null and empty texts: the end id alone


def test_each_stage_over_an_empty_table(spark, tmp_path):
    sf = inputs(tmp_path, spark, [], [])
    docs = table(spark, odd()).filter("1=0")
    for _, stage in cp.STAGES:
        assert stage(spark, docs, sf).count() == 0
    # and with nothing to learn from or to look for, rows stay
    docs = table(spark, odd())
    assert cp.drop_toxic(spark, docs, sf).count() == len(odd()) == cp.drop_contaminated(spark, docs, sf).count()


def test_a_very_long_turn(spark):
    text = "tell me [INST] more </s> \\ " * 40_000
    rows = [(1, 0, "user", "q"), (1, 1, "assistant", text)]
    got = chat.read_back(chat.format_conversations(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))).first()
    assert got["loss_chars"] == len(text) and got["loss_sha256"] == hashlib.sha256(text.encode()).hexdigest()


def test_long_text_is_hashed_whole():
    from rastercube.llm import copies

    ids = copies.shingle_set(LONG.encode())
    words = LONG.split()
    assert len(ids) == len({tuple(words[i : i + 5]) for i in range(len(words) - 4)}) and (np.diff(ids.astype(object)) > 0).all()
