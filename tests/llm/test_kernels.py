"""The numpy and Python kernels of the corpus operators against plain definitions."""

import hashlib
import random
import re

import numpy as np
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st

from rastercube.llm import chat, decontam, embed_dedup, langid, quality, simhash, tokens, toxicity
from rastercube.llm.shared import LOWER, blocks, tokenizer_path

words = st.text("abAB \t\néÉ中-1.", max_size=60)


def plain_fingerprint(text, width=3):
    w = re.findall(rb"[^\x20\x09-\x0D]+", text.translate(LOWER))
    if not w:
        return 0
    sh = [b" ".join(w[i : i + width]) for i in range(max(1, len(w) - width + 1))]
    h = [xxhash.xxh64_intdigest(x, 42) for x in sh]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


@given(words)
def test_fingerprint(text):
    assert simhash.fingerprint(text.encode()) == plain_fingerprint(text.encode())


def test_fingerprint_of_odd_texts():
    assert simhash.fingerprint(None) == simhash.fingerprint(b"") == simhash.fingerprint(b" \n") == 0
    long = " ".join(random.Random(1).choices("abcdefg", k=100_000)).encode()
    assert simhash.fingerprint(long) == plain_fingerprint(long)


def components(values, near):
    root = {v: v for v in values}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in values:
        for b in values:
            if near(a, b):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {v: find(v) for v in values}


@given(st.lists(st.integers(0, 255), unique=True, max_size=25), st.integers(1, 4))
def test_bk_tree_finds_all_within_the_radius(values, radius):
    tree = simhash.BKTree()
    for v in values:
        tree.add(v)
    for v in values:
        assert sorted(tree.within(v, radius)) == sorted(x for x in values if (x ^ v).bit_count() <= radius)
    links = simhash.shard_links(values, radius)
    linked = set(links) | {(b, a) for a, b in links}
    assert components(values, lambda a, b: (a, b) in linked) == components(values, lambda a, b: (a ^ b).bit_count() <= radius)
    assert len(links) < max(1, len(values))


@pytest.mark.parametrize("depth", [1, 2, 3])
def test_every_pair_within_the_radius_meets_in_a_shard_at_every_depth(depth):
    r = random.Random(depth)
    masks = [simhash._masked(p) & (1 << 64) - 1 for p in simhash._levels(3, depth)[-1]]
    assert len(masks) == 4**depth
    for _ in range(500):
        a = r.getrandbits(64)
        b = a
        for bit in r.sample(range(64), 3):
            b ^= 1 << bit
        assert any(a & m == b & m for m in masks)


def plain_hits(text, items):
    w = re.findall(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", text.translate(LOWER))
    hit, found = set(), set()
    for item, t in items:
        for win in decontam.windows(t):
            for i in range(len(w) - len(win) + 1):
                if tuple(w[i : i + len(win)]) == win:
                    hit |= set(range(i, i + len(win)))
                    found.add(item)
    return len(w), len(hit), found


@settings(max_examples=60)
@given(st.lists(st.lists(st.sampled_from(["a", "b", "é"]), max_size=14), max_size=4), st.lists(st.sampled_from(["a", "b", "é", "-", "c"]), max_size=60))
def test_wu_manber(items, doc):
    items = [(str(i), " ".join(x).encode()) for i, x in enumerate(items)]
    text = " ".join(doc).encode()
    n, spans, found = decontam.Searcher(items).search(text)
    assert (n, sum(b - a for a, b in spans), found) == plain_hits(text, items)


def test_wu_manber_across_the_cuts_of_a_long_text(monkeypatch):
    monkeypatch.setattr(decontam, "_PIECE", 40)
    r = random.Random(2)
    items = [("x", " ".join(r.choices("ab", k=12)).encode()), ("y", b"a b")]
    text = " ".join(r.choices("ab", k=3000)).encode()
    n, spans, found = decontam.Searcher(items).search(text)
    assert (n, sum(b - a for a, b in spans), found) == plain_hits(text, items)
    assert decontam.Searcher([]).search(b"a b") == (2, [], set()) and decontam.Searcher(items).search(None) == (0, [], set())


@given(st.lists(st.integers(0, 1 << 40), max_size=700))
def test_elias_fano(values):
    values.sort()
    ef = tokens.EliasFano.encode(np.array(values, np.uint64))
    again, end = tokens.EliasFano.read(memoryview(b"abc" + ef.write()), 3)
    assert end == 3 + len(ef.write()) and again.all().tolist() == values
    for i in range(0, len(values), 7):
        assert again.select(i) == values[i]
    with pytest.raises(IndexError):
        again.select(len(values))


def test_elias_fano_is_small():
    v = np.sort(np.random.default_rng(1).integers(0, 1 << 30, 10_000))
    assert len(tokens.EliasFano.encode(v).write()) < 10_000 * (2 + np.log2((1 << 30) / 10_000) + 1) / 8 + 600


def test_segment_round_trip():
    docs = [None, None, -5, 3, 3, 9]
    ids = [np.arange(k, dtype="<u2").tobytes() for k in (0, 3, 1, 300, 0, 2)]
    s = tokens.Segment(tokens.segment(4, 7, docs, ids, 2) + b"\n")
    assert (s.part, s.seq, s.n_docs, s.n_ids) == (4, 7, 6, 306)
    assert [(d, a, x.tolist()) for d, a, x in s.rows()] == [(d, a, list(range(k))) for d, a, k in zip(docs, (0, 0, 3, 4, 304, 304), (0, 3, 1, 300, 0, 2), strict=True)]
    assert [s.doc_id(i) for i in range(6)] == docs and s.ids(3).tolist() == list(range(300)) and s.span(5) == (304, 306)


_odd = st.lists(st.sampled_from([*"ab Zé1'.,\n\t\r中²Ⅷ\u00a0\x1c\u200b", "  ", "'ll", "<|endoftext|>", " b"]), max_size=30).map("".join)


@pytest.fixture(scope="module")
def encoder():
    return tokens.Encoder(tokenizer_path("byte_bpe_50k.json"))


def test_encoder_equals_the_library(encoder):
    assert encoder.fast and encoder.width == 2

    @settings(max_examples=400)
    @given(_odd)
    def check(text):
        assert np.frombuffer(encoder.encode(text), "<u2").tolist() == encoder.library.encode(text, add_special_tokens=False).ids

    check()


template = chat.Template()
_chat = st.lists(st.sampled_from([*template.controls, "\\", "<", ">", "|", "[", "a", "\n", " ", "é"]), max_size=12).map("".join)


@given(st.lists(st.tuples(st.sampled_from(["user", "assistant", "system", "tool", "|", ">\n", ""]), _chat), max_size=5))
def test_chat_template_round_trip(turns):
    parts = [x for role, text in turns for x in chat.turn_segments(template, role, text)]
    whole = "".join(p for p, _ in parts)
    assert [(r, t) for r, t, _ in template.turns(whole)] == turns
    assert [template.unescape(p) for p, loss in parts if loss] == [t for r, t in turns if r == "assistant"]
    for _, text in turns:
        assert not any(c in template.escape(text) for c in template.controls)


@pytest.mark.parametrize(("roles", "ok"), [("sua", 1), ("u", 1), ("uaua", 1), ("a", 0), ("uu", 0), ("usa", 0), ("ss", 0), ("ux", 0), ("uaa", 0)])
def test_role_machine(roles, ok):
    state = "start"
    for r in roles:
        state = chat.step(state, {"s": "system", "u": "user", "a": "assistant", "x": "tool"}[r])
    assert (state != "invalid") == bool(ok)


def test_blocks_hold_every_byte_once_and_repeat_what_they_say():
    r = random.Random(5)
    texts = [" ".join(r.choices(["ab", "c", "defg"], k=k)).encode() for k in (0, 5, 900, 3, 2000)] + [b"x" * 3000, None]
    for back in (0, 2):
        got = {i: b"" for i in range(len(texts))}
        for part in blocks(texts, limit=500, back=back):
            for i, t, again in part:
                assert not again or got[i].endswith(t[:again])
                got[i] += t[again:]
        assert [got[i] for i in range(len(texts))] == [t or b"" for t in texts]


def test_ngram_buckets_do_not_depend_on_the_blocks(monkeypatch):
    r = random.Random(6)
    texts = [" ".join(r.choices(["ab", "c", "d-e"], k=k)).encode() for k in (0, 5, 900)] + [None, b"A b!"]

    def count():
        out = np.zeros((len(texts), quality.BUCKETS), int)
        for who, key in quality.ngram_buckets(texts):
            np.add.at(out, (who, key), 1)
        return out

    whole = count()
    real = quality.blocks
    monkeypatch.setattr(quality, "blocks", lambda t, back: real(t, limit=300, back=back))
    assert (count() == whole).all()
    assert whole.sum(1).tolist()[:2] == [0, 2 * len(re.findall(rb"\w+", texts[1])) - 1]


def test_language_model():
    r = random.Random(7)
    say = {"xx": "ba be bi bo", "yy": "ka ke ki ko", "zz": "щи да каша"}
    make = lambda l, n: " ".join(r.choices(say[l].split(), k=n)).encode()
    m = langid.Model.fit([(make(l, 30), l) for l in say for _ in range(20)])
    names, scores = m.predict([make("xx", 5), make("yy", 1), make("zz", 9), None, b"", b"12 .", "—".encode(), b"qqqq"])
    assert names[:7] == ["xx", "yy", "zz", "und", "und", "und", "und"] and names[7] in say
    assert all(0 <= s <= 1 for s in scores)
    assert langid.Model.fit([]).predict([b"abc"]) == (["und"], [0.0])
    many = {f"l{i:03d}": f"{chr(97 + i // 26)}{chr(97 + i % 26)}x{chr(97 + i % 26)}" for i in range(70)}
    m = langid.Model.fit([(f"{w} {w}".encode(), k) for k, w in many.items()])
    assert len(m.filters.planes) == 2 and [m.predict([w.encode()])[0][0] for w in many.values()] == list(many)


def test_filters_have_no_false_negatives():
    r = np.random.default_rng(8)
    keys = r.integers(0, 1 << 32, 5000).astype(np.uint32)
    f = langid.Filters.of_sets(["a", "b"], [keys, keys[:10]])
    assert f.counts(keys, np.array([0]), np.array([5000]))[0, 0] == 5000
    other = r.integers(0, 1 << 32, 200_000).astype(np.uint32)
    assert f.counts(other, np.array([0]), np.array([len(other)]))[0, 0] <= 200_000 * f.chance[0] + 30


def toy_rows(n, seed):
    r = random.Random(seed)
    rows = []
    for i in range(n):
        w = [f"w{r.randrange(500)}" for _ in range(r.randrange(5, 80))]
        bad = i % 4 == 0
        if bad:
            w[r.randrange(len(w))] = "grim" + r.choice(["ly", "ness", "o", "est", "xy"])
        rows.append((" ".join(w).encode(), r.choice(["en", None]), int(bad)))
    return rows


def test_classifier_learns_stems_and_scores_any_text():
    c = toxicity.Classifier.fit(toy_rows(600, 1))
    test = toy_rows(200, 2)
    s = c.score([t for t, _, _ in test])
    y = np.array([y for _, _, y in test])
    assert (s[y == 1] >= 0.5).mean() > 0.95 and (s[y == 0] >= 0.5).mean() < 0.05
    assert ((0 <= c.score([None, b"", b" . "])) & (c.score([None, b"", b" . "]) < 0.5)).all()
    long = b"w1 " * 600_000
    assert c.score([long])[0] < 0.5 <= c.score([long + b"grimly"])[0]
    assert c.score([t for t, _, _ in test[:3]] + [long])[:3] == pytest.approx(s[:3], abs=1e-5)


def test_classifier_without_two_classes():
    assert toxicity.Classifier.fit([]).score([b"a"]).tolist() == [0.0]
    assert toxicity.Classifier.fit([(b"a", "en", 0)] * 3).score([b"a"])[0] < 0.5


def vectors(n, groups, seed):
    r = np.random.default_rng(seed)
    x = r.normal(size=(n, 24))
    for g, size in enumerate(groups):
        x[g * 200 : g * 200 + size] = x[g * 200] + r.normal(size=(size, 24)) * 0.08
    return x


def test_graph_finds_the_links_of_brute_force():
    x = vectors(1500, [120, 30, 5], 9)
    shard = embed_dedup.Shard(np.arange(1500), x, np.ones(1500, np.int64))
    unit = embed_dedup.unit_rows(x)
    want = unit @ unit.T >= 0.95
    np.fill_diagonal(want, False)
    who, row, width = shard.links(np.arange(1500), x, 0.95, 24)
    got = np.zeros_like(want)
    got[who, row] = True
    assert got.sum() == len(who)
    assert not (got & ~want).any() and got.sum() >= 0.995 * want.sum() and width < 1500


def test_graph_of_few_vectors():
    for n in (1, 2, 5):
        x = vectors(n, [], n)
        who, row, _ = embed_dedup.Shard(np.arange(n), x, np.ones(n, np.int64)).links(np.arange(n) + 100, x, 0.95, 24)
        assert who.tolist() == row.tolist() == list(range(n))


def test_digest_of_no_items():
    assert decontam.digest([]) == hashlib.sha256(b"").hexdigest()
