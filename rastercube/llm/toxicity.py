"""A convolutional text classifier over hashed word embeddings, trained in numpy."""

from __future__ import annotations

import io
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rastercube.llm import langid
from rastercube.llm.shared import LOWER, Prefix, blocks, bounded_batches, held_out, hold, seeded, with_text_bytes, word_spans

_IS_WORD = np.array([97 <= c <= 122 or 48 <= c <= 57 or c >= 128 for c in LOWER])
_BUCKETS = 1 << 16
#: A word is hashed whole and by its first bytes, so that inflected forms share what they learn.
_PREFIXES = (4, 5)
_DIM, _FILTERS, _WIDTHS = 8, 8, (1, 2, 3)


def word_ids(joined: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Bucket numbers (words, 1 + prefixes) of the words of a lower-cased block, and their starts."""
    arr, starts, ends = word_spans(joined, _IS_WORD)
    if not len(starts):
        return np.zeros((0, 1 + len(_PREFIXES)), np.int32), starts
    hashes = Prefix(arr)
    cols = [hashes.slices(starts, ends)]
    cols += [hashes.slices(starts, np.minimum(starts + k, ends)) ^ np.uint64(k * 0x9E3779B9) for k in _PREFIXES]
    return np.stack([(c >> np.uint64(48)).astype(np.int32) for c in cols], axis=1), starts


class Network:
    """Embedding sum, convolutions of several widths, rectifier, maximum over the text, dense output.

    All weights begin at random; what the network knows, training has taught it.
    """

    def __init__(self, seed: int = 5):
        r = np.random.default_rng(seed)
        self.emb = (r.standard_normal((_BUCKETS, _DIM)) * 0.1).astype(np.float32)
        self.dense = {"out": (r.standard_normal(_FILTERS * len(_WIDTHS)) * 0.1).astype(np.float32), "shift": np.zeros(1, np.float32)}
        for w in _WIDTHS:
            self.dense[f"conv{w}"] = (r.standard_normal((w, _DIM, _FILTERS)) * 0.3 / np.sqrt(w)).astype(np.float32)
            self.dense[f"bias{w}"] = np.zeros(_FILTERS, np.float32)

    def pooled(self, ids: np.ndarray, bounds: np.ndarray, argmax: bool = False):
        """Maximum of each filter over each text; texts are ids[bounds[i]:bounds[i+1]].

        Windows that reach beyond the text's end see zeros there.
        """
        n = len(bounds) - 1
        x = self.emb[ids].sum(1) if len(ids) else np.zeros((0, _DIM), np.float32)
        out = np.zeros((n, _FILTERS * len(_WIDTHS)), np.float32)
        at = np.full(out.shape, -1, np.int64)
        full = np.flatnonzero(np.diff(bounds) > 0)
        if not len(full):
            return (out, at, x) if argmax else out
        ends = bounds[full + 1]
        for k, w in enumerate(_WIDTHS):
            conv = self.dense[f"conv{w}"]
            y = x @ conv[0] + self.dense[f"bias{w}"]
            for d in range(1, w):
                z = x @ conv[d]
                for e in range(d):  # the first words of a text are not the followers of the text before
                    near = bounds[full] + e
                    z[near[near < ends]] = 0
                y[:-d] += z[d:]
            cols = slice(k * _FILTERS, (k + 1) * _FILTERS)
            best = np.maximum.reduceat(y, bounds[full], axis=0)
            out[full, cols] = np.maximum(best, 0)
            if argmax:
                for i, b in zip(full, best, strict=True):
                    at[i, cols] = np.where(b > 0, bounds[i] + y[bounds[i] : bounds[i + 1]].argmax(0), -1)
        return (out, at, x) if argmax else out

    def logits(self, pooled: np.ndarray) -> np.ndarray:
        return pooled @ self.dense["out"] + self.dense["shift"][0]

    def gradients(self, ids: np.ndarray, bounds: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[dict, np.ndarray, np.ndarray, int]:
        """Of the weighted mean logistic loss: those of the dense weights, buckets with those of their rows, and in how many places they stand."""
        p, at, x = self.pooled(ids, bounds, argmax=True)
        err = (1 / (1 + np.exp(-np.clip(self.logits(p), -30, 30))) - y) * weight / len(y)
        g = {"out": p.T @ err, "shift": np.array([err.sum()])}
        down = err[:, None] * self.dense["out"] * (at >= 0)
        where, what = [], []
        for k, w in enumerate(_WIDTHS):
            cols = slice(k * _FILTERS, (k + 1) * _FILTERS)
            e, a, conv = down[:, cols], at[:, cols], self.dense[f"conv{w}"]
            g[f"bias{w}"] = e.sum(0)
            gc = np.zeros((w, _FILTERS, _DIM))
            for d in range(w):
                t, f = np.nonzero((a >= 0) & (a + d < bounds[1:, None]))
                pos, part = a[t, f] + d, e[t, f][:, None]
                np.add.at(gc[d], f, part * x[pos])
                where.append(pos)
                what.append(part * conv[d].T[f])
            g[f"conv{w}"] = gc.transpose(0, 2, 1)
        pos, gx = np.concatenate(where), np.concatenate(what)
        buckets, back = np.unique(ids[pos].ravel(), return_inverse=True)
        rows = np.zeros((len(buckets), _DIM))
        np.add.at(rows, back, np.repeat(gx, ids.shape[1], axis=0))
        return g, buckets, rows, len(back)

    def train(self, texts: list[np.ndarray], y: np.ndarray, steps: int = 1000, batch: int = 32, rate: float = 0.01, step_of_rows: float = 0.02, fade: float = 0.015, drop: float = 0.45, seed: int = 6) -> None:
        """Adam on the logistic loss, classes weighted alike; gradients flow through the maxima.

        As many steps at every size, of ``batch`` texts each in shuffled rounds. Of every text a
        random share ``drop`` of the words is left out, so that no single word is learned by
        heart. Embedding rows move in proportion to their gradient against its mean square
        over all rows, and all of them fade, so that words of no consequence end near zero.
        In the second half the steps shrink to nothing.
        """
        r = np.random.default_rng(seed)
        weight = np.where(y > 0, 0.5 / max(1e-9, y.mean()), 0.5 / max(1e-9, 1 - y.mean()))
        m = {k: np.zeros_like(v) for k, v in self.dense.items()}
        s = {k: np.zeros_like(v) for k, v in self.dense.items()}
        square, order, at = 0.0, r.permutation(len(texts)), 0
        for step in range(1, steps + 1):
            if at >= len(order):
                order, at = r.permutation(len(texts)), 0
            pick = order[at : at + batch]
            at += batch
            some = [texts[j][r.random(len(texts[j])) >= drop] for j in pick]
            bounds = np.concatenate([[0], np.cumsum([len(x) for x in some])])
            slow = min(1.0, 2 * (1 - step / steps))
            g, buckets, rows, places = self.gradients(np.concatenate(some), bounds, y[pick], weight[pick])
            for k, v in self.dense.items():
                m[k] += 0.1 * (g[k] - m[k])
                s[k] += 0.001 * (g[k] ** 2 - s[k])
                v -= (rate * slow * (m[k] / (1 - 0.9**step)) / (np.sqrt(s[k] / (1 - 0.999**step)) + 1e-8)).astype(np.float32)
            square = 0.99 * square + 0.01 * float((rows**2).sum() / max(1, places))
            self.emb[buckets] -= (step_of_rows * slow * rows / (np.sqrt(square / (1 - 0.99**step)) + 1e-8)).astype(np.float32)
            self.emb *= np.float32(1 - fade * slow)


def fold_of(labels: np.ndarray, folds: int) -> np.ndarray:
    """The rows' folds: those of a class are dealt out in turn."""
    fold = np.zeros(len(labels), np.int64)
    for c in np.unique(labels):
        own = np.flatnonzero(labels == c)
        fold[own] = np.arange(len(own)) % folds
    return fold


def trained(ids: list[np.ndarray], labels: np.ndarray, fold: np.ndarray, k: int, member: int) -> tuple[Network | None, np.ndarray]:
    """A network of the rows outside of fold k, and its logits of those inside; none without both classes."""
    rest, own = np.flatnonzero(fold != k), np.flatnonzero(fold == k)
    if not 0 < labels[rest].sum() < len(rest):
        return None, np.full(len(own), np.nan)
    network = Network(seed=5 + 10 * member)
    network.train([ids[i] for i in rest], labels[rest], seed=6 + 10 * member)
    scores = [network.logits(network.pooled(ids[i], np.array([0, len(ids[i])])))[0] for i in own]
    return network, np.array(scores, np.float64)


class Classifier:
    """Networks whose logits are averaged, a language model of the same rows, and a threshold for each language."""

    def __init__(self, networks: list[Network], languages: langid.Model | None, thresholds: dict[str, float], base: float, prior: float = 0.0):
        self.networks, self.languages, self.thresholds, self.base, self.prior = networks, languages, thresholds, base, prior

    @classmethod
    def fit(cls, rows: list[tuple[bytes, str | None, int]], each=None, folds: int = 5, members: int = 3) -> Classifier:
        """rows: (text, lang, label). Thresholds are set on scores of rows that a network didn't see.

        Each fold in turn is scored by networks of the others, and the last ones are trained on
        all rows; ``members`` networks that begin differently share each task. A language's threshold lies midway between its classes' scores where they
        are furthest apart, drawn to that of all languages as if by 20 rows more; zero where no
        scores of both classes are there. lang is a label here: it trains the language model,
        which tells a text's language when it is scored. ``each`` runs trained() for folds (-1: all
        rows) and members; by default one after the other.
        """
        labels = np.array([c for _, _, c in rows], np.float64)
        if not len(rows) or labels.min() == labels.max():
            return cls([], None, {}, 0.0, float((labels.sum() + 0.5) / (len(rows) + 1)) if len(rows) else 0.0)
        ids = [word_ids(t.translate(LOWER))[0] for t, _, _ in rows]
        fold = fold_of(labels, folds)
        which = [(k, j) for k in [-1, *range(folds)] for j in range(members)]
        found = (each or (lambda ids, labels, fold, which: {x: trained(ids, labels, fold, *x) for x in which}))(ids, labels, fold, which)
        scores = np.full(len(rows), np.nan)
        for k in range(folds):
            scores[fold == k] = np.mean([found[k, j][1] for j in range(members)], axis=0)
        rest = np.flatnonzero(~np.isnan(scores))
        scores, y = scores[rest], labels[rest]
        languages = langid.Model.fit([(t, lang) for t, lang, _ in rows if lang is not None])
        of = np.array(languages.predict([rows[i][0] for i in rest])[0])
        two = lambda y: 0 < y.sum() < len(y)  # noqa: E731  both classes are there
        base = threshold(scores, y) if two(y) else 0.0
        thresholds = {}
        for lang in set(of.tolist()):
            own = of == lang
            if two(y[own]):
                n = min(y[own].sum(), own.sum() - y[own].sum())
                thresholds[lang] = (n * threshold(scores[own], y[own]) + 20 * base) / (n + 20)
        return cls([found[-1, j][0] for j in range(members)], languages, thresholds, base)

    def score(self, texts: list[bytes | None]) -> np.ndarray:
        if not self.networks:
            return np.full(len(texts), self.prior)
        best = np.zeros((len(self.networks), len(texts), _FILTERS * len(_WIDTHS)), np.float32)
        for part in blocks(texts, back=max(_WIDTHS) - 1):
            lowered = [t.translate(LOWER) + b" " for _, t, _ in part]
            ids, starts = word_ids(b"".join(lowered))
            bounds = np.searchsorted(starts, np.concatenate([[0], np.cumsum([len(t) for t in lowered])]))
            who = np.array([i for i, _, _ in part])
            for of, network in zip(best, self.networks, strict=True):
                np.maximum.at(of, who, network.pooled(ids, bounds))
        logits = np.mean([network.logits(of) for of, network in zip(best, self.networks, strict=True)], axis=0)
        of = self.languages.predict(texts)[0] if self.thresholds else [""] * len(texts)
        cut = np.array([self.thresholds.get(x, self.base) for x in of])
        return 1 / (1 + np.exp(-np.clip(logits - cut, -30, 30)))


def threshold(scores: np.ndarray, y: np.ndarray) -> float:
    """Midway between neighbouring scores where the true less the false positive rate is highest."""
    order = np.argsort(-scores, kind="stable")
    s, t = scores[order], y[order]
    gain = np.cumsum(t) / t.sum() - np.cumsum(1 - t) / (1 - t).sum()
    ok = np.append(s[:-1] > s[1:], False)
    gain = np.where(ok, gain, -1)
    k = int(gain.argmax())
    return float((s[k] + s[k + 1]) / 2) if ok.any() else float(s.mean())


def training_rows(docs: DataFrame, labels: DataFrame, per_class: int, class_bytes: int = 16 << 20, seed: int = 29) -> list[tuple[bytes, str | None, int]]:
    """(text, lang, label) of training rows of each class, in the order of a seeded hash.

    Training rows have a crc32(doc_id) that is not 0 modulo 5. Of each class the first
    per_class are taken, and of these as many as hold class_bytes of text together, one at
    least; their texts are whole. A document with several labels is toxic if one of them says so.
    """
    known = labels.filter("doc_id is not null and toxic is not null").filter(~held_out(F.col("doc_id")))
    known = known.groupBy("doc_id").agg(F.max("toxic").cast("int").alias("y")).withColumn("_h", seeded(seed, F.col("doc_id")))
    sizes = docs.groupBy("doc_id").agg(F.max(F.coalesce(F.octet_length("text"), F.lit(0))).alias("_bytes"))
    sized = known.join(sizes, "doc_id")
    picked = []
    for y in (0, 1):
        held = 0
        # per_class rows of a few numbers, whatever the size of the tables
        for r in sized.filter(F.col("y") == y).orderBy("_h", "doc_id").limit(per_class).collect():
            held += r["_bytes"]
            if held > class_bytes and picked and picked[-1][2] == y:
                break
            picked.append((r["_h"], r["doc_id"], y))
    if not picked:
        return []
    kind = docs.schema["doc_id"].dataType.simpleString()
    ids = docs.sparkSession.createDataFrame(picked, f"_h long, doc_id {kind}, y int")
    rows = docs.select("doc_id", "text", "lang").join(F.broadcast(ids), "doc_id").groupBy("doc_id", "_h", "y").agg(F.min("text").alias("text"), F.min("lang").alias("lang"))
    got = [(r["_h"], r["doc_id"], (r["text"] or "").encode(), r["lang"], r["y"]) for r in rows.toLocalIterator()]
    return [x[2:] for x in sorted(got, key=lambda x: x[:2])]


def fit(docs: DataFrame, labels: DataFrame, per_class: int = 2000, class_bytes: int = 16 << 20) -> Classifier:
    """A classifier of at most per_class rows and class_bytes of text a class; its networks are trained as tasks."""
    spark = docs.sparkSession

    def each(ids, labels, fold, which):
        held = spark.sparkContext.broadcast((ids, labels, fold))  # the training rows: bounded

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            hold("toxicity", dict)
            for b in batches:
                for i in b.column(0).to_pylist():
                    k, member = which[i]
                    network, scores = trained(*held.value, k, member)
                    out = io.BytesIO()
                    if k < 0:
                        np.savez(out, emb=network.emb, **network.dense)
                    yield pa.RecordBatch.from_arrays([pa.array([i]), pa.array([out.getvalue()], pa.binary()), pa.array([scores], pa.list_(pa.float64()))], ["i", "network", "scores"])

        found = {}
        # of the folds only the scores come back
        for r in spark.range(0, len(which), 1, len(which)).mapInArrow(run, "i bigint, network binary, scores array<double>").collect():
            network = None
            if r["network"]:
                network, arrays = Network(), np.load(io.BytesIO(r["network"]))
                network.emb, network.dense = arrays["emb"], {k: arrays[k] for k in network.dense}
            found[which[r["i"]]] = network, np.array(r["scores"])
        held.destroy()
        return found

    return Classifier.fit(training_rows(docs, labels, per_class, class_bytes), each)


def score_documents(docs: DataFrame, model: Classifier) -> DataFrame:
    """All columns of docs, and score (0 to 1) and predicted (1 if score >= 0.5, else 0).

    Whole texts are scored in blocks of about one megabyte; a longer text in several, of which
    each filter's maximum counts. Null and empty texts score what no word scores. Rows are
    neither moved nor dropped. Columns named score or predicted are replaced.
    """
    keep = [c for c in docs.columns if c not in ("score", "predicted")]
    bounded_batches(docs.sparkSession)
    rows = docs.select(*keep)
    held = docs.sparkSession.sparkContext.broadcast(model)  # of fixed size
    schema = rows.withColumn("score", F.lit(0.0)).withColumn("predicted", F.lit(0)).schema
    at = keep.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hold("toxicity", dict)
        for b in batches:
            texts = b.column(at).cast(pa.binary())
            s = held.value.score([x.as_py() for x in texts])
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(s, pa.float64()), pa.array((s >= 0.5).astype(np.int32))], [*keep, "score", "predicted"])

    return rows.mapInArrow(run, schema)


def classify(docs: DataFrame, labels: DataFrame, per_class: int = 2000) -> DataFrame:
    """doc_id, held_out, score, predicted of every document, learned from its labelled training rows.

    Without labelled rows of both classes every score is the share of class 1 (0 if none). Null
    and empty texts score what no word scores, very long ones are scored in blocks, repeated
    rows stay and score alike, an empty table gives no rows; other columns are ignored.
    """
    scored = score_documents(with_text_bytes(docs, "doc_id"), fit(docs, labels, per_class))
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")
