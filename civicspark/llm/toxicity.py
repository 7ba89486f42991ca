"""Toxicity by non-negative positive-unlabelled learning.

Confirmed toxic texts are the positives; texts drawn from the whole corpus, no
matter what their labels say, are the unlabelled set.  The risk of a classifier
g is estimated without a single negative:

    prior * E_pos[loss(g)] + max(0, E_unl[loss(-g)] - prior * E_pos[loss(-g)])

where ``prior`` is the share of toxic rows among the labelled ones.  While the
second part of a batch is below zero it adds nothing to the step, which keeps a
flexible classifier from driving it there.  With the logistic
loss the margin estimates the log odds of the corrected posterior, so 0.5 is
the natural threshold.  Several linear classifiers (numpy, Adam on batches, own
seeds) are averaged.

Features are hashed words and hashed word beginnings of 3 to 8 bytes: a word
list is learned, and stems shared by compounds nobody has seen.  Of the hash
space, the features most over-represented in positives against unlabelled texts
are kept (a z-score; counts over the whole sample are added up by Spark), plus
the text length.

Bounds (parameters): ``positives`` and ``unlabelled`` texts in training.  The
prior covers all labelled rows of the learning folds; scoring reads every whole
text and nothing but the text.

Defined cases: null and empty texts get the score of a text without words; a
row without an id is scored and never learned from; a doc_id with several
labels counts as toxic if one says so; without any positive every score is 0.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from civicspark.llm.langid import fold
from civicspark.llm.store import written
from civicspark.llm.text_bytes import Hasher, Piece, pieces, row_of, runs

HASH_BITS = 20
BEGINNINGS = range(3, 9)
FEATURES = 2_048            # kept features
POSITIVES, UNLABELLED = 3_000, 6_000
CLASSIFIERS, STEPS, BATCH, L2 = 3, 600, 512, 1e-3
LOWERED_ROWS, LOWERED_BYTES = 512, 200_000       # texts lowered together, and bytes hashed together (about 15 MB)
_LETTER = np.zeros(256, bool)
_LETTER[ord("a"):ord("z") + 1] = True
_LETTER[128:] = True        # bytes of letters beyond ASCII


class Model(NamedTuple):
    place: np.ndarray       # hash -> feature, -1 if not kept
    weights: np.ndarray     # kept features, then length, then 1
    prior: float


def hashed_words(piece: Piece) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Features of all words and beginnings, the row of each, and the number of words per row."""
    starts, ends = runs(_LETTER[piece.data])
    hasher, row = Hasher(piece.data), row_of(piece, starts)
    out, rows = [hasher.of(starts, ends)], [row]
    for n in BEGINNINGS:
        long = ends - starts >= n
        s = starts[long]
        out.append(hasher.of(s, s + n) ^ np.uint64(n * 0x1234567))
        rows.append(row[long])
    index = (np.concatenate(out) >> np.uint64(64 - HASH_BITS)).astype(np.int64)
    return index, np.concatenate(rows), np.bincount(row, minlength=len(piece.starts))


def counted(index: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (row, feature) pairs and how often each occurs."""
    key, n = np.unique(rows.astype(np.int64) << HASH_BITS | index, return_counts=True)
    return key >> HASH_BITS, key & ((1 << HASH_BITS) - 1), n


def lowered(texts: pa.Array) -> Iterator[Piece]:
    """Pieces of ``texts`` in lower case, a few rows at a time instead of a copy of the batch."""
    for first in range(0, len(texts), LOWERED_ROWS):
        part = pc.utf8_lower(pc.fill_null(texts.slice(first, LOWERED_ROWS), ""))
        for p in pieces(part, LOWERED_BYTES):
            yield p._replace(first=first + p.first)


def _document_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents of the sample with each feature: positives and unlabelled."""
    n = np.zeros((2, 1 << HASH_BITS), np.int64)
    for batch in batches:
        positive = batch["positive"].to_numpy(zero_copy_only=False)
        for p in lowered(batch["text"]):
            index, rows, _ = hashed_words(p)
            rows, index, _ = counted(index, rows)
            is_pos = positive[p.first + rows]
            n[1] += np.bincount(index[is_pos], minlength=1 << HASH_BITS)
            n[0] += np.bincount(index[~is_pos], minlength=1 << HASH_BITS)
    at = np.nonzero(n.sum(0))[0]
    yield pa.record_batch({"feature": at.astype(np.int32), "in_pos": n[1, at], "in_unl": n[0, at]})


def _rows_of(place: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for p in lowered(batch["text"]):
                index, rows, words = hashed_words(p)
                kept = place[index] >= 0
                r, f, n = counted(index[kept], rows[kept])
                cut = np.searchsorted(r, np.arange(len(p.starts) + 1))
                lists = lambda v: pa.ListArray.from_arrays(pa.array(cut.astype(np.int32)), pa.array(v))
                yield pa.record_batch({"positive": batch["positive"].slice(p.first, len(p.starts)),
                                       "feature": lists(place[f].astype(np.int32)), "n": lists(n),
                                       "words": pa.array(words)})
    return run


def values(n: np.ndarray) -> np.ndarray:
    return np.log1p(n)


def length_value(words: np.ndarray) -> np.ndarray:
    return np.log1p(words) / 5.0


class Rows(NamedTuple):
    """Sparse rows: features and values of row r lie from ``cut[r]`` to ``cut[r + 1]``."""
    cut: np.ndarray
    feature: np.ndarray
    value: np.ndarray

    def of(self, which: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Place in ``which``, feature and value of all entries of these rows."""
        n = self.cut[which + 1] - self.cut[which]
        at = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n - self.cut[which], n)
        return np.repeat(np.arange(len(which)), n), self.feature[at], self.value[at]


def fit(x: Rows, positive: np.ndarray, features: int, prior: float, seed: int, steps: int = STEPS) -> np.ndarray:
    """One linear classifier by Adam on the non-negative risk.  The last feature is the constant."""
    rng = np.random.default_rng(seed)
    pos, unl = np.flatnonzero(positive), np.flatnonzero(~positive)
    w, m, v = (np.zeros(features) for _ in range(3))
    w[-1] = np.log(prior / (1 - prior))
    for t in range(1, steps + 1):
        u, p = x.of(unl[rng.integers(0, len(unl), BATCH)]), x.of(pos[rng.integers(0, len(pos), BATCH)])
        zp, zu = (np.clip(np.bincount(r, w[f] * val, BATCH), -30, 30) for r, f, val in (p, u))
        sp, su = 1 / (1 + np.exp(-zp)), 1 / (1 + np.exp(-zu))
        summed = lambda part, of: np.bincount(part[1], of[part[0]] * part[2], features) / BATCH
        grad = prior * summed(p, sp - 1) + L2 * w
        if np.log1p(np.exp(zu)).mean() > prior * np.log1p(np.exp(zp)).mean():
            grad += summed(u, su) - prior * summed(p, sp)
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad * grad
        w = w - 0.02 * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.999 ** t)) + 1e-8)
    return w


def train(docs: DataFrame, labels: DataFrame, learn: Column, positives: int = POSITIVES,
          unlabelled: int = UNLABELLED, features: int = FEATURES) -> Model | None:
    """``learn``: condition on ``doc_id`` of the rows whose labels may be read."""
    said = (labels.filter(learn & F.col("doc_id").isNotNull() & F.col("toxic").isNotNull())
            .groupBy("doc_id").agg(F.max("toxic").alias("toxic")))
    seen = said.agg(F.count("*").alias("n"), F.count_if(F.col("toxic") == 1).alias("pos")).first()
    if not seen["pos"]:
        return None
    prior = min(0.95, max(1e-4, seen["pos"] / seen["n"]))
    drawn = lambda salt: F.pmod(F.xxhash64("doc_id", F.lit(salt)), F.lit(1 << 30)) / F.lit(float(1 << 30))
    # at most ``positives`` ids, so their size is bounded whatever the table's
    ids = (said.filter(F.col("toxic") == 1).orderBy(F.xxhash64("doc_id", F.lit("pos"))).limit(positives)
           .select("doc_id"))
    text = docs.select("doc_id", "text").filter(learn & F.col("doc_id").isNotNull())
    n_docs = max(1, docs.count())
    pos = text.join(F.broadcast(ids), "doc_id").select("text", F.lit(True).alias("positive")).limit(positives)
    unl = (text.filter(drawn("unl") < F.lit(1.2 * unlabelled / n_docs))
           .select("text", F.lit(False).alias("positive")).limit(unlabelled))
    sample = written(pos.unionByName(unl), "toxic-sample").repartition(16)
    n = {r["positive"]: r["count"] for r in sample.groupBy("positive").count().collect()}
    if not n.get(True) or not n.get(False):
        return None
    counts = sample.mapInArrow(_document_counts, "feature int, in_pos long, in_unl long").groupBy("feature").agg(
        F.sum("in_pos").alias("in_pos"), F.sum("in_unl").alias("in_unl"))
    a, b = (F.col("in_pos") + 0.5) / (n[True] + 1.0), (F.col("in_unl") + 0.5) / (n[False] + 1.0)
    pooled = (F.col("in_pos") + F.col("in_unl") + 1.0) / (n[True] + n[False] + 2.0)
    z = (a - b) / F.sqrt(pooled * (1 - pooled) * (1.0 / n[True] + 1.0 / n[False]))
    best = counts.filter(F.col("in_pos") >= 3).withColumn("z", z).filter(F.col("z") > 3).orderBy(
        F.desc("z"), "feature").limit(features).select("feature").toArrow()
    place = np.full(1 << HASH_BITS, -1, np.int32)
    place[best["feature"].to_numpy()] = np.arange(len(best), dtype=np.int32)
    rows = sample.mapInArrow(_rows_of(place), "positive boolean, feature array<int>, n array<long>, words long").toArrow()
    size = pc.list_value_length(rows["feature"]).to_numpy().astype(np.int64) + 2       # and length, and 1
    cut = np.concatenate([[0], np.cumsum(size)])
    feature, value = np.empty(cut[-1], np.int64), np.empty(cut[-1])
    feature[cut[1:] - 2], value[cut[1:] - 2] = len(best), length_value(rows["words"].to_numpy())
    feature[cut[1:] - 1], value[cut[1:] - 1] = len(best) + 1, 1
    counts = np.ones(cut[-1], bool)
    counts[cut[1:] - 2] = counts[cut[1:] - 1] = False
    feature[counts] = pc.list_flatten(rows["feature"]).to_numpy()
    value[counts] = values(pc.list_flatten(rows["n"]).to_numpy())
    x, positive = Rows(cut, feature, value), rows["positive"].to_numpy()
    w = np.mean([fit(x, positive, len(best) + 2, prior, seed) for seed in range(CLASSIFIERS)], axis=0)
    return Model(place, w, prior)


def score(docs: DataFrame, model: Model | None, keep: list[str], name: str = "score") -> DataFrame:
    """``keep`` columns plus ``name``, the score (0 to 1) of every row's whole text."""
    if model is None:
        return docs.select(*keep, F.lit(0.0).alias(name))
    shared = docs.sparkSession.sparkContext.broadcast(tuple(model))           # plain values only

    # only the text travels to the Python worker and only the score comes back; ``keep`` stays with Spark
    @F.arrow_udf("double")
    def scored(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        m = Model(*shared.value)
        for texts in batches:
            out = np.zeros(len(texts))
            for p in lowered(texts):
                index, rows, words = hashed_words(p)
                kept = m.place[index] >= 0
                r, f, n = counted(index[kept], rows[kept])
                z = np.bincount(r, m.weights[m.place[f]] * values(n), len(p.starts))      # of integers without a feature
                z = z + m.weights[-2] * length_value(words) + m.weights[-1]
                out[p.first:p.first + len(z)] = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
            yield pa.array(out)
    return docs.select(*keep, scored("text").alias(name))


def classify(docs: DataFrame, labels: DataFrame, folds: int = 5, held_out: int = 0) -> DataFrame:
    """Learns labels from all folds but one and scores every row."""
    out = fold(F.col("doc_id"), folds) == held_out
    model = train(docs, labels, out == F.lit(False))
    return score(docs.select("doc_id", "text"), model, ["doc_id"]).select(
        "doc_id", F.coalesce(out, F.lit(False)).alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"))
