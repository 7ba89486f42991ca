"""Language identification with error-correcting output codes.

Every language gets a codeword of bits; one binary classifier per bit (logistic
regression on byte trigram frequencies, numpy) predicts that bit.  Decoding
takes the codeword with the least weighted loss: the logistic loss of each
bit's margin, weighted by how well that bit's classifier did on that language
in training, so a weak bit cannot outvote good ones.  Up to six languages get
the exhaustive code (every way to part them once), more get the best of seeded
random codes by least distance between two words.

Training uses at most ``per_lang`` labelled texts per language, drawn by a hash
of ``doc_id``; the counts behind the draw cover all rows.  Prediction reads
every whole text and nothing else.

Defined cases: a text that is null or has no letter is ``und`` with score 0;
rows without an id are predicted and not learned from; if no language is known,
all texts are ``und``; with one, every text with a letter is that language;
equal losses go to the first language in order.  ``ambiguous`` marks texts whose
two best codewords are closer than ``margin``.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from civicspark.llm.text_bytes import Piece, pieces

BITS = 12                  # features: hashed byte trigrams
PER_LANG = 500             # bound of the training sample, texts per language
MARGIN = 0.5
PREDICTED = "lang_pred string, score double, ambiguous boolean"


class Model(NamedTuple):
    langs: list[str]
    code: np.ndarray        # languages x bits, +1 and -1
    trust: np.ndarray       # languages x bits, rows sum to 1
    weights: np.ndarray     # (features + 1) x bits; the last row is zero
    bias: np.ndarray


def fold(doc_id: Column, folds: int) -> Column:
    """Remainder of the id's checksum; null for a null id."""
    return F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(folds))


def codewords(classes: int, seed: int = 7) -> np.ndarray:
    """One row of +1 and -1 per class."""
    if classes <= 6:
        rest = list(itertools.product((1, -1), repeat=max(0, classes - 1)))[1:]   # the first class is +1
        return np.array([[1] * len(rest)] + [[r[c] for r in rest] for c in range(classes - 1)],
                        np.int8).reshape(classes, -1)
    rng, length = np.random.default_rng(seed), 10 * int(np.ceil(np.log2(classes)))
    best, best_d = None, -1
    for _ in range(200):
        code = rng.choice(np.array([1, -1], np.int8), (classes, length))
        same = (code.astype(int) @ code.T)[np.triu_indices(classes, 1)]
        d = int(((length - same) // 2).min()) if np.abs(code.sum(0)).max() < classes else 0
        if d > best_d:
            best, best_d = code, d
    return best


def trigrams(piece: Piece) -> np.ndarray:
    """Feature of the trigram that starts at each byte; ``2**BITS`` where it would leave its text."""
    b = piece.data.astype(np.uint32)
    h = np.full(len(b), 1 << BITS, np.int64)
    if len(b) > 2:
        code = b[:-2] | (b[1:-1] << np.uint32(8)) | (b[2:] << np.uint32(16))
        h[:-2] = (code * np.uint32(2654435761)) >> np.uint32(32 - BITS)
    for back in range(2):            # the space behind a text still ends a trigram
        at = piece.ends - back
        h[at[at >= piece.starts]] = 1 << BITS
    return h


def normal(texts: pa.Array) -> pa.Array:
    return pc.utf8_lower(pc.fill_null(texts, ""))


def has_letter(texts: pa.Array) -> np.ndarray:
    return pc.match_substring_regex(pc.fill_null(texts, ""), r"\p{L}").to_numpy(zero_copy_only=False)


def _frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for p in pieces(normal(batch["text"])):
            h = trigrams(p)
            rows = []
            for s, e in zip(p.starts, p.ends):
                n = np.bincount(h[s:e + 1], minlength=(1 << BITS) + 1)[:-1].astype(np.float32)
                rows.append((n / max(1, n.sum())).astype(np.float32).tobytes())
            yield pa.record_batch({"lang": batch["lang"].slice(p.first, len(rows)),
                                   "x": pa.array(rows, pa.binary())})


def training_sample(docs: DataFrame, learn: Column, per_lang: int) -> DataFrame:
    """At most ``per_lang`` texts with a letter of each language, as ``lang``, ``text``."""
    known = docs.select("doc_id", "text", "lang").filter(
        learn & F.col("lang").isNotNull() & F.col("doc_id").isNotNull())
    # one row per language; half as many again are drawn, the surplus is cut below
    share = known.groupBy("lang").agg((F.lit(1.5 * per_lang) / F.count("*")).alias("share"))
    drawn = F.pmod(F.xxhash64("doc_id", F.lit("draw")), F.lit(1 << 30)) / F.lit(float(1 << 30))
    sample = (known.join(F.broadcast(share), "lang").filter(drawn < F.col("share"))
              .filter(F.col("text").rlike(r"\p{L}")).withColumn("at", drawn))
    first = Window.partitionBy("lang").orderBy("at", "doc_id")
    return sample.withColumn("n", F.row_number().over(first)).filter(F.col("n") <= per_lang).select("lang", "text")


def _logistic(x: np.ndarray, y: np.ndarray, rounds: int = 120, l2: float = 1e-2) -> np.ndarray:
    """One logistic regression per column of ``y`` (+1, -1), all by Nesterov's method."""
    w = np.zeros((x.shape[1], y.shape[1]), np.float32)
    ahead, step = w.copy(), 0.0
    v = np.ones(x.shape[1], np.float32)
    for _ in range(8):                                  # largest eigenvalue, for the step
        v = x.T @ (x @ v)
        v /= max(np.linalg.norm(v), 1e-12)
    step = 1.0 / (0.25 * float(np.linalg.norm(x.T @ (x @ v))) / len(x) * 1.1 + l2)
    for t in range(rounds):
        z = np.clip(y * (x @ ahead), -30, 30)
        grad = x.T @ (-y / (1 + np.exp(z))) / len(x) + l2 * ahead
        new = ahead - np.float32(step) * grad
        ahead = new + np.float32(t / (t + 3)) * (new - w)
        w = new
    return w


def train(docs: DataFrame, learn: Column, per_lang: int = PER_LANG) -> Model | None:
    """Fits the model on the bounded sample; None if no language is known."""
    features = training_sample(docs, learn, per_lang).mapInArrow(_frequencies, "lang string, x binary").toArrow()
    if not len(features):
        return None
    x = np.stack([np.frombuffer(b, np.float32) for b in features["x"].to_pylist()])
    names = np.array(features["lang"].to_pylist())
    langs = sorted(set(names.tolist()))
    which = np.searchsorted(langs, names)
    code = codewords(len(langs))
    if len(langs) == 1:
        return Model(langs, code, np.ones((1, 0)), np.zeros(((1 << BITS) + 1, 0), np.float32), np.zeros(0))
    mean, spread = x.mean(0), x.std(0) + 1e-4
    x = (x - mean) / spread
    ones = np.ones((len(x), 1), np.float32)
    y = code[which].astype(np.float32)
    w = _logistic(np.hstack([x, ones]), y)
    margins = np.hstack([x, ones]) @ w
    right = np.stack([(margins[which == k] * code[k] > 0).mean(0) for k in range(len(langs))])
    trust = (right + 1e-6) / (right + 1e-6).sum(1, keepdims=True)
    weights = w[:-1] / spread[:, None]
    return Model(langs, code, trust, np.vstack([weights, np.zeros((1, weights.shape[1]))]).astype(np.float32),
                 (w[-1] - (mean / spread) @ w[:-1]).astype(np.float64))


def decode(model: Model, margins: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Index of the nearest codeword, its softmax score, distance to the second best."""
    z = np.clip(margins[:, None, :] * model.code[None], -50, 50)
    loss = (np.log1p(np.exp(-z)) * model.trust[None]).sum(2)
    best = loss.argmin(1)
    odds = np.exp(-(loss - loss.min(1, keepdims=True)) * 4)
    gap = np.sort(loss, 1)[:, 1] - loss.min(1) if loss.shape[1] > 1 else np.full(len(loss), np.inf)
    return best, odds.max(1) / odds.sum(1), gap


def predict(docs: DataFrame, model: Model | None, keep: list[str], margin: float = MARGIN) -> DataFrame:
    """``keep`` columns plus ``lang_pred``, ``score``, ``ambiguous`` of every row's whole text."""
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(*keep).schema)
    shared = docs.sparkSession.sparkContext.broadcast(tuple(model) if model else None)   # plain values only

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = Model(*shared.value) if shared.value else None
        for batch in batches:
            n = batch.num_rows
            letters = has_letter(batch["_text"])
            names, score, unsure = np.full(n, "und", object), np.zeros(n), np.ones(n, bool)
            if m is not None:
                margins = np.zeros((n, m.code.shape[1]))
                for p in pieces(normal(batch["_text"])):
                    h = trigrams(p)
                    sums = np.add.reduceat(m.weights[h], p.starts, axis=0) if len(m.bias) else np.zeros((len(p.starts), 0))
                    grams = np.maximum(1, p.ends - p.starts - 1)
                    margins[p.first:p.first + len(p.starts)] = sums / grams[:, None] + m.bias
                best, s, gap = decode(m, margins) if len(m.langs) > 1 else (np.zeros(n, int), np.ones(n), np.full(n, 9.))
                names[letters] = np.array(m.langs, object)[best[letters]]
                score[letters], unsure[letters] = s[letters], gap[letters] < margin
            yield pa.record_batch([*(batch[c] for c in keep), pa.array(names.tolist(), pa.string()),
                                   pa.array(score), pa.array(unsure)],
                                  names=[*keep, "lang_pred", "score", "ambiguous"])
    return docs.select(*keep, F.col("text").alias("_text")).mapInArrow(run, f"{kinds}, {PREDICTED}")


def identify(docs: DataFrame, folds: int = 4, held_out: int = 2, per_lang: int = PER_LANG) -> DataFrame:
    """Learns from all folds but one and predicts every row."""
    out = fold(F.col("doc_id"), folds) == held_out
    model = train(docs, out == F.lit(False), per_lang)
    return predict(docs.select("doc_id", "text"), model, ["doc_id"]).select(
        "doc_id", F.coalesce(out, F.lit(False)).alias("held_out"), "lang_pred", "score", "ambiguous")
