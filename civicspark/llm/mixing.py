"""Mixing documents to target domain weights by soft membership, in DataFrame functions only.

Domains are the classes of a labelled table.  A naive Bayes classifier gives
every document a posterior over the domains: from its distinct words, hashed to
BUCKETS, of which those count that tell a domain from the others (a z-score of
at least Z_LEAST), and from binned numbers of words, their length and variety.
It learns from at most ``per_domain`` labelled documents of each domain, drawn by
a hash of the id (a bound of what is learned from; the classes' shares are
counted over all labels).

A document with n words and posterior p adds n * p to the domains' token totals,
times its rate; rates of at least ``least`` (0, or 1 to keep all documents) are
fitted so that the expected totals meet the targets, by projected gradient
descent on the weighted least squares of the gap.  In the metric of the
documents' sizes a step is

    rate <- max(least, rate - p . c),     c = M^-1 (totals - targets)

with M the second moment of the posteriors of the documents whose rate is above
``least``; should a step overshoot, the next one takes M over all documents, with
which it cannot.  A round adds up totals and moments over all documents; the
driver solves a system of the size of the domains.  A rate is a function of the
posterior and the steps so far, so rounds read one small table and write none.
Rounds go on until the gap is below TOLERANCE or has not fallen for STALL rounds;
the steps of the best round are taken, and ``gap`` reports what it left.

Targets are shares of the token budget; a domain without a target or without a
labelled row has no part, and shares are scaled to the others.  ``copies`` turns
a rate into a whole number of copies whose expectation is the rate, by a hash of
the row, so runs agree.

Defined cases: a null or empty text has no words; its rate follows its posterior
and changes no total.  Without labels there is one domain: posterior 1, rate 1.
A document with several labels counts in each.  Repeated rows are rows of their
own.  Columns beside the keys and the text are not read.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from civicspark.llm.store import written

BINS = 16
BUCKETS = 1 << 13            # hashed words
Z_LEAST = 4.0
PER_DOMAIN = 5_000           # labelled documents of a domain that are learned from
STALL, TOLERANCE = 12, 1e-5  # rounds without a smaller gap; gap of a domain, in shares of the budget
ROOM = 1.25                  # of the least budget that keeps all documents
ALL = "all"                  # the one domain there is without labels


def described(docs: DataFrame, keys: list[str]) -> DataFrame:
    """``keys``, ``tokens``, the distinct hashed words ``w`` and the bins ``b`` of whole texts."""
    text = F.lower(F.coalesce("text", F.lit("")))
    words = F.transform(F.filter(F.split(text, r"\s+"), lambda w: w != ""), lambda w: F.xxhash64(w))
    cut = docs.select(*keys, F.length(text).alias("chars"), words.alias("words"))
    cut = cut.select(*keys, "chars", F.size("words").cast("long").alias("tokens"), F.array_distinct("words").alias("w"))
    n = F.greatest("tokens", F.lit(1))
    bins = F.array(F.floor(F.least(F.log2(F.col("tokens") + 1.0), F.lit(BINS - 1.0))),
                   F.least(F.floor(F.greatest("chars", F.lit(1)) / n), F.lit(BINS - 1)),
                   F.floor(F.least(F.size("w") / n, F.lit(0.999)) * BINS))
    return cut.select(*keys, "tokens", "w", bins.cast("array<int>").alias("b"))


KINDS = 3                    # of bins


class Classifier:
    """Log weights of the domains: prior, words (by bucket), and bins (by kind and bin)."""

    def __init__(self, prior: np.ndarray, n: np.ndarray, words: np.ndarray, bins: np.ndarray):
        p = (words + 0.5) / (n[:, None] + 1.0)
        share = prior / prior.sum()
        pooled = (words.sum(0) + 0.5) / (n.sum() + 1.0)
        self.words = np.log(p) - np.log(share @ p)
        for d in range(len(n)):
            rest = n.sum() - n[d]
            q = (words.sum(0) - words[d] + 0.5) / (rest + 1.0)
            z = (p[d] - q) / np.sqrt(pooled * (1 - pooled) * (1 / n[d] + 1 / max(rest, 1e-9)))
            self.words[d][np.abs(z) < Z_LEAST] = 0.0
        self.prior = np.log(share)
        self.bins = np.log((bins + 0.5) / (n[:, None, None] + 0.5 * BINS))

    def scored(self, rows: DataFrame) -> DataFrame:
        """``rows`` (``described``) with their posterior ``p`` in place of words and bins.  Each step is a
        column of its own, so a sum over a text's words is made once."""
        numbers = lambda x: F.expr("array(" + ", ".join(f"{v:.9g}D" for v in x) + ")")
        log = []
        for d in range(len(self.prior)):
            at = lambda h, d=d: F.get(numbers(self.words[d]), F.pmod(h, F.lit(BUCKETS)).cast("int"))
            parts = [F.aggregate("w", F.lit(float(self.prior[d])), lambda s, h: s + at(h))]
            parts += [F.get(numbers(self.bins[d][f]), F.get("b", F.lit(f))) for f in range(KINDS)]
            log.append(sum(parts[1:], parts[0]))
        keep = [c for c in rows.columns if c not in ("w", "b")]
        logs = rows.select(*keep, F.array(*log).alias("log"))
        tops = logs.select(*keep, "log", F.array_max("log").alias("top"))
        odds = tops.select(*keep, F.transform("log", lambda x: F.exp(x - F.col("top"))).alias("odds"))
        whole = odds.select(*keep, "odds", F.aggregate("odds", F.lit(0.0), lambda s, o: s + o).alias("whole"))
        return whole.select(*keep, F.transform("odds", lambda o: o / F.col("whole")).alias("p"))


def learn(docs: DataFrame, said: DataFrame, domains: list[str], per_domain: int = PER_DOMAIN) -> Classifier:
    """Counts of the drawn labelled documents.  ``said``: ``l_doc`` and ``domain``, distinct."""
    prior = {r["domain"]: r["count"] for r in said.groupBy("domain").count().collect()}
    turn = F.row_number().over(Window.partitionBy("domain").orderBy(F.xxhash64("l_doc", F.lit("drawn")), "l_doc"))
    drawn = said.withColumn("turn", turn).filter(F.col("turn") <= per_domain).select("l_doc", "domain")
    # at most ``per_domain`` ids of each domain, so their size is bounded whatever the table's
    rows = written(described(docs.select(F.col("doc_id").alias("l_doc"), "text").join(F.broadcast(drawn), "l_doc"),
                             ["domain"]), "learned-from")
    size = {r["domain"]: r["count"] for r in rows.groupBy("domain").count().collect()}
    bucket = F.explode(F.transform("w", lambda h: F.pmod(h, F.lit(BUCKETS)).cast("int"))).alias("bucket")
    words = rows.select("domain", bucket).groupBy("domain", "bucket").count().collect()          # domains x BUCKETS
    bins = rows.select("domain", F.posexplode("b").alias("f", "bin")).groupBy("domain", "f", "bin").count().collect()
    at = {d: i for i, d in enumerate(domains)}
    n, w, b = np.zeros(len(at)), np.zeros((len(at), BUCKETS)), np.zeros((len(at), KINDS, BINS))
    for d, i in at.items():
        n[i] = size.get(d, 0)
    for r in words:
        w[at[r["domain"]], r["bucket"]] = r["count"]
    for r in bins:
        b[at[r["domain"]], r["f"], r["bin"]] = r["count"]
    # two words of a document may share a bucket: no share is above 1
    return Classifier(np.array([prior[d] for d in domains], float), np.maximum(n, 1.0), np.minimum(w, n[:, None]), b)


def _rate(steps: list[list[float]], k: int, least: float) -> Column:
    """Rate after the given steps: a fold over them, starting from 1."""
    if not steps:
        return F.lit(1.0)
    past = F.expr("array(" + ", ".join("array(" + ", ".join(f"{x!r}D" for x in c) + ")" for c in steps) + ")")
    dot = lambda c: sum((F.col("p")[i] * c[i] for i in range(1, k)), F.col("p")[0] * c[0])
    return F.aggregate(past, F.lit(1.0), lambda r, c: F.greatest(F.lit(least), r - dot(c)))


def fit_rates(table: DataFrame, targets: list[float], keep_all: bool = False) -> tuple[Column, float]:
    """Rate of each row of ``table`` (``tokens``, posterior ``p``), as a Column, and the largest gap of a
    domain that is left, in shares of the budget.

    ``keep_all``: no rate is below 1, with a budget of ROOM times what the targets then need; else the
    budget is the tokens there are."""
    k, least = len(targets), float(keep_all)
    p, weight = [F.col("p")[i] for i in range(k)], F.col("tokens").cast("double")
    share = np.array(targets) / sum(targets)
    steps: list[list[float]] = []
    best, best_steps, since = math.inf, 0, 0
    whole, budget = None, 0.0
    while since < STALL:
        rate = F.col("rate")
        moves = rate > least if steps else F.lit(True)
        cells = {f"m{i}_{j}": F.sum(F.when(moves, weight * p[i] * p[j]).otherwise(0.0)) for i in range(k) for j in range(i + 1)}
        totals = {f"t{i}": F.sum(rate * weight * p[i]) for i in range(k)}
        row = table.withColumn("rate", _rate(steps, k, least)).agg(*[c.alias(n) for n, c in {**cells, **totals}.items()]).first()
        have = np.array([row[f"t{i}"] or 0.0 for i in range(k)])
        moment = np.array([[row[f"m{max(i, j)}_{min(i, j)}"] or 0.0 for j in range(k)] for i in range(k)])
        if whole is None:
            if have.sum() <= 0:
                return _rate([], k, least), 0.0
            whole, budget = moment, max(have / share) * ROOM if keep_all else have.sum()
        gap = have - share * budget
        worst = float(np.abs(gap).max() / budget)
        fell = worst < best
        if fell:
            best, best_steps, since = worst, len(steps), 0
        else:
            since += 1
        if best <= TOLERANCE:
            break
        # the rows that still move, unless the last step by them overshot
        use = moment if fell else whole
        steps.append(np.linalg.solve(use + np.eye(k) * 1e-9 * np.trace(whole), gap).tolist())
    return _rate(steps[:best_steps], k, least), best


def copies(rate: Column, *keys: Column) -> Column:
    """Whole copies with expectation ``rate``."""
    u = F.pmod(F.xxhash64(*keys, F.lit("copies")), F.lit(1 << 30)) / F.lit(float(1 << 30))
    return (F.floor(rate) + (u < rate - F.floor(rate)).cast("int")).cast("int")


def mix(docs: DataFrame, labels: DataFrame, domain: Column, targets: dict[str, float],
        keys: list[str] | None = None, keep_all: bool = False) -> DataFrame:
    """``keys``, ``tokens``, one posterior ``p_<domain>`` per target, ``rate`` and ``copies`` of every document,
    and the ``gap`` that the fit left (the same in all rows).

    ``domain`` names a label row's domain; ``targets`` gives the shares of tokens."""
    keys = keys or ["doc_id"]
    wanted = labels.select(F.col("doc_id").alias("l_doc"), domain.alias("domain")).filter(F.col("domain").isin(*targets))
    said = wanted.filter(F.col("l_doc").isNotNull()).distinct()
    known = {r["domain"] for r in said.join(docs.select(F.col("doc_id").alias("l_doc")), "l_doc", "left_semi")
             .select("domain").distinct().collect()}
    names = [d for d in targets if d in known and targets[d] > 0]
    rows = described(docs, keys)
    if names:
        rows = learn(docs, said.filter(F.col("domain").isin(*names)), names).scored(rows)
    else:
        rows = rows.select(*keys, "tokens", F.array(F.lit(1.0)).alias("p"))
    soft = written(rows, "posteriors")
    rate, gap = fit_rates(soft, [targets[d] for d in names] if names else [1.0], keep_all)
    at = {d: i for i, d in enumerate(names)}
    shown = [(F.col("p")[at[d]] if d in at else F.lit(0.0)).alias(f"p_{d}") for d in targets]
    return soft.withColumn("rate", rate).select(
        *keys, "tokens", *shown, "rate", copies(F.col("rate"), *[F.col(c) for c in keys]).alias("copies"),
        F.lit(gap).alias("gap"))
