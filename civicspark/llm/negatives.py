"""Hard-negative mining with bounds along spanning trees of the anchors.

For an anchor's positives (its best rows of the same label) the hard negatives
are the best rows of other labels whose score lies in the window from ``floor``
of the positive's score up to it.  Scores are integer inner products.

Anchors are dealt into blocks of near ones (nearest of some pivot anchors), rows
into blocks by hash; each block of anchors meets each block of rows once, in one
task.  There a minimum spanning tree links the anchors.  The root is scored
against every row.  Going down the tree, a row's score at an anchor lies within
``edge length * norm of the row`` of its score at the parent (Cauchy-Schwarz),
so the interval known at the parent, widened by that, bounds it:

1. positives: of the rows with the anchor's label only those are scored whose
   upper bound reaches the cell's ``positives``-th best so far;
2. negatives: of the other rows only those whose interval meets the window of a
   positive, and whose upper bound reaches that positive's last place so far.

A scored row's interval is its score, which narrows the bounds of the anchors
below.  Each cell sends a few rows per anchor (1) or per positive (2), ranked
over all cells afterwards.  Nothing is dropped by a bound that could be a
result; bounds only save products.

Defined cases: rows whose label, vector or id is null, or with a null or
non-finite component, take no part; rows that repeat an id count once (least
label, then least vector); vectors of different lengths never meet; ties go to
the smaller id; a negative positive score has an empty window.  Numbers beyond
2**53 are multiplied exactly, without bounds; a result that does not fit a
64-bit integer ends the run with an error.  Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from civicspark.llm.store import written

ROWS_PER_BLOCK = 32_768
ANCHORS_PER_BLOCK = 1_024
PIVOTS = 256                 # at most, whatever the number of anchors
LEAST_BLOCKS = 48            # cells at the smallest inputs, so that all cores have work
ROWS_AT_ONCE = 2_048         # rows whose intervals a task holds for all anchors of a block
SLACK = 1e-9                 # relative widening of bounds against rounding

FOUND = "anchor_id long, positive_id long, score long"
MINED = "anchor_id long, positive_id long, negative_id long, positive_score long, negative_score long"


def whole_vectors(rows: DataFrame, label: Column, scale: int) -> DataFrame:
    """Rows that take part as ``vec_id, label, vec`` (doubles without fractions), one per id."""
    scaled = lambda x: x.cast("double") * scale
    # from 2**52 on a double has no fraction, and floor() would leave the range of a long
    whole = F.transform("embedding", lambda x: F.when(F.abs(scaled(x)) < 2.0 ** 52, F.floor(scaled(x)).cast("double"))
                        .otherwise(scaled(x)))
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x)
                      & (F.abs(x) != F.lit(float("inf")).cast("double")))
    return (rows.filter(F.col("vec_id").isNotNull() & label.isNotNull() & F.col("embedding").isNotNull() & finite)
            .groupBy(F.col("vec_id").cast("long").alias("vec_id"))
            .agg(F.min(F.struct(label.cast("long").alias("label"), whole.alias("vec"))).alias("v"))
            .select("vec_id", "v.label", "v.vec"))


def spanning_tree(vectors: np.ndarray) -> list[tuple[int, int, float]]:
    """(anchor, parent, edge length) in an order that puts parents first; the root's parent is -1.
    Prim's algorithm on Euclidean distances."""
    n = len(vectors)
    v = vectors.astype(np.float64)
    norms = np.einsum("ij,ij->i", v, v)
    best, parent, out = np.full(n, np.inf), np.full(n, -1), []
    free = np.ones(n, bool)
    at = 0
    for _ in range(n):
        free[at] = False
        edge = float(np.sqrt(((v[at] - v[parent[at]]) ** 2).sum())) if parent[at] >= 0 else 0.0
        out.append((at, int(parent[at]), edge))
        distance = np.maximum(norms + norms[at] - 2.0 * (v @ v[at]), 0.0)
        nearer = free & (distance < best)
        best[nearer], parent[nearer] = distance[nearer], at
        at = int(np.argmin(np.where(free, best, np.inf))) if free.any() else at
    return out


class Scorer:
    """Exact inner products of one anchor block with some rows, and bounds for the rest."""

    def __init__(self, anchors: np.ndarray, rows: np.ndarray):
        most = (np.abs(anchors).max(initial=0.0) * np.abs(rows).max(initial=0.0)) * max(1, anchors.shape[1])
        self.exact = most < 2.0 ** 53              # every partial sum is a whole double
        kind = (lambda m: m) if self.exact else (lambda m: np.array([[int(x) for x in r] for r in m], object)
                                                 .reshape(m.shape))
        self.anchors, self.rows = kind(anchors), kind(rows)
        self.norms = np.sqrt(np.einsum("ij,ij->i", rows, rows)) if self.exact else None
        self.low: dict[int, np.ndarray] = {}
        self.high: dict[int, np.ndarray] = {}
        self.scored = 0

    def bounds(self, anchor: int, parent: int, edge: float) -> tuple[np.ndarray, np.ndarray]:
        """Intervals of all rows; without a parent (or beyond exact doubles) nothing is known."""
        n = len(self.rows)
        if parent < 0 or not self.exact:
            low, high = np.full(n, -np.inf), np.full(n, np.inf)
        else:
            wide = edge * self.norms
            wide += SLACK * (wide + 1.0)
            low, high = self.low[parent] - wide, self.high[parent] + wide
        self.low[anchor], self.high[anchor] = low, high
        return low, high

    def score(self, anchor: int, at: np.ndarray) -> np.ndarray:
        s = self.rows[at] @ self.anchors[anchor]
        if self.exact:
            self.low[anchor][at] = self.high[anchor][at] = s
        self.scored += len(at)
        return s


def _matrix(column) -> np.ndarray:
    flat = pc.list_flatten(column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column)
    return flat.to_numpy(zero_copy_only=False).reshape(len(column), -1)


def _cells(cell: pa.Table) -> Iterator[tuple[pa.Table, np.ndarray, np.ndarray, np.ndarray, list, np.ndarray]]:
    """(anchors, row ids, labels, vectors, tree, anchor vectors) per vector length and bunch of rows, ids in order."""
    cell = cell.sort_by("vec_id")
    lengths = pc.list_value_length(cell["vec"]).to_numpy()
    for length in np.unique(lengths):
        part = cell.filter(pa.array(lengths == length))
        is_anchor = part["is_anchor"].to_numpy()
        anchors, rows = part.filter(pa.array(is_anchor)), part.filter(pa.array(~is_anchor))
        if not len(anchors) or not len(rows):
            continue
        vectors = _matrix(anchors["vec"])
        tree = spanning_tree(vectors)
        ids, labels, others = rows["vec_id"].to_numpy(), rows["label"].to_numpy(), _matrix(rows["vec"])
        for at in range(0, len(ids), ROWS_AT_ONCE):
            end = at + ROWS_AT_ONCE
            yield anchors, ids[at:end], labels[at:end], others[at:end], tree, vectors


def _best(found: tuple[np.ndarray, np.ndarray], ids: np.ndarray, s: np.ndarray, k: int):
    """The k best (scores, ids) of those found before and the new ones, ties to smaller ids."""
    s, ids = np.concatenate([found[0], s]), np.concatenate([found[1], ids])
    order = np.lexsort((ids, -s))[:k]
    return s[order], ids[order]


def _longs(values: list) -> pa.Array:
    return pa.array([int(v) for v in values], pa.int64())


def positives_cell(k: int):
    def find(cell: pa.Table) -> pa.Table:
        best: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for anchors, ids, labels, rows, tree, vectors in _cells(cell):
            a_ids, a_labels = anchors["vec_id"].to_numpy(), anchors["label"].to_numpy()
            m = Scorer(vectors, rows)
            for a, parent, edge in tree:
                _, high = m.bounds(a, parent, edge)
                found = best.setdefault(int(a_ids[a]), (np.empty(0), np.empty(0, np.int64)))
                fits = (labels == a_labels[a]) & (ids != a_ids[a])
                if parent < 0:
                    s = m.score(a, np.arange(len(ids)))
                    at = np.nonzero(fits)[0]
                    s = s[at]
                else:
                    if len(found[0]) == k:
                        fits &= high >= found[0][-1]
                    at = np.nonzero(fits)[0]
                    s = m.score(a, at)
                if len(at):
                    best[int(a_ids[a])] = _best(found, ids[at], s, k)
        out = [(a, i, s) for a, (scores, found) in best.items() for s, i in zip(scores, found)]
        columns = list(zip(*out)) or [[], [], []]
        return pa.table([_longs(c) for c in columns], names=["anchor_id", "positive_id", "score"])
    return find


def window_low(score: int, floor: int) -> int:
    """Least score n with ``floor * score <= 100 * n``."""
    return -(-floor * score // 100)


def negatives_cell(k: int, floor: int):
    def find(cell: pa.Table) -> pa.Table:
        best: dict[tuple[int, int], tuple[np.ndarray, np.ndarray]] = {}
        scores: dict[tuple[int, int], int] = {}
        nothing = (np.empty(0), np.empty(0, np.int64))
        for anchors, ids, labels, rows, tree, vectors in _cells(cell):
            a_ids, a_labels = anchors["vec_id"].to_numpy(), anchors["label"].to_numpy()
            wanted = anchors["positives"].to_pylist()
            m = Scorer(vectors, rows)
            for a, parent, edge in tree:
                low, high = m.bounds(a, parent, edge)
                windows = []
                for p in wanted[a]:
                    key = int(a_ids[a]), p["positive_id"]
                    scores[key] = p["score"]
                    found = best.get(key, nothing)
                    least = found[0][-1] if len(found[0]) == k else None
                    bottom = window_low(p["score"], floor)
                    if bottom <= p["score"]:
                        windows.append((key, bottom, p["score"], bottom if least is None else max(bottom, least)))
                if parent < 0:
                    s = m.score(a, np.arange(len(ids)))
                    at = np.nonzero(labels != a_labels[a])[0]
                    s = s[at]
                else:
                    meets = np.zeros(len(ids), bool)
                    for _, _, top, reach in windows:
                        meets |= (high >= reach) & (low <= top)
                    at = np.nonzero(meets & (labels != a_labels[a]))[0]
                    s = m.score(a, at)
                if not windows or not len(at):
                    continue
                inside = (s >= min(w[3] for w in windows)) & (s <= max(w[2] for w in windows))
                s, found_ids = s[inside], ids[at[inside]]
                if not len(s):
                    continue
                order = np.lexsort((found_ids, -s))
                down, found_ids = -s[order], found_ids[order]           # ascending
                for key, bottom, top, _ in windows:
                    i = int(np.searchsorted(down, -top, side="left"))
                    j = min(int(np.searchsorted(down, -bottom, side="right")), i + k)
                    if j > i:
                        best[key] = _best(best.get(key, nothing), found_ids[i:j], -down[i:j], k)
        out = [(a, p, i, scores[a, p], s) for (a, p), (top, found) in best.items() for s, i in zip(top, found)]
        columns = list(zip(*out)) or [[]] * 5
        return pa.table([_longs(c) for c in columns],
                        names=["anchor_id", "positive_id", "negative_id", "positive_score", "negative_score"])
    return find


def _near_blocks(anchors: DataFrame, n: int) -> DataFrame:
    """``anchors`` plus ``q``: a block of at most about ANCHORS_PER_BLOCK that share their nearest pivot.
    A pivot's anchors beyond that are parted by hash, however many copies of one vector there are."""
    if n <= ANCHORS_PER_BLOCK:
        return anchors.withColumn("q", F.lit(0))
    pivots = min(PIVOTS, -(-n // ANCHORS_PER_BLOCK))
    drawn = anchors.orderBy(F.xxhash64("vec_id"), "vec_id").limit(pivots).select("vec").toPandas()["vec"]
    lengths = {len(v): [w for w in drawn if len(w) == len(v)] for v in drawn}

    def nearest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matrices = {length: np.array(v, np.float64) for length, v in lengths.items()}
        for batch in batches:
            out = []
            for v in batch["vec"].to_pylist():
                m = matrices.get(len(v))
                out.append(0 if m is None else int(np.argmin(((m - np.array(v, np.float64)) ** 2).sum(1))))
            yield pa.record_batch([batch["vec_id"], pa.array(out, pa.int32())], names=["vec_id", "pivot"])
    near = written(anchors.select("vec_id", "vec").mapInArrow(nearest, "vec_id long, pivot int"), "pivots")
    # at most PIVOTS rows
    sizes = {r["pivot"]: r["count"] for r in near.groupBy("pivot").count().collect()}
    first, parts, upto = {}, {}, 0
    for pivot, size in sorted(sizes.items()):
        first[pivot], parts[pivot] = upto, -(-size // ANCHORS_PER_BLOCK)
        upto += parts[pivot]
    table = anchors.sparkSession.createDataFrame([(p, first[p], parts[p]) for p in first], "pivot int, first int, parts int")
    block = F.col("first") + F.pmod(F.xxhash64("vec_id"), F.col("parts")).cast("int")
    return anchors.join(near.join(F.broadcast(table), "pivot").select("vec_id", block.alias("q")), "vec_id")


def _grouped(base: DataFrame, anchors: DataFrame, blocks: int, q_blocks: int):
    """Rows once per block of anchors, anchors once per block of rows."""
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    none = F.lit(None).cast("array<struct<positive_id:long,score:long>>")
    rows = base.select("vec_id", "label", "vec", F.lit(False).alias("is_anchor"), none.alias("positives"),
                       F.pmod(F.xxhash64("vec_id"), F.lit(blocks)).cast("int").alias("c"), every(q_blocks).alias("q"))
    them = anchors.select("vec_id", "label", "vec", F.lit(True).alias("is_anchor"), "positives",
                          every(blocks).alias("c"), "q")
    return rows.unionByName(them).groupBy("c", "q")


def hard_negatives(rows: DataFrame, label: Column, is_anchor: Column, scale: int = 256, positives: int = 5,
                   negatives: int = 5, floor: int = 80) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``: for each anchor and
    each of its ``positives`` best rows of the same label, the first ``negatives`` rows of other labels that
    score at least ``floor`` percent of the positive's score and at most as much."""
    base = written(whole_vectors(rows, label, scale), "negative-vectors")
    size = base.agg(F.count("*").alias("n"), F.count_if(is_anchor).alias("anchors")).first()
    blocks = max(LEAST_BLOCKS, -(-size["n"] // ROWS_PER_BLOCK))
    anchors = written(_near_blocks(base.filter(is_anchor), size["anchors"]), "anchors")
    q_blocks = (anchors.agg(F.max("q")).first()[0] or 0) + 1

    none = F.lit(None).cast("array<struct<positive_id:long,score:long>>")
    found = _grouped(base, anchors.withColumn("positives", none), blocks, q_blocks).applyInArrow(
        positives_cell(positives), FOUND)
    first = Window.partitionBy("anchor_id").orderBy(F.desc("score"), "positive_id")
    chosen = (found.withColumn("nth", F.row_number().over(first)).filter(F.col("nth") <= positives)
              .groupBy(F.col("anchor_id").alias("vec_id"))
              .agg(F.sort_array(F.collect_list(F.struct("positive_id", "score"))).alias("positives")))
    with_positives = written(anchors.join(chosen, "vec_id"), "positives")

    mined = _grouped(base, with_positives, blocks, q_blocks).applyInArrow(negatives_cell(negatives, floor), MINED)
    best = Window.partitionBy("anchor_id", "positive_id").orderBy(F.desc("negative_score"), "negative_id")
    return (mined.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= negatives)
            .select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"))
