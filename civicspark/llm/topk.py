"""Exact top-k inner products by distributed histogram selection.

Every query is scored against every candidate, in blocks: candidates are dealt
into blocks, each block meets each block of queries once, and a task scores one
such cell with a matrix product.  No score leaves a task by itself:

1. each cell sends, per query, how many scores fall into each of ``bins`` equal
   bins of the query's current range, from the top down until the cell alone
   has seen k (lower bins cannot hold the kth score of all);
2. the counts of all cells are added, and the bin that holds the kth score
   becomes the query's next range; this repeats until a bin is one score wide,
   which is the kth score itself;
3. a last pass sends the scores above the kth, and of those equal to it the k
   smallest ids per cell; ranking them gives the result, ties to smaller ids.

Rounds needed: the logarithm of the score range to the base ``bins``.  A range
starts at the Cauchy-Schwarz bound, so it holds every score.  Ranges and counts
stay in DataFrames; the driver only sees the largest width that is left.

Vectors are turned into integers by ``floor(scale * x)``.  Defined cases: a
vector that is null or holds a null or non-finite component, and a row without
an id, take no part; rows that repeat an id count once (the smallest vector, if
they differ); vectors of different lengths are no candidates of each other; a
query with fewer than k candidates gets all of them.  A component or score that
does not fit a 64-bit integer ends the run with an error instead of a wrong
result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from civicspark.llm.store import written

BINS = 256
CANDIDATES_PER_BLOCK = 32_768
QUERIES_PER_BLOCK = 4_096
LEAST_BLOCKS = 48           # cells at the smallest inputs, so that all cores have work
SCORES_AT_ONCE = 2_000_000  # entries of one partial score matrix (16 MB)

HISTOGRAM = "query_id long, bin int, n long"
FOUND = "query_id long, vec_id long, score long"


def integer_vectors(vectors: DataFrame, id_col: str, vec_col: str, scale: int = 64) -> DataFrame:
    """Valid vectors as ``vec_id``, ``vec`` (array of long), one row per id."""
    whole = F.transform(vec_col, lambda x: F.floor(x.cast("double") * scale).cast("long"))
    finite = F.forall(vec_col, lambda x: x.isNotNull() & ~F.isnan(x)
                      & (F.abs(x) != F.lit(float("inf")).cast("double")))
    return (vectors.filter(F.col(id_col).isNotNull() & F.col(vec_col).isNotNull() & finite)
            .groupBy(F.col(id_col).cast("long").alias("vec_id")).agg(F.min(whole).alias("vec")))


def _matrix(column: pa.Array) -> np.ndarray:
    """Equally long lists as rows of a matrix of 64-bit integers."""
    values = column.flatten().to_numpy(zero_copy_only=False)
    return values.reshape(len(column), -1)


def _by_length(table: pa.Table) -> dict[int, pa.Table]:
    lengths = pa.compute.list_value_length(table["vec"]).to_numpy()
    return {int(n): table.filter(pa.array(lengths == n)) for n in np.unique(lengths)}


def _scores(cell: pa.Table) -> Iterator[tuple[pa.Table, np.ndarray, np.ndarray]]:
    """Blocks (queries, candidate ids, scores); a query's own row scores the least integer."""
    is_query = cell["lo"].is_valid()
    queries, others = _by_length(cell.filter(is_query)), _by_length(cell.filter(pa.compute.invert(is_query)))
    for length, q in queries.items():
        if length not in others:
            continue
        c = others[length].combine_chunks()
        q = q.combine_chunks()
        c_ids = c["vec_id"].to_numpy()
        cm, qm = _matrix(c["vec"].combine_chunks()), _matrix(q["vec"].combine_chunks())
        # float64 products are exact (and fast) while no partial sum can reach 2**53
        most = float(np.abs(cm).max(initial=0)) * float(np.abs(qm).max(initial=0)) * max(1, length)
        if most >= 2.0 ** 62:
            raise OverflowError("an inner product may not fit a 64-bit integer")
        kind = np.float64 if most < 2.0 ** 53 else np.int64
        cm = cm.astype(kind).T
        step = max(1, SCORES_AT_ONCE // max(1, len(c_ids)))
        for at in range(0, len(q), step):
            part = q.slice(at, step)
            s = (qm[at:at + step].astype(kind) @ cm).astype(np.int64)
            own = np.searchsorted(c_ids, ids := part["vec_id"].to_numpy())
            own_hit = (own < len(c_ids)) & (c_ids[np.minimum(own, len(c_ids) - 1)] == ids)
            s[np.nonzero(own_hit)[0], own[own_hit]] = np.iinfo(np.int64).min
            yield part, c_ids, s


def _sorted_cell(cell: pa.Table) -> pa.Table:
    return cell.sort_by("vec_id")


def count_cell(k: int, bins: int):
    def count(cell: pa.Table) -> pa.Table:
        out = []
        for q, _, s in _scores(_sorted_cell(cell)):
            lo, hi, width = (q[c].to_numpy() for c in ("lo", "hi", "width"))
            need, ids = np.minimum(q["need"].to_numpy(), k), q["query_id"].to_numpy()
            for i in range(len(lo)):
                at = (s[i][(s[i] >= lo[i]) & (s[i] < hi[i])] - lo[i]) // width[i]
                n = np.bincount(at, minlength=bins)[::-1]
                upto = int(np.searchsorted(np.cumsum(n), need[i])) + 1
                top = np.nonzero(n[:upto])[0]
                out.append((np.full(len(top), ids[i]), bins - 1 - top, n[top]))
        cols = [np.concatenate(x) if x else np.empty(0) for x in zip(*out)] if out else [np.empty(0)] * 3
        return pa.table({"query_id": cols[0].astype(np.int64), "bin": cols[1].astype(np.int32),
                         "n": cols[2].astype(np.int64)})
    return count


def find_cell(k: int):
    def find(cell: pa.Table) -> pa.Table:
        out = []
        for q, ids, s in _scores(_sorted_cell(cell)):
            kth, q_ids = q["lo"].to_numpy(), q["query_id"].to_numpy()
            for i in range(len(kth)):
                above = np.nonzero(s[i] > kth[i])[0]
                ties = np.nonzero(s[i] == kth[i])[0][:k]           # ids are in order
                at = np.concatenate([above, ties])
                at = at[s[i][at] != np.iinfo(np.int64).min]
                out.append((np.full(len(at), q_ids[i]), ids[at], s[i][at]))
        cols = [np.concatenate(x) if x else np.empty(0) for x in zip(*out)] if out else [np.empty(0)] * 3
        return pa.table({"query_id": cols[0].astype(np.int64), "vec_id": cols[1].astype(np.int64),
                         "score": cols[2].astype(np.int64)})
    return find


def _cells(candidates: DataFrame, queries: DataFrame, c_blocks: int, q_blocks: int) -> DataFrame:
    """Candidates once per query block, queries once per candidate block."""
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    nothing = F.lit(None).cast("long")
    c = candidates.select("vec_id", "vec", nothing.alias("query_id"), nothing.alias("lo"),
                          nothing.alias("hi"), nothing.alias("width"), nothing.alias("need"),
                          F.pmod(F.xxhash64("vec_id"), F.lit(c_blocks)).cast("int").alias("c"), every(q_blocks).alias("q"))
    q = queries.select(F.col("query_id").alias("vec_id"), "vec", "query_id", "lo", "hi", "width", "need",
                       every(c_blocks).alias("c"),
                       F.pmod(F.xxhash64("query_id"), F.lit(q_blocks)).cast("int").alias("q"))
    return c.unionByName(q).groupBy("c", "q")


def _refined(queries: DataFrame, histogram: DataFrame, bins: int) -> DataFrame:
    """The bin that holds the kth score becomes the range, ``need`` what is still to be found in it."""
    total = histogram.groupBy("query_id", "bin").agg(F.sum("n").alias("n"))
    down = Window.partitionBy("query_id").orderBy(F.desc("bin"))          # at most ``bins`` rows
    reached = F.sum("n").over(down)
    at = (total.withColumn("reached", reached)
          .join(queries.select("query_id", "need"), "query_id")
          .filter((F.col("reached") >= F.col("need")) & (F.col("reached") - F.col("n") < F.col("need")))
          .select("query_id", "bin", (F.col("reached") - F.col("n")).alias("above")))
    # fewer than ``need`` scores in all: every candidate is a result, the range goes to its floor
    b, above = F.coalesce("bin", F.lit(0)), F.coalesce("above", F.lit(0))
    new = queries.join(at, "query_id", "left")
    lo = F.col("lo") + b * F.col("width")
    hi = F.least("hi", F.when(F.col("bin").isNull(), F.col("hi")).otherwise(lo + F.col("width")))
    return new.select("query_id", "vec", lo.alias("lo"), hi.alias("hi"),
                      F.ceil(F.col("width") / F.lit(bins)).alias("width"),
                      (F.col("need") - above).alias("need"), (F.col("width") > 1).alias("open"))


def exact_top_k(vectors: DataFrame, is_query, k: int = 20, id_col: str = "vec_id",
                vec_col: str = "embedding", scale: int = 64, bins: int = BINS) -> DataFrame:
    """``query_id, rank, vec_id, score`` of each query's k best other rows."""
    base = written(integer_vectors(vectors, id_col, vec_col, scale), "vectors")
    norm = F.aggregate("vec", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double"))
    size = base.agg(F.count("*").alias("n"), F.count_if(is_query).alias("q"),
                    F.max(F.sqrt(norm)).alias("norm")).first()
    blocks = max(LEAST_BLOCKS, -(-size["n"] // CANDIDATES_PER_BLOCK))
    q_blocks = max(1, -(-size["q"] // QUERIES_PER_BLOCK))
    bound = (F.ceil(F.sqrt(norm) * F.lit((size["norm"] or 0.0) * (1 + 1e-9))) + 1).cast("long")
    queries = base.filter(is_query).select(
        F.col("vec_id").alias("query_id"), "vec", (-bound).alias("lo"), (bound + 1).alias("hi"),
        (F.floor((2 * bound + 1) / F.lit(bins)) + 1).alias("width"), F.lit(k).cast("long").alias("need"))
    left = True
    while left:
        histogram = _cells(base, queries, blocks, q_blocks).applyInArrow(count_cell(k, bins), HISTOGRAM)
        queries = written(_refined(queries, histogram, bins), "ranges")
        left = bool(queries.agg(F.max("open")).first()[0])
        queries = queries.drop("open")
    found = _cells(base, queries, blocks, q_blocks).applyInArrow(find_cell(k), FOUND)
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
