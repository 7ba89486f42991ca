"""Set-similarity self-join on word shingles with rare-first prefix filtering, and its components.

A document's set holds its distinct shingles of ``SHINGLE`` words.  Two sets
link when their Jaccard similarity reaches PART / WHOLE.  The links' connected
components are found without listing all links:

1. Equal sets are one node (a 64-bit hash of the set); copies need no pairs.
2. All sets are sorted by one global order, rare shingles first.  Every task
   counts its shingles, those that repeat are added up over all documents, and
   the HEAVY most frequent come last, by count; the others go by hash.  (Any one
   order gives the same links; this one keeps frequent shingles out of prefixes.)
   Two similar sets share a shingle in their prefixes (about a quarter of each).
3. Prefix shingles meet by shingle.  They travel packed, by buckets of shingles;
   most occur in one set only and go no further, nor do members of a small group
   whose sizes and places rule out every other member.  Every member of a
   group is paired with the group's first set only: enough to connect a large
   group of near copies without its square of pairs.  Groups of very frequent
   shingles are dealt over several salted groups whose first sets meet again.
4. Components of the links found so far leave few groups with members of more
   than one component.  In the large ones of these, members are paired with
   CENTRES more sets if those are of another component, and components are
   found again: near copies around a threshold mostly link to one of them.
5. In what is left, all pairs across components are made, so each link that
   could still join two components is tested.  That is exact.

Pairs go through a length filter, a positional filter (the first common prefix
shingle bounds the overlap), a suffix filter (the hash space has cells, more for a
larger set; a cell that one set alone has holds a shingle that the other lacks),
and are verified once on the whole sets.  Only
the texts of documents in such pairs are shuffled: a bitmap of fixed size tells
the last pass over the texts which these may be.

Shingles are 48-bit hashes, compared set by set.  Defined cases: null, empty and blank texts have an
empty set and link with nothing; texts of fewer words have one shingle of all of
them; repeated rows are copies; a row without doc_id takes part, connects others
and has the smallest id its component knows, null if none.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from civicspark.llm.components import components
from civicspark.llm.store import written
from civicspark.llm.text_bytes import Hasher, Piece, mixed, pieces, row_of, runs

SHINGLE = 5
PART, WHOLE = 75, 100
VALUE_BITS = 48              # of a shingle's hash
VALUE_MASK = np.uint64((1 << VALUE_BITS) - 1)
HEAVY = 200_000              # most frequent shingles whose counts order the prefixes (a bound, 3 MB)
HEAVY_LEAST = 3              # times within CHUNK shingles of a task that make a shingle worth counting
TEXT_BYTES = 250_000         # texts whose sets a task makes together
CHUNK = 4_000_000            # shingles that a task counts at a time (32 MB)
COUNT_BITS = 5               # a chunk is sorted in so many bits' parts, each by itself
BITMAP_BITS = 20             # of nodes whose texts are fetched
LARGE, KNOWN = 64, 64        # groups of so many members tell pairs met before, by so many shingles
CENTRES = 16                 # sets of a large group that its other components' members are paired with first
CELLS = 2                    # of the suffix filter to a shingle, at least
PART_MOST = 1                # shingles that a cell of it tells: it is a bit
CHUNK_ENTRIES = 500_000      # prefix shingles that a task packs together (about 75 MB while it does)
ENTRIES_PER_BUCKET = 500_000
LEAST_BUCKET_BITS = 4
ROWS_PER_GROUP = 20_000      # expected members beyond which a shingle's group is salted
SETS = "doc_id long, n int, node long, cells array<long>, tokens array<long>, counts array<long>"
PREFIX = "bucket int, n long, size long, packed binary"
GROUPS = "token long, salt int, node long, n int, pos int, first long, first_n int, first_pos int"


class Shingles(NamedTuple):
    row: np.ndarray          # of the piece, ascending
    value: np.ndarray        # hashes of VALUE_BITS bits, ascending and distinct within a row
    size: np.ndarray         # of each row's set


def shingle_sets(piece: Piece, size: int = SHINGLE) -> Shingles:
    b = piece.data
    starts, ends = runs(~((b == 32) | ((b >= 9) & (b <= 13))))
    rows = row_of(piece, starts)
    words = Hasher(b).of(starts, ends)
    n_words = np.bincount(rows, minlength=len(piece.starts))
    first = np.cumsum(n_words) - n_words
    factor = [np.uint64(pow(0x9E3779B97F4A7C15, k + 1, 1 << 64)) for k in range(size)]
    whole = np.zeros(max(0, len(words) - size + 1), np.uint64)
    for k in range(size):
        whole += words[k:len(words) - size + 1 + k] * factor[k] if len(whole) else np.uint64(0)
    inside = rows[:len(whole)] == rows[size - 1:] if len(whole) else np.zeros(0, bool)
    value, row = mixed(whole[inside]), rows[:len(whole)][inside]
    short = np.nonzero((n_words > 0) & (n_words < size))[0]
    tail = np.zeros(len(short), np.uint64)
    for k in range(size - 1):
        has = n_words[short] > k
        tail[has] += words[first[short][has] + k] * factor[k]
    value = np.concatenate([value, mixed(tail + n_words[short].astype(np.uint64))])
    row = np.concatenate([row, short])
    key = np.sort(_keyed(row, value >> np.uint64(64 - VALUE_BITS)))
    key = key[np.concatenate([[True], key[1:] != key[:-1]])] if len(key) else key
    row = (key >> np.uint64(VALUE_BITS)).astype(np.int64)
    return Shingles(row, key & VALUE_MASK, np.bincount(row, minlength=len(piece.starts)))


def _keyed(row: np.ndarray, value: np.ndarray) -> np.ndarray:
    """Row (16 bits) above value, so that one sort orders both."""
    return row.astype(np.uint64) << np.uint64(VALUE_BITS) | value


def node_keys(s: Shingles) -> np.ndarray:
    """64-bit hash of each row's set, whatever its order."""
    sums = np.zeros(len(s.size), np.uint64)
    np.add.at(sums, s.row, mixed(s.value ^ np.uint64(0x51ED270B9E3779B1)))
    return mixed(sums + s.size.astype(np.uint64)).view(np.int64)


def cells(s: Shingles) -> pa.ListArray:
    """Each row's cells with a shingle, as bits of 64-bit numbers.  Their number is a power of two that follows the set's
    size, so that longer sets are told apart as well as short ones; the low bits of a hash name its cell."""
    width = CELLS << np.ceil(np.log2(np.maximum(s.size, 64 // CELLS))).astype(np.int64)
    upto = np.cumsum(width)
    at = (upto - width)[s.row] + (s.value.astype(np.int64) & (width - 1)[s.row])
    told = np.minimum(np.bincount(at, minlength=upto[-1]), PART_MOST)
    words = np.packbits(told.astype(bool), bitorder="little").view(np.int64)
    return pa.ListArray.from_arrays(pa.array(np.append(0, upto // 64), pa.int32()), pa.array(words))


def prefix_length(n: np.ndarray) -> np.ndarray:
    return n - -(-n * PART // WHOLE) + 1


def _repeated(values: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Shingles that repeat in ``values``, ascending, with their counts.  They are counted by ranges of
    hashes, so that beside ``values`` only a small part of them is copied and sorted at a time."""
    found = [(np.zeros(0, np.uint64), np.zeros(0, np.int64))]
    for part in range(1 << COUNT_BITS):
        mine = [v[v >> np.uint64(VALUE_BITS - COUNT_BITS) == part] for v in values]
        token, n = np.unique(np.concatenate(mine), return_counts=True) if mine else found[0]
        found.append((token[n >= HEAVY_LEAST], n[n >= HEAVY_LEAST].astype(np.int64)))
    token, n = (np.concatenate(c) for c in zip(*found))
    return token.view(np.int64), n


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row per document, and one for each CHUNK of shingles with those that repeat in it."""
    held: list[np.ndarray] = []

    def counted() -> pa.RecordBatch:
        token, n = _repeated(held)
        held.clear()
        none = pa.nulls(1, pa.int64())
        return pa.record_batch({
            "doc_id": none, "n": pa.array([-1], pa.int32()), "node": none, "cells": pa.nulls(1, pa.list_(pa.int64())),
            "tokens": pa.array([token], pa.list_(pa.int64())), "counts": pa.array([n], pa.list_(pa.int64()))})

    for batch in batches:
        for p in pieces(batch["text"], TEXT_BYTES, lower=True):
            s = shingle_sets(p)
            rows = len(s.size)
            nothing = pa.nulls(rows, pa.list_(pa.int64()))
            yield pa.record_batch({
                "doc_id": batch["doc_id"].slice(p.first, rows), "n": pa.array(s.size, pa.int32()), "node": node_keys(s), "cells": cells(s),
                "tokens": nothing, "counts": nothing})
            held.append(s.value)
            if sum(map(len, held)) >= CHUNK:
                yield counted()
    yield counted()


class Order(NamedTuple):
    """The global order: ``heavy`` shingles (ascending hashes) with their ``place`` and group ``salts``."""
    heavy: np.ndarray
    place: np.ndarray
    salts: np.ndarray        # by place

    def keys(self, value: np.ndarray) -> np.ndarray:
        """Keys of VALUE_BITS bits that sort as the order does; equal keys, equal shingles (but for one bit)."""
        key = value >> np.uint64(1)
        if len(self.heavy):
            at = np.minimum(np.searchsorted(self.heavy, value), len(self.heavy) - 1)
            hit = self.heavy[at] == value
            key[hit] = np.uint64(1 << (VALUE_BITS - 1)) | self.place[at[hit]]
        return key


def global_order(token: np.ndarray, count: np.ndarray) -> Order:
    by_count = np.lexsort((token, count))
    place = np.empty(len(token), np.uint64)
    place[by_count] = np.arange(len(token), dtype=np.uint64)
    by_token = np.argsort(token)
    return Order(token[by_token].astype(np.uint64), place[by_token], 1 + count[by_count] // ROWS_PER_GROUP)


def _planes(x: np.ndarray) -> bytes:
    """First bytes of all numbers, then second bytes: what numbers have in common lies together."""
    return np.ascontiguousarray(x.view(np.uint8).reshape(len(x), x.itemsize).T).tobytes()


def _from_planes(data: np.ndarray, n: int, kind) -> np.ndarray:
    size = np.dtype(kind).itemsize
    return np.ascontiguousarray(data.reshape(size, n).T).view(kind).reshape(n)


def _steps(x: np.ndarray) -> np.ndarray:
    return np.diff(x, prepend=x.dtype.type(0))


class Entries(NamedTuple):
    """Prefix shingles: key, salt (-1: none), set, its size, and the place in its prefix from 1.
    What a task holds of them has 28 bytes to a shingle: 64 bits of key and set, 32 of the others."""
    token: np.ndarray
    salt: np.ndarray
    node: np.ndarray
    n: np.ndarray
    pos: np.ndarray


def pack(e: Entries) -> tuple[int, int, bytes]:
    """Entries in order of ``token`` as one compressed value, with their number and its plain size.  A
    set's hash and size are there once, whatever the number of its entries."""
    node, first, at = np.unique(e.node, return_index=True, return_inverse=True)
    plain = b"".join([np.int64(len(node)).tobytes(), _planes(_steps(e.token)), _planes((e.salt + 1).astype(np.uint32)),
                      _planes(at.astype(np.uint32)), _planes(e.pos.astype(np.uint32)),
                      _planes(_steps(node.view(np.uint64))), _planes(e.n[first].astype(np.uint32))])
    return len(e.token), len(plain), pa.Codec("zstd", compression_level=1).compress(plain, asbytes=True)


def unpack(n: int, size: int, packed: bytes) -> Entries:
    data = np.frombuffer(pa.Codec("zstd").decompress(packed, size), np.uint8)
    nodes = int(data[:8].view(np.int64)[0])
    out, at = [], 8
    for kind, count in ((np.uint64, n), (np.uint32, n), (np.uint32, n), (np.uint32, n), (np.uint64, nodes), (np.uint32, nodes)):
        end = at + count * np.dtype(kind).itemsize
        out.append(_from_planes(data[at:end], count, kind))
        at = end
    token, salt, which, pos, node, of = out
    node = np.cumsum(node, dtype=np.uint64).view(np.int64)
    return Entries(np.cumsum(token, dtype=np.uint64), (salt - np.uint32(1)).view(np.int32), node[which],
                   of[which].view(np.int32), pos.view(np.int32))


def buckets(token: np.ndarray, salt: np.ndarray, bits: int) -> np.ndarray:
    """The bucket of each group (shingle and salt): by the shingle's hash, frequent ones by a hash of both."""
    plain = token >> np.uint64(VALUE_BITS - 1 - bits)
    salted = mixed(token * np.uint64(0x9E3779B1) + salt.astype(np.uint64)) >> np.uint64(64 - bits) if bits else plain * np.uint64(0)
    return np.where(token >> np.uint64(VALUE_BITS - 1) > 0, salted, plain).astype(np.int64)


def _prefixes(order: tuple, bits: int):
    """A row per bucket for each CHUNK_ENTRIES prefix shingles of a task."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        by = Order(*order)
        sent: set[int] = set()                           # a task sends each set once
        held: list[Entries] = []

        def packed() -> pa.RecordBatch:
            e = Entries(*(np.concatenate(c) for c in zip(*held)))
            held.clear()
            bucket = buckets(e.token, e.salt, bits)
            by_bucket = np.lexsort((e.token, bucket))
            bucket = bucket[by_bucket]
            cut = np.append(np.flatnonzero(np.diff(bucket, prepend=-1)), len(bucket))
            rows = [(int(bucket[i]), *pack(Entries(*(c[by_bucket[i:j]] for c in e)))) for i, j in zip(cut, cut[1:])]
            b, n, size, data = zip(*rows)
            return pa.record_batch({"bucket": pa.array(b, pa.int32()), "n": pa.array(n, pa.int64()),
                                    "size": pa.array(size, pa.int64()), "packed": pa.array(data, pa.binary())})

        for batch in batches:
            for p in pieces(batch["text"], TEXT_BYTES, lower=True):
                s = shingle_sets(p)
                node = node_keys(s)
                new = np.zeros(len(s.size), bool)
                for i in np.nonzero(s.size)[0]:
                    new[i] = node[i] not in sent
                    sent.add(int(node[i]))
                token = np.sort(_keyed(s.row, by.keys(s.value))) & VALUE_MASK
                pos = np.arange(len(token)) - (np.cumsum(s.size) - s.size)[s.row]
                keep = (pos < prefix_length(s.size)[s.row]) & new[s.row]
                row, token, pos = s.row[keep], token[keep], pos[keep]
                if not len(row):
                    continue
                heavy = token >> np.uint64(VALUE_BITS - 1) > 0
                salt = np.ones(len(token), np.int64)
                salt[heavy] = by.salts[(token[heavy] & np.uint64((1 << (VALUE_BITS - 1)) - 1)).astype(np.int64)]
                held.append(Entries(token, np.where(salt > 1, node[row] % salt, -1).astype(np.int32), node[row],
                                    s.size[row].astype(np.int32), (pos + 1).astype(np.int32)))
                if sum(len(h.token) for h in held) >= CHUNK_ENTRIES:
                    yield packed()
        if held:
            yield packed()
    return run


def _met(e: Entries, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Members of groups (in order, ``start`` and ``size`` by member) that may be similar to another member:
    the overlap is at most what lies before the shingle in both orders, the shingle, and what lies behind it."""
    out, near = np.zeros(len(e.n), bool), np.arange(len(e.n))
    n, pos = e.n.astype(np.int64), e.pos.astype(np.int64)
    for step in range(1, int(size.max(initial=0))):
        near = near[near + step < (start + size)[near]]
        i, j = near, near + step
        most = np.minimum(pos[i], pos[j]) + np.minimum(n[i] - pos[i], n[j] - pos[j])
        hit = most * (WHOLE + PART) >= (n[i] + n[j]) * PART      # so sizes that differ too much fail, too
        out[i[hit]] = out[j[hit]] = True
    return out


def _groups(bucket: pa.Table) -> pa.Table:
    """Members of groups of two and more sets beside the group's first set, and all members of salted
    groups.  A shingle of one set ends here, and in groups of less than LARGE members a set that none of
    the others can be similar to."""
    e = Entries(*(np.concatenate(c) for c in zip(*(unpack(n.as_py(), size.as_py(), data.as_buffer())
                                                   for n, size, data in zip(*(bucket[c] for c in ("n", "size", "packed")))))))
    order = np.lexsort((e.node, e.salt, e.token))
    e = Entries(*(c[order] for c in e))
    starts = _group_starts(e)
    fresh = starts | np.concatenate([[True], e.node[1:] != e.node[:-1]])      # not sent by another task too
    e = Entries(*(c[fresh] for c in e))
    start, size = _spans(_group_starts(e))
    small = np.flatnonzero((e.salt < 0) & (size < LARGE))
    keep = (e.salt >= 0) | (size >= LARGE)
    at = np.arange(len(small)) - (small - start[small])                       # groups are small or not as a whole
    keep[small] = _met(Entries(*(c[small] for c in e)), at, size[small])
    e = Entries(*(c[keep] for c in e))
    first = _spans(_group_starts(e))[0]
    return pa.table({"token": e.token.view(np.int64), "salt": e.salt, "node": e.node, "n": e.n, "pos": e.pos,
                     "first": e.node[first], "first_n": e.n[first], "first_pos": e.pos[first]})


def _group_starts(e: Entries) -> np.ndarray:
    new = (e.token[1:] != e.token[:-1]) | (e.salt[1:] != e.salt[:-1])
    return np.concatenate([[True], new])[:len(e.token)]


def _spans(starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of each member, where its group starts and how many it has."""
    first = np.flatnonzero(starts)
    group = np.cumsum(starts) - 1
    return first[group], np.diff(np.append(first, len(starts)))[group]


def _wanted_texts(bitmap: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sent: set[int] = set()
        for batch in batches:
            for p in pieces(batch["text"], TEXT_BYTES, lower=True):
                s = shingle_sets(p)
                node = node_keys(s)
                wanted = [i for i in np.nonzero((s.size > 0) & bitmap[node & ((1 << BITMAP_BITS) - 1)])[0]
                          if node[i] not in sent]
                sent.update(node[wanted].tolist())
                if wanted:
                    yield pa.record_batch({"node": node[wanted], "text": batch["text"].take(pa.array(p.first + np.array(wanted)))})
    return run


def _similar(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs whose texts' sets are similar enough."""
    for batch in batches:
        for p in pieces(batch["text_a"], TEXT_BYTES, lower=True):
            rows = len(p.starts)
            other = next(pieces(batch["text_b"].slice(p.first, rows), max_bytes=1 << 40, lower=True))
            x, y = shingle_sets(p), shingle_sets(other)
            both = np.intersect1d(_keyed(x.row, x.value), _keyed(y.row, y.value), assume_unique=True)
            overlap = np.bincount((both >> np.uint64(VALUE_BITS)).astype(np.int64), minlength=rows)
            hit = np.nonzero(overlap * (WHOLE + PART) >= (x.size + y.size) * PART)[0]
            if len(hit):
                at = pa.array(p.first + hit)
                yield pa.record_batch({"u": batch["a"].take(at), "v": batch["b"].take(at)})


def _enough(overlap: Column, n1: Column, n2: Column) -> Column:
    """Jaccard similarity of at least PART / WHOLE, in integers."""
    return overlap * (WHOLE + PART) >= (n1 + n2) * PART


def _candidates(pairs: DataFrame) -> DataFrame:
    """Distinct pairs (``a``, ``b`` with sizes ``na``, ``nb`` and places ``pa``, ``pb`` in their orders)
    after the length and the positional filter."""
    first = (pairs.filter((F.col("na") * WHOLE >= F.col("nb") * PART) & (F.col("nb") * WHOLE >= F.col("na") * PART))
             .groupBy("a", "b").agg(F.first("na").alias("na"), F.first("nb").alias("nb"),
                                    F.min("pa").alias("pa"), F.min("pb").alias("pb")))
    most = F.least(F.col("na") - F.col("pa"), F.col("nb") - F.col("pb")) + 1
    return first.filter(_enough(most, F.col("na"), F.col("nb"))).select("a", "b", "na", "nb")


def _verified(docs: DataFrame, pairs: DataFrame, nodes: DataFrame) -> DataFrame:
    """Pairs that pass the suffix filter and the test on the whole sets."""
    sig = nodes.select("node", "cells")
    left = written(
        pairs.join(sig.select(F.col("node").alias("a"), F.col("cells").alias("cells_a")), "a")
        .join(sig.select(F.col("node").alias("b"), F.col("cells").alias("cells_b")), "b")
        .filter(_may_overlap("cells_a", "cells_b", F.col("na"), F.col("nb"))).select("a", "b", "na", "nb"), "pairs")
    either = left.select(F.explode(F.array("a", "b")).alias("node"))
    mask = (1 << BITMAP_BITS) - 1
    slots = either.select(F.col("node").bitwiseAND(mask).cast("int").alias("slot")).distinct().toArrow()["slot"]
    bitmap = np.zeros(1 << BITMAP_BITS, bool)
    bitmap[slots.to_numpy()] = True
    # the bitmap lets other nodes through by chance: only the pairs' own nodes are kept.  A text is
    # shorter than its set of hashes, so texts travel and their sets are made where pairs are tested
    texts = written(docs.select("text").mapInArrow(_wanted_texts(bitmap), "node long, text string")
                    .join(either.distinct(), "node", "left_semi")
                    .groupBy("node").agg(F.first("text").alias("text")), "texts")
    met = (left.join(texts.select(F.col("node").alias("a"), F.col("text").alias("text_a")), "a")
           .join(texts.select(F.col("node").alias("b"), F.col("text").alias("text_b")), "b"))
    return written(met.select("a", "b", "text_a", "text_b").mapInArrow(_similar, "u long, v long"), "links")


def _may_overlap(x: str, y: str, n1: Column, n2: Column) -> Column:
    """The suffix filter on the cells of two sets whose sizes pass the length filter, so that one has
    at most twice the cells of the other."""
    def folded(cells: str, other: str) -> Column:
        half = F.size(other)
        return F.when(F.size(cells) > half, F.zip_with(
            F.slice(cells, 1, half), F.slice(cells, half + 1, half), lambda a, b: a.bitwiseOR(b))).otherwise(F.col(cells))

    def alone(cells: Column, other: Column) -> Column:
        bits = F.zip_with(cells, other, lambda a, b: F.bit_count(a.bitwiseAND(F.bitwise_not(b))))
        return F.aggregate(bits, F.lit(0), lambda s, c: s + c)
    x, y = folded(x, y), folded(y, x)
    return _enough(F.least(n1 - alone(x, y), n2 - alone(y, x)), n1, n2)


def _rooted(members: DataFrame, known: DataFrame) -> DataFrame:
    return written(members.join(known, "node", "left").withColumn("root", F.coalesce("root", "node")), "members")


def _active(members: DataFrame) -> DataFrame:
    """Members, with their group's ``size``, of groups that hold more than one component."""
    groups = members.groupBy("token").agg(F.min("root").alias("lo"), F.max("root").alias("hi"),
                                          F.count("*").alias("size")).filter("lo != hi")
    return members.join(groups.select("token", "size"), "token")


def _across(active: DataFrame, nodes: DataFrame, centres: int | None = None) -> DataFrame:
    """Pairs (``a`` < ``b``) of one group and two components, after all filters.  In large groups a pair
    is made at its first common prefix shingle only, as far as the first KNOWN shingles of both tell, and
    only if it passes the suffix filter there and then.  ``centres``: only pairs with so many sets of each group."""
    large = active.filter(F.col("size") >= LARGE)
    nth = F.row_number().over(Window.partitionBy("node").orderBy("token"))
    known = (large.withColumn("nth", nth).filter(F.col("nth") <= KNOWN)
             .groupBy("node").agg(F.collect_list("token").alias("known")))
    large = large.join(known, "node").join(nodes.select("node", "cells"), "node")
    rows = written(large.unionByName(active.filter(F.col("size") < LARGE), allowMissingColumns=True).select(
        "token", "node", "n", "pos", "root", "known", "cells"), "across")
    others = rows
    if centres:
        turn = F.row_number().over(Window.partitionBy("token").orderBy(F.xxhash64("node"), "node"))
        chosen = rows.select("token", "node").withColumn("turn", turn).filter(F.col("turn") <= centres)
        others = rows.join(chosen.select("token", "node"), ["token", "node"], "left_semi")
    x, y = (part.select("token", F.col("node").alias(s), F.col("n").alias(f"n{s}"), F.col("pos").alias(f"p{s}"),
                        F.col("root").alias(f"r{s}"), F.col("known").alias(f"k{s}"),
                        F.col("cells").alias(f"s{s}")) for s, part in (("a", rows), ("b", others)))
    near = (F.col("na") * WHOLE >= F.col("nb") * PART) & (F.col("nb") * WHOLE >= F.col("na") * PART)
    most = F.least(F.col("na") - F.col("pa"), F.col("nb") - F.col("pb")) + 1
    small_most = F.least("pa", "pb") + most - 1          # where the shingle need not be the first
    bound = F.when(F.col("ka").isNull(), small_most).otherwise(most)
    earlier = F.coalesce(F.array_min(F.array_intersect("ka", "kb")) < F.col("token"), F.lit(False))
    once = F.lit(True) if centres else F.col("a") < F.col("b")
    pairs = x.join(y, "token").filter(once & near & (F.col("ra") != F.col("rb"))
                                      & _enough(bound, F.col("na"), F.col("nb")) & ~earlier
                                      & (F.col("sa").isNull() | _may_overlap("sa", "sb", F.col("na"), F.col("nb"))))
    turned = F.col("a") > F.col("b")
    return pairs.select(*[F.when(turned, F.col(c + q)).otherwise(F.col(c + p)).alias(c + p)
                          for c in ("", "n", "p") for p, q in ("ab", "ba")])


def link_components(docs: DataFrame) -> DataFrame:
    """``doc_id, n_shingles, component_id`` of every row of ``docs`` (``doc_id``, ``text``)."""
    docs = docs.select("doc_id", "text")
    both = written(docs.mapInArrow(_sets, SETS), "shingle-sets")
    sets = both.filter("n >= 0").select("doc_id", "n", "node", "cells")
    pairs = F.explode(F.arrays_zip("tokens", "counts")).alias("t")
    frequent = (both.filter("n < 0").select(pairs).groupBy(F.col("t.tokens").alias("token"))
                .agg(F.sum("t.counts").alias("c")).orderBy(F.desc("c"), "token").limit(HEAVY).toArrow())
    order = global_order(frequent["token"].to_numpy(), frequent["c"].to_numpy())
    nodes = written(sets.filter("n > 0").groupBy("node").agg(
        F.min("doc_id").alias("rep"), F.first("cells").alias("cells")), "nodes")

    # prefixes by buckets of shingles; about ENTRIES_PER_BUCKET to a bucket, whatever the size of the corpus
    total = sets.agg(F.sum(F.col("n") - F.ceil(F.col("n") * PART / WHOLE) + 1)).first()[0] or 0
    bits = max(LEAST_BUCKET_BITS, (int(total) // ENTRIES_PER_BUCKET).bit_length())
    grouped = written(docs.mapInArrow(_prefixes(tuple(order), bits), PREFIX).groupBy("bucket").applyInArrow(_groups, GROUPS), "groups")
    apart = grouped.filter("salt >= 0 and node = first").select("token", "node", "n", "pos")
    over = Window.partitionBy("token").orderBy("node")
    again = apart.select("token", "node", "n", "pos", *[F.first(c).over(over).alias(f"first{s}")
                                                       for c, s in (("node", ""), ("n", "_n"), ("pos", "_pos"))])
    star = (grouped.drop("salt").unionByName(again).filter("node != first")
            .select(F.col("first").alias("a"), F.col("node").alias("b"), F.col("first_n").alias("na"),
                    F.col("n").alias("nb"), F.col("first_pos").alias("pa"), F.col("pos").alias("pb")))
    tried = written(_candidates(star), "candidates")
    links = _verified(docs, tried, nodes)

    members = grouped.select("token", "node", "n", "pos")     # a set is in one group of a shingle, and there once
    active = written(_active(_rooted(members, components(links))), "active")
    central = _candidates(_across(active.filter(F.col("size") >= LARGE), nodes, CENTRES))
    central = written(central.join(tried.select("a", "b"), ["a", "b"], "left_anti"), "central")
    links = links.unionByName(_verified(docs, central, nodes))

    active = written(_active(_rooted(active.select("token", "node", "n", "pos"), components(links))), "active")
    met = tried.unionByName(central).select("a", "b")
    rest = _candidates(_across(active, nodes)).join(met, ["a", "b"], "left_anti")
    root = components(links.unionByName(_verified(docs, rest, nodes)))

    rooted = nodes.join(root, "node", "left").select("node", "rep", F.coalesce("root", "node").alias("root"))
    least = rooted.groupBy("root").agg(F.min("rep").alias("component_id"))
    final = rooted.join(least, "root").select("node", "component_id")
    rows = sets.select("doc_id", F.col("n").alias("n_shingles"), "node")
    linked = rows.filter("n_shingles > 0").join(final, "node").select("doc_id", "n_shingles", "component_id")
    return linked.unionByName(rows.filter("n_shingles = 0").select(
        "doc_id", "n_shingles", F.col("doc_id").alias("component_id")))
