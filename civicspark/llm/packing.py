"""Best-fit packing of token sequences by large-item matching.

Documents become token ids plus one end id.  Documents longer than ``capacity``
are cut into pieces of that size, the first of which may be shorter; nothing
else is cut.  Pieces then go into sequences of at most ``capacity`` tokens:

1. pieces above a third of the capacity (large) share a sequence with at most
   one other large piece.  From the longest down, a piece above half of it is
   matched with the longest other large piece that fits; what remains is at most
   half each and is matched with its like, longest first;
2. the rest, from the longest down, go where they leave the least room;
   a new sequence is opened where none has room.

A packing depends on lengths alone, and there are at most ``capacity`` of them.
So the driver only sees a count per length and plans with runs: pieces of one
length with consecutive ranks go to consecutive sequences at one offset.  A
sequence's room at least halves each time a further length is put there, so the
plan is bounded by the capacity, not by the data.  A piece's rank among those of
its length is counted inside slices, whose number follows the row count, so a
length that many rows share is no hot group.

Token ids: those of the byte-level BPE of the vocabulary files, whose paths are
parameters.  The text of a special token in a document is ordinary text.

Defined cases: a null or empty text is the end id alone; rows that repeat a
document are packed each; a null id is kept; an empty table gives an empty
result; other columns are not read.
"""

from __future__ import annotations

import base64
import os
import re
import zlib
from collections import defaultdict
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from civicspark.llm.store import written

CAPACITY = 2048
END_ID = 0
ROWS_PER_SLICE = 200_000      # aimed size of one ranking window, over all lengths
ROWS_AT_ONCE = 5_000          # rows of an output batch
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long, place long"
PACKED = "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"
STRETCH = 200_000             # characters encoded at once, where a text can be cut
DEEP = 50_000                 # blanks in a row beyond which the faster encoder may run out of stack
RANK_BITS = 40                # ranks of one length are below 2**40
_BETWEEN = re.compile("[A-Za-z](?= [A-Za-z])")
_BLANKS = re.compile(r"\s+")
_ENCODERS: dict[str, object] = {}


def vocabulary() -> tuple[str, str]:
    """Paths of the public byte-level vocabulary: as ranks, and as JSON with the same ids."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.path("byte_bpe_50k.json")


def encoder(path: str):
    """The encoder of a vocabulary file, built once per process."""
    if path not in _ENCODERS:
        import public_tokenizers
        import tiktoken

        with open(path, "rb") as f:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}
        _ENCODERS[path] = tiktoken.Encoding(os.path.basename(path), pat_str=public_tokenizers.PATTERN,
                                            mergeable_ranks=ranks, special_tokens={})
    return _ENCODERS[path]


def patient_encoder(path: str):
    """The same ids by the library whose matching has no depth limit, but takes more time and memory."""
    if path not in _ENCODERS:
        from tokenizers import Tokenizer

        _ENCODERS[path] = Tokenizer.from_file(path)
        _ENCODERS[path].encode_special_tokens = True
    return _ENCODERS[path]


def stretches(text: str, size: int = STRETCH) -> Iterator[str]:
    """A long text in parts, cut only between a letter and a space with a letter behind it, where
    no token can lie across; so the parts' ids joined are the text's."""
    at = 0
    while len(text) - at > size:
        cut_at = _BETWEEN.search(text, at + size)
        if not cut_at:
            break
        yield text[at:cut_at.end()]
        at = cut_at.end()
    yield text[at:] if at else text


def token_ids(text: str, ranks_path: str, json_path: str) -> np.ndarray:
    """Ids of a whole text, without special tokens."""
    parts = []
    for part in stretches(text):
        if len(part) > DEEP and max(map(len, _BLANKS.findall(part)), default=0) > DEEP:
            parts.append(patient_encoder(json_path).encode(part, add_special_tokens=False).ids)
        else:
            parts.append(encoder(ranks_path).encode_ordinary(part))
    return np.concatenate([np.array(p, "<u4") for p in parts])


def cut(n: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of ``n`` ids; only the first may be shorter than the capacity."""
    first = n % capacity or capacity
    ends = [first, *range(first + capacity, n + 1, capacity)] if n > capacity else [n]
    return list(zip([0, *ends[:-1]], (b - a for a, b in zip([0, *ends[:-1]], ends))))


def _pieces(paths: tuple[str, str], capacity: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place = 0
        for batch in batches:
            rows: list[tuple] = []
            for doc_id, text in zip(batch["doc_id"].to_pylist(), batch["text"]):
                ids = np.append(token_ids(text.as_py() or "", *paths), np.array([END_ID], "<u4"))
                for piece, (start, length) in enumerate(cut(len(ids), capacity)):
                    rows.append((doc_id, piece, start, length, zlib.crc32(ids[start:start + length]), place))
                    place += 1
                if len(rows) >= ROWS_AT_ONCE:
                    yield _batch(rows)
                    rows = []
            if rows:
                yield _batch(rows)
    return run


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64())
    names = ("doc_id", "piece", "start", "length", "ids_crc32", "place")
    return pa.record_batch([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=list(names))


class Run(NamedTuple):
    """Ranks ``lo`` to ``hi`` - 1 of ``length``: ``per`` to a sequence from ``sequence`` on, the
    first of each at ``offset``."""
    length: int
    lo: int
    hi: int
    sequence: int
    per: int
    offset: int


def plan(counts: dict[int, int], capacity: int = CAPACITY) -> tuple[list[Run], int]:
    """Runs that cover every rank of every length, and the number of sequences."""
    left, used, runs, opened = dict(counts), defaultdict(int), [], 0
    rooms: dict[int, list[tuple[int, int]]] = defaultdict(list)     # room -> (first sequence, sequences)

    def put(length: int, n: int, sequence: int, per: int, offset: int) -> None:
        runs.append(Run(length, used[length], used[length] + n, sequence, per, offset))
        used[length] += n
        left[length] -= n

    def open_pairs(a: int, b: int | None, n: int) -> None:
        nonlocal opened
        put(a, n, opened, 1, 0)
        if b is not None:
            put(b, n, opened, 1, a)
        rooms[capacity - a - (b or 0)].append((opened, n))
        opened += n

    # large pieces: at most two to a sequence
    large = sorted((s for s in left if 3 * s > capacity), reverse=True)
    for a in large:
        if 2 * a <= capacity:
            break
        for b in large:
            if a + b <= capacity and left[a] and left[b]:
                open_pairs(a, b, min(left[a], left[b]))
        if left[a]:
            open_pairs(a, None, left[a])
    half = [s for s in large if 2 * s <= capacity]
    for i, a in enumerate(half):
        if left[a] >= 2:
            n = left[a] // 2
            put(a, 2 * n, opened, 2, 0)
            rooms[capacity - 2 * a].append((opened, n))
            opened += n
        if left[a]:
            b = next((b for b in half[i + 1:] if left[b]), None)
            open_pairs(a, b, 1)

    # the rest: the least room that holds them
    for s in sorted((s for s in left if 0 < 3 * s <= capacity), reverse=True):
        for room in sorted(r for r in rooms if r >= s):
            spans = rooms[room]
            while spans and left[s]:
                first, n = spans.pop()
                fit = room // s
                whole = min(n, left[s] // fit)              # sequences that take as many as fit
                if whole:
                    put(s, whole * fit, first, fit, capacity - room)
                    rooms[room - fit * s].append((first, whole))
                if whole < n and left[s]:                   # one takes the last few
                    some = left[s]
                    put(s, some, first + whole, some, capacity - room)
                    rooms[room - some * s].append((first + whole, 1))
                    whole += 1
                if whole < n:
                    spans.append((first + whole, n - whole))
            if not spans:
                del rooms[room]
            if not left[s]:
                break
        if left[s]:
            fit = capacity // s
            n = -(-left[s] // fit)
            whole, some = divmod(left[s], fit)
            put(s, left[s], opened, fit, 0)
            if whole:
                rooms[capacity - fit * s].append((opened, whole))
            if some:
                rooms[capacity - some * s].append((opened + whole, 1))
            opened += n
    return runs, opened


def _placed(runs: list[Run]):
    """Ranked pieces to their sequence and offset."""
    table = np.array(sorted(runs), np.int64).reshape(-1, len(Run._fields))
    at = (table[:, 0] << RANK_BITS) + table[:, 1]       # one number that keeps the order of (length, rank)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, rank = (batch[c].to_numpy() for c in ("length", "rank"))
            hit = table[np.searchsorted(at, (length << RANK_BITS) + rank, side="right") - 1]
            k = rank - hit[:, 1]
            yield pa.record_batch([*(batch[c] for c in ("doc_id", "piece", "start", "length", "ids_crc32")),
                                   pa.array(hit[:, 3] + k // hit[:, 4]), pa.array(hit[:, 5] + k % hit[:, 4] * length)],
                                  names=["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"])
    return run


def ranked(pieces: DataFrame, total: int) -> DataFrame:
    """Adds ``rank``, gapless from 0 among the pieces of each length."""
    slices = max(1, -(-total // ROWS_PER_SLICE))
    sliced = pieces.withColumn("slice", F.pmod(F.xxhash64("doc_id", "piece", "place"), F.lit(slices)).cast("int"))
    before = Window.partitionBy("length").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sliced.groupBy("length", "slice").count().select(
        "length", "slice", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("before"))
    inside = Window.partitionBy("length", "slice").orderBy("doc_id", "piece", "ids_crc32", "place")
    return (sliced.withColumn("inside", F.row_number().over(inside) - 1).join(offsets, ["length", "slice"])
            .withColumn("rank", F.col("before") + F.col("inside")))


def pack(docs: DataFrame, capacity: int = CAPACITY, paths: tuple[str, str] | None = None) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32, sequence_id, offset`` of every piece."""
    pieces = written(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
                     .mapInArrow(_pieces(paths or vocabulary(), capacity), PIECES), "pieces")
    # at most ``capacity`` rows
    counts = {r["length"]: r["count"] for r in pieces.groupBy("length").count().collect()}
    runs, _ = plan(counts, capacity)
    if not runs:
        return docs.sparkSession.createDataFrame([], PACKED)
    return ranked(pieces, sum(counts.values())).mapInArrow(_placed(runs), PACKED)
