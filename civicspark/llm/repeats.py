"""Removal of repeated passages by prefix-free parsing of the corpus into phrases.

Every byte covered by a string of LENGTH bytes that also starts anywhere else,
in this document or another, is removed.  Nothing is listed per byte:

1. Parsing.  A rolling hash of GRAM bytes triggers at a position that is the
   minimum of the first SPAN positions of some LENGTH-byte window.  Which one
   that is follows from the window's own bytes, so equal windows have their
   trigger at the same place.  Consecutive windows with one trigger form a
   phrase: the text from the first of these windows to the end of the last.
   Phrases overlap by whole windows, and none lies inside another.
   In a stretch of period up to PERIODS every trigger is a tie, so that phrases
   would be a period apart.  There a window equals the one a period before it:
   both are repeated without asking, and the later one is left out of the
   phrases, as the first of its like stands for it.  So a periodic stretch of any
   length has the phrases of one period.
2. Dictionary.  Phrases are grouped by the hash of the CORE bytes behind the
   trigger, which every window of the phrase contains.  A core that occurs once
   is not repeated, nor is any window with it.  Equal phrases that occur twice
   or more are repeated as a whole.
3. Where one core has different phrases (the rims of repeated passages), each
   distinct phrase tells its windows in blocks of BLOCK places around the
   trigger, again one dictionary entry for all its copies.  A block holds the
   hash of what its windows have in common and the bytes before and behind it.
   A common stretch that occurs once has no repeated window; blocks that agree
   in all bytes are repeated as a whole; only others are compared window by
   window, by the bytes at hand.

Groups are joined and counted, never collected; a core that a third of all
documents share is one row of the dictionary and a skewed join.  Texts travel
once, those with rims twice.  Hashes are 64 bits with the core's 64 bits beside
them.

Defined cases: null texts are empty; texts shorter than LENGTH bytes keep all;
rows that repeat a document are repeats of each other; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from civicspark.llm.store import written
from civicspark.llm.text_bytes import Hasher, Piece, pieces, row_of

LENGTH = 400
GRAM, SPAN, CORE = 16, 200, 200       # SPAN + CORE <= LENGTH, GRAM <= CORE
BLOCK = 20                            # windows; well below LENGTH
PERIODS = 64                          # longest period that is looked for beside a window
CELL = LENGTH // 2                    # bytes between the places where periods are looked for
CELLS_AT_ONCE = 20_000                # stretches of CELL bytes compared together
PHRASES = "doc_id long, th long, core long, phrase long, s int, e int, a int"
DIGEST = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
FIRST = (DIGEST + ", th long, text string, starts array<int>, ends array<int>, cores array<long>, "
         "numbers array<int>, commons array<long>, befores array<binary>, behinds array<binary>, at array<int>")


def periodic(piece: Piece) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First and last start of windows that equal the window a period later in their text, and the period.

    The bytes that equal those a period later form a stretch of LENGTH bytes at least, which holds a whole
    cell of the grid.  Cells inside a stretch that is found are not asked for longer periods."""
    data, grid = piece.data, np.arange(0, len(piece.data) - CELL, CELL)
    row = np.searchsorted(piece.starts, grid, side="right") - 1
    room = piece.ends[row] - grid - CELL                        # the longest period that keeps to the text
    found, inside = [], np.arange(CELL)
    ask = np.flatnonzero(room > 0)
    for p in range(1, PERIODS + 1):
        k = ask[room[ask] >= p]
        for probe in (0, CELL - 1, *range(1, 8)):
            k = k[data[grid[k] + probe] == data[grid[k] + probe + p]]
        k = np.concatenate([k[:0]] + [part[(data[at] == data[at + p]).all(axis=1)] for part in
                                      (k[i:i + CELLS_AT_ONCE] for i in range(0, len(k), CELLS_AT_ONCE))
                                      for at in (grid[part][:, None] + inside,)])
        if not len(k):
            continue
        breaks = np.flatnonzero((k[1:] != k[:-1] + 1) | (row[k[1:]] != row[k[:-1]])) + 1
        done = []
        for chain in np.split(k, breaks):
            r = row[chain[0]]
            lo, hi = int(grid[chain[0]]), int(grid[chain[-1]]) + CELL
            least, most = max(int(piece.starts[r]), lo - CELL), min(int(piece.ends[r]) - p, hi + CELL)
            left = np.flatnonzero(data[least:lo] != data[least + p:lo + p])
            right = np.flatnonzero(data[hi:most] != data[hi + p:most + p])
            lo, hi = (least + int(left[-1]) + 1 if len(left) else least), (hi + int(right[0]) if len(right) else most)
            if hi - lo >= LENGTH:
                found.append((lo, hi - LENGTH, p))
                done.append(chain)
        if done:
            ask = np.setdiff1d(ask, np.concatenate(done), assume_unique=True)
    return tuple(np.array(found, np.int64).reshape(-1, 3).T)


def beside(texts: pa.Array) -> dict[int, tuple[list[int], list[int]]]:
    """For rows with periodic stretches: first and last starts of their windows, in the text."""
    out: dict[int, tuple[list[int], list[int]]] = {}
    for piece in pieces(texts):
        lo, hi, p = periodic(piece)
        row = row_of(piece, lo)
        base = piece.starts[row]
        for r, s, e, q in zip((piece.first + row).tolist(), (lo - base).tolist(), (hi - base).tolist(), p.tolist()):
            starts, ends = out.setdefault(r, ([], []))
            starts += [s, s + q]
            ends += [e, e + q]
    return out


def triggers(piece: Piece, hasher: Hasher) -> tuple[np.ndarray, np.ndarray]:
    """All window starts of the piece's texts and the trigger of each."""
    n = len(piece.data)
    size = np.maximum(0, piece.ends - piece.starts - LENGTH + 1)
    if not size.sum():
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    first = np.repeat(piece.starts - (np.cumsum(size) - size), size)
    windows = first + np.arange(size.sum())
    at = np.arange(n - GRAM + 1)
    place = np.uint64((1 << 28) - 1)                     # low bits: the position, so ties go left
    key = (hasher.of(at, at + GRAM) & ~place) | at.astype(np.uint64)
    blocks = -(-len(key) // SPAN)
    padded = np.full(blocks * SPAN, np.iinfo(np.uint64).max, np.uint64)
    padded[:len(key)] = key
    padded = padded.reshape(blocks, SPAN)
    ahead = np.minimum.accumulate(padded, axis=1).ravel()
    behind = np.minimum.accumulate(padded[:, ::-1], axis=1)[:, ::-1].ravel()
    least = np.minimum(behind[windows], ahead[windows + SPAN - 1])
    return windows, (least & place).astype(np.int64)


def _phrases(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids, hashes = batch["doc_id"], batch["th"].to_numpy()
        for p in pieces(batch["text"]):
            h = Hasher(p.data)
            i, a = triggers(p, h)
            if len(i):
                later = np.zeros(len(p.data) + 1, np.int64)    # windows that equal the one a period before
                lo, hi, period = periodic(p)
                np.add.at(later, lo + period, 1)
                np.add.at(later, hi + period + 1, -1)
                first = np.cumsum(later)[i] == 0
                i, a = i[first], a[first]
            if not len(i):
                continue
            new = np.concatenate([[True], (a[1:] != a[:-1]) | (i[1:] != i[:-1] + 1)])
            s, a = i[new], a[new]
            e = i[np.concatenate([np.nonzero(new)[0][1:] - 1, [len(i) - 1]])]
            row = np.searchsorted(p.starts, s, side="right") - 1
            phrase = Hasher(p.data, 2).of(s, e + LENGTH) ^ (a - s).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
            base = p.starts[row]
            yield pa.record_batch({
                "doc_id": ids.take(pa.array(p.first + row)), "th": hashes[p.first + row],
                "core": h.of(a, a + CORE).view(np.int64), "phrase": phrase.view(np.int64),
                "s": (s - base).astype(np.int32), "e": (e - base).astype(np.int32), "a": (a - base).astype(np.int32)})


def digest(text: bytes, starts: np.ndarray, ends: np.ndarray) -> tuple[int, int, int, str]:
    """Bytes, removed bytes, removed runs and hash of the rest, for repeated windows ``starts`` to ``ends``."""
    n = len(text)
    if not len(starts):
        return n, 0, 0, hashlib.sha256(text).hexdigest()
    edge = np.zeros(n + 1, np.int64)
    np.add.at(edge, starts, 1)
    np.add.at(edge, ends + LENGTH, -1)
    gone = np.cumsum(edge[:n]) > 0
    spans = int(gone[0]) + int(np.count_nonzero(gone[1:] & ~gone[:-1]))
    kept = np.frombuffer(text, np.uint8)[~gone].tobytes()
    return n, int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()


def blocks(text: bytes, s: np.ndarray, e: np.ndarray, a: np.ndarray) -> dict[str, object]:
    """The blocks of phrases with windows ``s`` to ``e`` and trigger ``a``.

    Block ``number`` has the windows that start ``number * BLOCK`` to ``number * BLOCK + BLOCK - 1``
    bytes before the trigger.  ``at`` is where its common stretch starts; a window that starts k bytes
    earlier has the last k bytes of ``before`` and the first BLOCK - 1 - k of ``behind``."""
    low, n = (a - e) // BLOCK, (a - s) // BLOCK - (a - e) // BLOCK + 1
    phrase = np.repeat(np.arange(len(s)), n)
    number = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + low[phrase]
    at = a[phrase] - number * BLOCK
    to = at - BLOCK + 1 + LENGTH
    common = Hasher(np.frombuffer(text, np.uint8), 3).of(at, to).view(np.int64)
    first, last = np.maximum(s[phrase], at - BLOCK + 1), np.minimum(e[phrase], at) + LENGTH
    return {"phrase": phrase, "numbers": number, "commons": common, "at": at,
            "befores": [text[i:j] for i, j in zip(first.tolist(), at.tolist())],
            "behinds": [text[i:j] for i, j in zip(to.tolist(), last.tolist())]}


def _first_pass(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Final digests where whole phrases decide; else the text and its rims' blocks."""
    longs, ints, binaries = pa.list_(pa.int64()), pa.list_(pa.int32()), pa.list_(pa.binary())
    kinds = [("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()),
             ("kept_sha256", pa.string()), ("th", pa.int64()), ("text", pa.string()), ("starts", ints), ("ends", ints),
             ("cores", longs), ("numbers", ints), ("commons", longs), ("befores", binaries), ("behinds", binaries),
             ("at", ints)]
    for batch in batches:
        for k in range(0, batch.num_rows, 200):
            rows, part = [], batch.slice(k, 200)
            near = beside(part["text"])
            for n, r in enumerate(part.to_pylist()):
                text = (r["text"] or "").encode()
                found = r["found"] or []
                whole = [f for f in found if f["whole"]]
                starts, ends = near.get(n, ([], []))
                s = np.array([f["s"] for f in whole] + starts, np.int64)
                e = np.array([f["e"] for f in whole] + ends, np.int64)
                ask = [f for f in found if f["entry"]]
                told = (None,) * 6
                if ask:
                    b = blocks(text, *(np.array([f[c] for f in ask], np.int64) for c in "sea"))
                    core = np.array([f["core"] for f in ask], np.int64)[b["phrase"]]
                    told = core, b["numbers"], b["commons"], b["befores"], b["behinds"], b["at"]
                open_ = any(not f["whole"] for f in found)
                d = (None,) * 4 if open_ else digest(text, s, e)
                rows.append((r["doc_id"], *d, r["th"], r["text"] if open_ else None, s if open_ else None,
                             e if open_ else None, *told))
            cols = list(zip(*rows))
            yield pa.record_batch([pa.array(c, t) for c, (_, t) in zip(cols, kinds)], names=[n for n, _ in kinds])


def _last_pass(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        for r in batch.to_pylist():
            more = r["more"] or []
            s = np.array(r["starts"] + [m["s"] for m in more], np.int64)
            e = np.array(r["ends"] + [m["e"] for m in more], np.int64)
            rows.append((r["doc_id"], *digest((r["text"] or "").encode(), s, e)))
        cols = list(zip(*rows)) or [()] * 5
        yield pa.record_batch([pa.array(c, t) for c, t in zip(cols, [pa.int64()] * 4 + [pa.string()])],
                              names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])


def _repeated(first: DataFrame) -> DataFrame:
    """``doc_id, th, s, e``: stretches of repeated windows in the blocks that the first pass tells.

    A row that repeats a document tells its blocks again, but then its phrases are repeated as a whole."""
    b = F.explode(F.arrays_zip("cores", "numbers", "commons", "befores", "behinds", "at")).alias("b")
    told = first.filter("at is not null").select("doc_id", "th", b).select(
        "doc_id", "th", *[F.col(f"b.{c}s").alias(c) for c in ("core", "number", "common", "before", "behind")], "b.at")
    rim = F.xxhash64(F.length("before"), "before", "behind")
    key = ["core", "number", "common"]
    agree = (told.groupBy(key).agg(F.count("*").alias("n"), F.min(rim).alias("lo"), F.max(rim).alias("hi"))
             .filter("n > 1").select(*key, (F.col("lo") == F.col("hi")).alias("agree")))
    met = written(told.join(agree, key), "blocks")
    # windows start from length(before) down to BLOCK - 1 - length(behind) bytes before the common stretch
    least = BLOCK - 1 - F.length("behind")
    whole = met.filter("agree").select("doc_id", "th", (F.col("at") - F.length("before")).alias("s"),
                                       (F.col("at") - least).alias("e"))
    k = F.col("k")
    window = F.xxhash64("common", k, F.substring("before", F.length("before") - k + 1, k),
                        F.substring("behind", F.lit(1), F.lit(BLOCK - 1) - k))
    windows = (met.filter("not agree").withColumn("k", F.explode(F.sequence(least, F.length("before"))))
               .select("doc_id", "th", "core", "number", window.alias("h"), (F.col("at") - k).alias("i")))
    again = windows.groupBy("core", "number", "h").count().filter("count > 1").drop("count")
    return whole.unionByName(windows.join(again, ["core", "number", "h"]).select(
        "doc_id", "th", F.col("i").alias("s"), F.col("i").alias("e")))


def remove_repeats(docs: DataFrame) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept_sha256`` of every row of ``docs`` (``doc_id``, ``text``)."""
    text = docs.select("doc_id", F.xxhash64("text", F.lit("row")).alias("th"), "text")
    phrases = written(text.mapInArrow(_phrases, PHRASES), "phrases")
    cores = phrases.groupBy("core").agg(F.count("*").alias("n"), F.min("phrase").alias("lo"), F.max("phrase").alias("hi"))
    # written, so that the join below reads both sides from plain shuffles, which AQE splits at a hot core
    cores = written(cores.filter("n > 1").select("core", (F.col("lo") != F.col("hi")).alias("mixed")), "cores")
    shared = written(phrases.join(cores, "core"), "shared")
    mixed = shared.filter("mixed")
    entry = mixed.groupBy("core", "phrase").agg(
        F.count("*").alias("n"), F.min(F.struct("doc_id", "th", "s")).alias("entry"))   # one entry for all copies
    here = F.struct("doc_id", "th", "s")
    told = mixed.join(entry, ["core", "phrase"]).select(
        "doc_id", "th", "s", "e", "a", "core", (F.col("n") > 1).alias("whole"), here.eqNullSafe(F.col("entry")).alias("entry"))
    every = told.unionByName(shared.filter("not mixed").select(
        "doc_id", "th", "s", "e", "a", "core", F.lit(True).alias("whole"), F.lit(False).alias("entry")))
    # at most one phrase per trigger of the text; rows that repeat a document give the same ones
    found = every.groupBy("doc_id", "th").agg(F.collect_set(F.struct("s", "e", "a", "core", "whole", "entry")).alias("found"))
    found = found.select(F.col("doc_id").alias("f_doc"), F.col("th").alias("f_th"), "found")
    on = F.col("doc_id").eqNullSafe(F.col("f_doc")) & (F.col("th") == F.col("f_th"))
    first = written(text.join(found, on, "left").select("doc_id", "th", "text", "found").mapInArrow(_first_pass, FIRST),
                    "first-pass")
    more = (_repeated(first).groupBy("doc_id", "th").agg(F.collect_set(F.struct("s", "e")).alias("more"))
            .select(F.col("doc_id").alias("f_doc"), F.col("th").alias("f_th"), "more"))
    rest = (first.filter("kept_sha256 is null").select("doc_id", "th", "text", "starts", "ends").join(more, on, "left")
            .select("doc_id", "text", "starts", "ends", "more").mapInArrow(_last_pass, DIGEST))
    return first.filter("kept_sha256 is not null").select(*rest.columns).unionByName(rest)
