"""Periodic runs of words in every document, by recompression.

A run is a stretch of words with smallest period q, at least ``LEAST`` words and
``TIMES`` periods long, that cannot be extended with that period.  Per document:

1. Candidates on a harmonic grid.  The places x where word x equals word x + q
   form, for a run of period q, a stretch of at least two steps of the grid with
   step max(q, STEP).  So some grid place and the next one both lie inside it,
   with all words between.  Places that disagree at a few probes are put aside;
   neighbouring ones that are left form chains.  The grid has n ln n places.
2. Extensions.  The words of the documents with chains become one run-length
   grammar (``grammar``).  From a chain's first place, two queries give the exact
   start and end of the stretch; the chain goes on behind it.
3. One stretch is found for its period and for multiples of it; the least stays
   (by the periodicity lemma, as stretches are three periods long).

Nothing is shuffled: a document is a row, and rows are taken in bunches of
bounded size, a longer text alone.  Memory follows the longest text.

Words are what white space (space, tab to carriage return) parts.  Defined
cases: a null, empty or blank text has no word, no run and the hash of an empty
text; a null id is kept, and its words are taken as they are; equal rows give
equal rows; other columns are not read.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from civicspark.llm.grammar import Grammar

LEAST, TIMES = 24, 3          # words and periods of a run, at least
STEP = 8                      # of the grid for short periods; LEAST - STEP >= 2 * STEP
BUNCH_BYTES = 1_000_000       # of the texts taken at once
GRID_AT_ONCE = 1_000_000      # grid places looked at together
QUERIES_AT_ONCE = 500_000
RUNS = ("doc_id long, n_runs long, start long, length long, period long, exponent_milli long, "
        "runs_sha256 string, collapsed_sha256 string")


def bunches(texts: pa.Array, max_bytes: int) -> Iterator[tuple[int, int]]:
    """(first, end) of consecutive rows of bounded size; a longer text is alone."""
    upto = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    first = 0
    while first < len(texts):
        before = upto[first - 1] if first else 0
        end = max(first + 1, int(np.searchsorted(upto, before + max_bytes, side="right")))
        yield first, min(end, len(texts))
        first = end


def words_of(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """All words, and where each text's begin (with the total behind)."""
    lists = pc.ascii_split_whitespace(pc.fill_null(texts, "").cast(pa.large_string()))
    flat = pc.list_flatten(lists)
    true = np.asarray(pc.greater(pc.binary_length(flat), 0).to_numpy(zero_copy_only=False), bool)
    ends = np.cumsum(pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64))
    upto = np.concatenate([[0], np.cumsum(true)])
    return flat.filter(pa.array(true)), np.concatenate([[0], upto[ends]])


def repeated_tail(doc_id: int | None, n: int) -> tuple[int, int] | None:
    """(first word, period) of the words that are overwritten for every tenth checksum."""
    if doc_id is None or not n:
        return None
    g, rest = divmod(zlib.crc32(str(doc_id).encode()), 10)
    if rest:
        return None
    at = g % n
    return at, 1 + (n - at) // (3 + g % 8)


def chains(words: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Text, period, first and last grid place of each chain; ``bounds``: where texts begin."""
    size = np.diff(bounds)
    periods = np.where(size >= LEAST, size // TIMES, 0)
    total = int(periods.sum())
    text = np.repeat(np.arange(len(size)), periods)
    period = np.arange(total) - np.repeat(np.cumsum(periods) - periods, periods) + 1
    step = np.maximum(period, STEP)
    # places k * step with x + step + period still inside the text
    places = np.maximum(0, (size[text] - 1 - period) // step)
    upto = np.cumsum(places)
    out = []
    first = 0
    while first < total:
        before = upto[first - 1] if first else 0
        end = max(first + 1, int(np.searchsorted(upto, before + GRID_AT_ONCE, side="right")))
        n = places[first:end]
        which = np.repeat(np.arange(first, end), n)
        nth = np.arange(len(which)) - np.repeat(np.cumsum(n) - n, n)
        x, q = bounds[text[which]] + nth * step[which], period[which]
        for probe in ("here", "next", *range(1, STEP), "half"):
            ahead = {"here": 0, "next": step[which], "half": step[which] // 2}.get(probe, probe)
            same = words[x + ahead] == words[x + ahead + q]
            which, nth, x, q = which[same], nth[same], x[same], q[same]
        if len(which):
            breaks = np.flatnonzero((which[1:] != which[:-1]) | (nth[1:] != nth[:-1] + 1)) + 1
            heads, tails = np.concatenate([[0], breaks]), np.concatenate([breaks, [len(which)]]) - 1
            out.append((text[which[heads]], q[heads], x[heads], x[tails]))
        first = end
    if not out:
        return (np.zeros(0, np.int64),) * 4
    return tuple(np.concatenate(c) for c in zip(*out))


def find_runs(words: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Text, start (in the text), length and period of all runs, by text, start and period."""
    text, period, at, last = chains(words, bounds)
    none = (np.zeros(0, np.int64),) * 4
    if not len(text):
        return none
    # the texts that have chains, each with symbols of its own around it
    used, place = np.unique(text, return_inverse=True)
    size = np.diff(bounds)[used]
    begins = np.cumsum(size + 1) - size
    fence = int(words.max()) + 1
    symbols = np.arange(fence, fence + size.sum() + len(used) + 1)
    inside = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
    symbols[np.repeat(begins, size) + inside] = words[np.repeat(bounds[used], size) + inside]
    grammar = Grammar(symbols)
    move = begins[place] - bounds[text]
    at, last, step = at + move, last + move, np.maximum(period, STEP)
    found = []
    live = np.arange(len(text))
    while len(live):
        going = []
        for i in range(0, len(live), QUERIES_AT_ONCE):
            part = live[i:i + QUERIES_AT_ONCE]
            x, q = at[part], period[part]
            end = x + q + grammar.extend(x, x + q, True)
            start = x - grammar.extend(x, x + q, False)
            fits = end - start >= np.maximum(LEAST, TIMES * q)
            found.append((part[fits], start[fits], end[fits]))
            # the next grid place behind those of this stretch
            at[part] = x + ((end - q - x) // step[part] + 1) * step[part]
            going.append(part[at[part] <= last[part]])
        live = np.concatenate(going)
    which, start, end = (np.concatenate(c) for c in zip(*found))
    start, length = start - begins[place[which]], end - start
    order = np.lexsort((period[which], length, start, text[which]))
    t, s, n, q = text[which][order], start[order], length[order], period[which][order]
    new = np.concatenate([[True], (t[1:] != t[:-1]) | (s[1:] != s[:-1]) | (n[1:] != n[:-1])]) if len(t) else np.zeros(0, bool)
    t, s, n, q = t[new], s[new], n[new], q[new]
    order = np.lexsort((q, s, t))
    return t[order], s[order], n[order], q[order]


def highest(starts: list[int], lengths: list[int], periods: list[int]) -> int:
    """Index of the run with the greatest exact length / period; the first of equal ones."""
    best = 0
    for i in range(1, len(starts)):
        if lengths[i] * periods[best] > lengths[best] * periods[i]:
            best = i
    return best


def _sha(data) -> str:
    return hashlib.sha256(data).hexdigest()


def _rows(doc_ids: list, texts: pa.Array, rewrite) -> list[tuple]:
    words, bounds = words_of(texts)
    source = np.arange(len(words))
    for d, doc_id in enumerate(doc_ids):
        tail = rewrite(doc_id, int(bounds[d + 1] - bounds[d])) if rewrite else None
        if tail:
            at, period = int(bounds[d]) + tail[0], tail[1]
            source[at:bounds[d + 1]] = at + np.arange(bounds[d + 1] - at) % period
    numbers = words.dictionary_encode().indices.to_numpy(zero_copy_only=False).astype(np.int64)[source]
    text, start, length, period = find_runs(numbers, bounds)
    # words of a run behind its first period go
    edges = np.zeros(len(words) + 1, np.int64)
    np.add.at(edges, bounds[text] + start + period, 1)
    np.add.at(edges, bounds[text] + start + length, -1)
    kept = np.cumsum(edges[:-1]) == 0
    left = np.concatenate([[0], np.cumsum(kept)])[bounds]
    lists = pa.ListArray.from_arrays(pa.array(left, pa.int32()), words.take(pa.array(source[kept])))
    joined = pc.binary_join(lists, pa.scalar(" ", words.type))
    cut = np.searchsorted(text, np.arange(len(doc_ids) + 1))
    out = []
    for d, doc_id in enumerate(doc_ids):
        s, n, q = (c[cut[d]:cut[d + 1]].tolist() for c in (start, length, period))
        top = (None,) * 4
        if s:
            i = highest(s, n, q)
            top = s[i], n[i], q[i], 1000 * n[i] // q[i]
        lines = "".join(f"{a},{b},{c}\n" for a, b, c in zip(s, n, q))
        out.append((doc_id, len(s), *top, _sha(lines.encode()), _sha(joined[d].as_buffer() or b"")))
    return out


def _batches(rewrite):
    names = [f.split()[0] for f in RUNS.split(", ")]
    kinds = [pa.string() if f.endswith("string") else pa.int64() for f in RUNS.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch["doc_id"].to_pylist()
            for first, end in bunches(batch["text"], BUNCH_BYTES):
                rows = _rows(ids[first:end], batch["text"].slice(first, end - first), rewrite)
                yield pa.record_batch([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)
    return run


def periodic_runs(docs: DataFrame, rewrite=None) -> DataFrame:
    """One row per document: its runs, the one with the greatest exponent, and hashes of all runs and
    of the text without repetitions.  ``rewrite(doc_id, n)`` may name a tail that is overwritten by
    repeating its first words (see ``repeated_tail``)."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(_batches(rewrite), RUNS)
