"""Packing: ids against the tokenizers library, plans against item-by-item checks, edge rows."""

import collections
import functools
import random
import zlib

import numpy as np
import public_tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from civicspark.llm import packing


@functools.cache
def tokenizer():
    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    t.encode_special_tokens = True
    return t


def reference_ids(text):
    return [*tokenizer().encode(text or "", add_special_tokens=False).ids, 0]


def check(rows, texts, capacity):
    """Every id of every document is placed once, sequences are gapless and hold at most ``capacity``."""
    want = collections.Counter()
    for doc_id, text in texts:
        ids = reference_ids(text)
        first = len(ids) % capacity or capacity
        cuts = [0, *range(first, len(ids), capacity), len(ids)] if len(ids) > capacity else [0, len(ids)]
        for i, (a, b) in enumerate(zip(cuts, cuts[1:])):
            want[doc_id, i, a, b - a, zlib.crc32(np.array(ids[a:b], "<u4").tobytes())] += 1
    assert collections.Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows) == want
    at = collections.defaultdict(list)
    for r in rows:
        at[r.sequence_id].append((r.offset, r.length))
    for spans in at.values():
        end = 0
        for offset, length in sorted(spans):
            assert offset == end
            end += length
        assert end <= capacity
    return len(at)


def covered(runs, counts, capacity):
    """Expands a plan piece by piece; returns the sequences' fill."""
    ranks, fill = collections.defaultdict(list), collections.defaultdict(list)
    for r in runs:
        for rank in range(r.lo, r.hi):
            k = rank - r.lo
            ranks[r.length].append(rank)
            fill[r.sequence + k // r.per].append((r.offset + k % r.per * r.length, r.length))
    assert {s: sorted(v) for s, v in ranks.items()} == {s: list(range(n)) for s, n in counts.items() if n}
    for spans in fill.values():
        end = 0
        for offset, length in sorted(spans):
            assert offset == end
            end += length
        assert end <= capacity
        assert sum(3 * length > capacity for _, length in spans) <= 2
    return fill


def one_by_one(counts, capacity):
    """Best-fit decreasing, a piece at a time: the count to stay near."""
    rooms = []
    for s in sorted((s for s, n in counts.items() for _ in range(n)), reverse=True):
        fits = [i for i, r in enumerate(rooms) if r >= s]
        if fits:
            rooms[min(fits, key=lambda i: rooms[i])] -= s
        else:
            rooms.append(capacity - s)
    return len(rooms)


@settings(max_examples=150, deadline=None)
@given(st.dictionaries(st.integers(1, 60), st.integers(1, 40), max_size=25))
def test_plan_places_every_piece(counts):
    runs, opened = packing.plan(counts, 60)
    fill = covered(runs, counts, 60)
    assert len(fill) == opened
    total = sum(s * n for s, n in counts.items())
    assert opened >= -(-total // 60)
    assert opened <= 1.25 * one_by_one(counts, 60) + 1


def test_plan_matches_as_many_large_pieces_as_can_be():
    counts = {58: 3, 40: 5, 35: 4, 31: 2, 30: 4, 25: 6, 22: 3, 21: 1}
    runs, opened = packing.plan(counts, 60)
    covered(runs, counts, 60)
    assert opened <= one_by_one(counts, 60)


def test_plan_size_follows_the_capacity_and_not_the_rows():
    rng = random.Random(5)
    counts = {s: rng.randrange(1, 50) for s in range(1, 2049)}
    few, many = packing.plan(counts)[0], packing.plan({s: 1_000_000 * n + s for s, n in counts.items()})[0]
    assert len(few) < 40_000 and len(many) < 40_000


def test_packing_ids_pieces_and_sequences(spark, docs):
    texts = [(r.doc_id, r.text) for r in docs.collect()]
    for capacity in (7, 2048):
        rows = packing.pack(docs, capacity).collect()
        used = check(rows, texts, capacity)
        total = sum(r.length for r in rows)
        assert used <= -(-total // capacity) + 1
    assert packing.pack(docs).columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]


def test_packing_empty_table_and_slices(spark, no_docs, monkeypatch):
    assert packing.pack(no_docs).count() == 0
    # one length holds most rows and one id repeats: ranks run through the slices
    monkeypatch.setattr(packing, "ROWS_PER_SLICE", 50)
    rows = [(None, None)] * 300 + [(5, "")] * 300 + [(i, "word " * (i % 9)) for i in range(400)]
    d = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    used = check(packing.pack(d, 16).collect(), rows, 16)
    total = sum(len(reference_ids(t)) for _, t in rows)
    assert used <= -(-total // 16) + 2


def test_ids_of_long_and_odd_texts_equal_the_tokenizers_library():
    paths = packing.vocabulary()
    texts = ["a <|endoftext|> b", " " * 120_000, "x" * 300_000, ("one two, 3 \n\n" * 40_000), "日本 " * 90_000,
             " \t" * 60_000 + "end", "\x00̀ é‍\U0001f600\r\n\x85 　x", ""]
    for t in texts:
        assert packing.token_ids(t, *paths).tolist() == reference_ids(t)[:-1]
