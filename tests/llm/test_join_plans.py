"""Constants of the Jaccard join change its plan, never its links: salted groups, full bitmap, packing in many parts."""

import collections
import random
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest

from civicspark.llm import jaccard_join
from civicspark.llm.text_bytes import pieces
from tests.llm.test_operators import brute_components

PLANS = {
    "salted": {"HEAVY_LEAST": 1, "CHUNK": 200, "ROWS_PER_GROUP": 2, "LARGE": 4},
    "one heavy shingle": {"HEAVY": 1, "CHUNK": 100, "ROWS_PER_GROUP": 3},
    "full bitmap, many packs": {"BITMAP_BITS": 2, "CHUNK_ENTRIES": 50, "ENTRIES_PER_BUCKET": 50},
    "large groups": {"LARGE": 2, "KNOWN": 1, "CENTRES": 1, "PART_MOST": 1},
}


def rows():
    """Copies, chains of near copies, texts that share a passage, and others."""
    rng = random.Random(4)
    word = lambda: f"w{rng.randrange(3000)}"
    texts = ["", None, "a b", "a b", "A  b"]
    for size in (7, 30, 60):
        base = [word() for _ in range(size)]
        for _ in range(12):
            near = list(base)
            for _ in range(rng.randrange(3)):
                near[rng.randrange(size)] = word()
            texts.append(" ".join(near))
        for _ in range(10):                                  # a chain: each a little further from the first
            base = base[1:] + [word()]
            texts.append(" ".join(base))
    passage = " ".join(word() for _ in range(25))            # frequent shingles in texts that are no copies
    for _ in range(25):
        texts.append(" ".join(word() for _ in range(20)) + " " + passage + " " + " ".join(word() for _ in range(20)))
    for _ in range(6):                                       # almost the passage alone
        texts.append(passage + " " + " ".join(word() for _ in range(rng.randrange(6))))
    rng.shuffle(texts)
    return [(i, t) for i, t in enumerate(texts)]


@pytest.mark.parametrize("plan", list(PLANS))
def test_links_do_not_depend_on_the_plan(spark, monkeypatch, plan):
    for name, value in PLANS[plan].items():
        assert hasattr(jaccard_join, name)
        monkeypatch.setattr(jaccard_join, name, value)
    given = rows()
    df = spark.createDataFrame(given, "doc_id long, text string").repartition(3)
    got = collections.Counter(tuple(r) for r in jaccard_join.link_components(df).collect())
    want = brute_components(given)
    assert got == want and max(collections.Counter(c for _, _, c in want).values()) > 5


def test_shingles_are_counted_in_little_memory():
    rng = np.random.default_rng(5)
    values = [rng.integers(0, 1 << 48, 50_000, np.uint64) for _ in range(20)]
    for v in values[:4]:
        v[:100] = values[0][:100]
    tracemalloc.start()
    token, n = jaccard_join._repeated(values)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < sum(v.nbytes for v in values)                # the form before had more than twice as much
    every, count = np.unique(np.concatenate(values), return_counts=True)
    often = count >= jaccard_join.HEAVY_LEAST
    assert token.tolist() == every[often].tolist() and n.tolist() == count[often].tolist() and len(n) == 100
    assert [len(c) for c in jaccard_join._repeated([])] == [0, 0]


def test_packed_entries_come_back_in_few_bytes():
    e = jaccard_join.Entries(np.array([3, 3, 1 << 47], np.uint64), np.array([-1, 0, 7], np.int32), np.array([-5, 9, -5]),
                             np.array([40, 6, 40], np.int32), np.array([1, 2, 3], np.int32))
    back = jaccard_join.unpack(*jaccard_join.pack(e))
    assert [c.tolist() for c in back] == [c.tolist() for c in e]
    assert sum(c.itemsize for c in back) == 28


def test_pieces_in_lower_case():
    texts = pa.array(["Ab Ä", None, "", "ZZ z"])
    assert b"".join(bytes(p.data) for p in pieces(texts, 8, lower=True)) == "ab Ä   zz z ".encode()


def members(groups):
    """Entries of one bucket in one pack, from (shingle, [(set, size, place)])."""
    rows = [(token, -1, node, n, pos) for token, group in groups for node, n, pos in group]
    kinds = (np.uint64, np.int32, np.int64, np.int32, np.int32)
    packed = jaccard_join.pack(jaccard_join.Entries(*(np.array(c, k) for c, k in zip(zip(*rows), kinds))))
    return pa.table({c: [v] for c, v in zip(("n", "size", "packed"), packed)})


def test_members_that_nothing_in_their_group_can_equal_go_no_further():
    few = [(1, [(10, 100, 1), (11, 100, 5)]),                  # similar, as far as this shingle tells
           (2, [(10, 100, 2), (12, 400, 2)]),                  # sizes differ too much
           (3, [(10, 100, 25), (13, 100, 1)]),                 # at most 76 of 200 in common
           (4, [(14, 100, 3), (15, 30, 1), (16, 110, 3), (17, 900, 1)])]
    many = [(5, [(100 + k, 10 * 2 ** (k % 12), 1) for k in range(jaccard_join.LARGE)])]
    got = jaccard_join._groups(members(few + many)).to_pylist()
    assert [(r["token"], r["node"], r["first"]) for r in got if r["token"] < 5] == [(1, 10, 10), (1, 11, 10), (4, 14, 14), (4, 16, 14)]
    assert len([r for r in got if r["token"] == 5]) == jaccard_join.LARGE
    assert jaccard_join._groups(members(few[1:3])).num_rows == 0


def test_long_sets_are_told_apart_by_their_cells(spark):
    """Cells never rule out a similar pair, and do rule out unlike ones, of 5 shingles or 20,000."""
    rng = np.random.default_rng(6)
    rows, like = [], []
    for n in (1, 5, 40, 390, 1030, 5000, 20_000):
        for other, common in ((n, 0), (n, n // 3), (n, n - n // 8), (n, n), (n * 4 // 3, n), (n - n // 8, n - n // 8)):
            values = rng.integers(0, 1 << jaccard_join.VALUE_BITS, n + other, np.uint64)
            sets = values[:n], np.concatenate([values[:common], values[n:n + other - common]])
            s = jaccard_join.Shingles(np.repeat([0, 1], [n, other]), np.concatenate(sets), np.array([n, other]))
            x, y = jaccard_join.cells(s).to_pylist()
            rows.append((len(rows), x, y, n, other))
            like.append((common, n, other))
    assert max(len(r[1]) for r in rows) * 8 <= 20_000          # bytes: less than half of one to a shingle's cell
    df = spark.createDataFrame(rows, "k int, x array<long>, y array<long>, nx int, ny int")
    passed = {r["k"] for r in df.filter(jaccard_join._may_overlap("x", "y", df["nx"], df["ny"])).collect()}
    for k, (common, n, other) in enumerate(like):
        similar = common * 175 >= (n + other) * 75
        assert (k in passed) >= similar
        assert similar or n < 40 or common > n // 3 or k not in passed


@pytest.mark.parametrize("kind", [pa.string(), pa.large_string()])
def test_pieces_of_a_slice_have_its_own_bytes(kind):
    texts = [f"Row {k} " * 50 for k in range(40)]
    part = pa.array(texts, kind).slice(7, 30)
    assert b"".join(bytes(p.data) for p in pieces(part, 1000, lower=True)) == "".join(t.lower() + " " for t in texts[7:37]).encode()


def test_all_pairs_of_a_long_batch_are_tested_on_their_own_texts():
    """More than a piece of them: the other texts are a slice of the batch."""
    rng = random.Random(8)
    texts = [" ".join(f"w{rng.randrange(10**6)}" for _ in range(400)) for _ in range(500)]
    n = len(texts)
    batch = pa.record_batch({"a": pa.array(range(n)), "b": pa.array(range(n, 2 * n)), "text_a": texts,
                             "text_b": [t.upper() if k % 2 else t[::-1] for k, t in enumerate(texts)]})
    assert sum(map(len, texts)) > 1_000_000
    assert [u for b in jaccard_join._similar([batch]) for u in b["u"].to_pylist()] == list(range(1, n, 2))
