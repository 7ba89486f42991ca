"""Periodic runs against brute force, the grammar's extensions, and edge rows."""

import hashlib
import re
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from civicspark.llm import word_runs
from civicspark.llm.grammar import Grammar


def brute_runs(words):
    """Every maximal stretch of each period, the least period of a stretch kept."""
    n, found = len(words), {}
    for q in range(1, n // 3 + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j + q - i >= max(24, 3 * q):
                found.setdefault((i, j + q), q)
            i = j
    return sorted((s, e - s, q) for (s, e), q in found.items())


def brute_row(doc_id, text):
    words = re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode())
    n = len(words)
    if doc_id is not None and n:
        h = zlib.crc32(str(doc_id).encode())
        g = h // 10
        if h % 10 == 0:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    runs = brute_runs(words)
    gone = {i for s, length, q in runs for i in range(s + q, s + length)}
    sha = lambda b: hashlib.sha256(b).hexdigest()
    top = (None,) * 4
    if runs:
        from fractions import Fraction
        s, length, q = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]))
        top = s, length, q, 1000 * length // q
    return (doc_id, len(runs), *top, sha("".join(f"{a},{b},{c}\n" for a, b, c in runs).encode()),
            sha(b" ".join(w for i, w in enumerate(words) if i not in gone)))


def order(rows):
    return sorted(rows, key=repr)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 2), max_size=120), st.integers(1, 12), st.integers(0, 90), st.integers(0, 90))
def test_runs_of_small_alphabets(head, period, copies, noise):
    rng = np.random.default_rng(period * 1000 + copies)
    words = np.array(head + list(np.resize(rng.integers(0, 3, period), copies)) + list(rng.integers(0, 2, noise)), np.int64)
    bounds = np.array([0, len(head), len(words)])
    t, s, n, q = word_runs.find_runs(words, bounds) if len(words) else ([],) * 4
    got = sorted(zip(map(int, t), map(int, s), map(int, n), map(int, q)))
    want = [(0, *r) for r in brute_runs(list(words[:len(head)]))] + [(1, *r) for r in brute_runs(list(words[len(head):]))]
    assert got == sorted(want)


@settings(max_examples=100, deadline=None)
@given(st.integers(0, 10 ** 6), st.integers(1, 4), st.integers(2, 400))
def test_extensions_equal_direct_comparison(seed, letters, n):
    rng = np.random.default_rng(seed)
    s = rng.integers(0, letters, n)
    if seed % 2:
        s = np.resize(s[:int(rng.integers(1, 30))], n)
    s = np.concatenate([[100], s, [101]])
    g = Grammar(s)
    i, j = rng.integers(1, n + 1, 60), rng.integers(1, n + 1, 60)
    i, j = i[i != j], j[i != j]
    for a, b, f, e in zip(i, j, g.extend(i, j, True), g.extend(i, j, False)):
        assert s[a + f] != s[b + f] and (s[a:a + f] == s[b:b + f]).all()
        assert s[a - 1 - e] != s[b - 1 - e] and (s[a - e:a] == s[b - e:b]).all()


def test_grammar_shrinks():
    rng = np.random.default_rng(1)
    for s in (rng.integers(0, 5000, 50_000), np.zeros(50_000, int), np.resize(rng.integers(0, 60, 331), 50_000)):
        levels = Grammar(np.concatenate([[-1], s, [-2]])).levels
        assert sum(len(v.symbols) for v in levels) < 12 * len(s) and len(levels[-1].symbols) <= 64


@pytest.fixture
def periodic(spark):
    rng = np.random.default_rng(8)
    pick = lambda n, k: " ".join(f"w{x}" for x in rng.integers(0, k, n))
    rows = [(i, pick(int(rng.integers(1, 400)), 300)) for i in range(150)]        # a tenth is overwritten
    rows += [(200 + i, pick(30, 50) + "\t" + "\n".join([pick(3 + i, 40)] * 9) + " " + pick(20, 5)) for i in range(20)]
    rows += [(300, "a " * 500), (301, "a b " * 300 + "a a a " * 40), (302, pick(2500, 2)), (303, "é\x0bü\x0c" * 200),
             (304, None), (305, ""), (306, " \t\r\n"), (307, "one"), (None, "x y " * 40), (None, None),
             (308, "a b\x1cc " * 60), (309, "a " * 23), (310, "a " * 24), (311, "a b c d e f g h i " * 3)]
    rows += [(1, rows[1][1]), (1, rows[1][1]), (1, "other " * 30)]
    return rows


def test_documents_against_brute_force(spark, periodic, monkeypatch):
    df = spark.createDataFrame([(i, t, 1, "r") for i, t in periodic], "doc_id long, text string, start int, n_runs string")
    want = order(brute_row(i, t) for i, t in periodic)
    got = word_runs.periodic_runs(df, word_runs.repeated_tail)
    assert order(tuple(r) for r in got.collect()) == want
    for name, value in (("BUNCH_BYTES", 3_000), ("GRID_AT_ONCE", 500), ("QUERIES_AT_ONCE", 3)):
        monkeypatch.setattr(word_runs, name, value)
    assert order(tuple(r) for r in word_runs.periodic_runs(df, word_runs.repeated_tail).collect()) == want
    plain = {r.doc_id: r.n_runs for r in word_runs.periodic_runs(df.filter("doc_id >= 300")).collect()}
    assert plain[300] == 1 and plain[309] == 0 and plain[310] == 1 and plain[311] == 1


def test_long_text_and_empty_table(spark, no_docs):
    assert word_runs.periodic_runs(no_docs).count() == 0
    rng = np.random.default_rng(2)
    base = [f"v{x}" for x in rng.integers(0, 9000, 60_000)]
    text = " ".join(base[:20_000] + base[:700] * 40 + base[20_000:] + ["z"] * 50_000)
    row = word_runs.periodic_runs(spark.createDataFrame([(5, text)], "doc_id long, text string")).first()
    assert row.n_runs == 2 and (row.start, row.length, row.period) == (88_000, 50_000, 1)
