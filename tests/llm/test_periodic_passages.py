"""Repeated passages in periodic texts, against brute force."""

import collections
import hashlib
import random
import time

import numpy as np
import pyarrow as pa
import pytest

from civicspark.llm import repeats
from civicspark.llm.text_bytes import pieces


def brute(rows):
    texts = [(t or "").encode() for _, t in rows]
    seen = collections.Counter(b[i:i + 400] for b in texts for i in range(len(b) - 399))
    want = collections.Counter()
    for (i, _), b in zip(rows, texts):
        gone = bytearray(len(b))
        for k in range(len(b) - 399):
            if seen[b[k:k + 400]] > 1:
                gone[k:k + 400] = b"\1" * 400
        kept = bytes(x for x, g in zip(b, gone) if not g)
        spans = sum(g and (k == 0 or not gone[k - 1]) for k, g in enumerate(gone))
        want[(i, len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest())] += 1
    return want


def made(seed):
    """Texts of periodic stretches just below, at and above the lengths that decide, between other words."""
    rng = random.Random(seed)
    words = lambda n: " ".join(str(rng.randrange(10**6)) for _ in range(n))
    units = ["-", " ", "ab", "=-", "abcabd", "é", "the same old line. ", "x" * 63 + "y", "x" * 64 + "y", "0123456789" * 7]
    texts = [None, "", " " * 399, " " * 400, " " * 401, "-" * 3000]
    for unit in units:
        for n in (399, 400, 401, 400 + len(unit) - 1, 400 + len(unit), 400 + 2 * len(unit), 799, 801, 1500):
            stretch = (unit * (n // len(unit) + 1))[:n]
            texts.append(rng.choice(["", words(30)]) + stretch + rng.choice(["", words(70), stretch[:rng.randrange(n)]]))
    for unit in units[:5]:                       # one window of a longer stretch, elsewhere, out of phase
        at = rng.randrange(len(unit))
        texts.append(words(20) + (unit * 500)[at:at + 400] + words(20))
        texts.append(words(3) + unit * 900 + words(2) + unit * 300)
    rng.shuffle(texts)
    return [(i if i % 11 else None, t) for i, t in enumerate(texts)]


@pytest.mark.parametrize("seed", [1, 2])
def test_periodic_texts_against_brute_force(spark, seed):
    rows = made(seed)
    got = repeats.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string").repartition(3))
    assert collections.Counter(tuple(r) for r in got.collect()) == brute(rows)


def test_lone_windows_meet_a_periodic_text(spark):
    rows = [(1, "-" * 5000), (2, "words before " + "-" * 400 + " and behind"), (3, "+-" * 200), (4, "-+" * 200), (5, "." * 400)]
    got = {r.doc_id: r.n_removed for r in repeats.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {1: 5000, 2: 400, 3: 0, 4: 0, 5: 0}


@pytest.mark.parametrize("unit", ["-", "ab", "one line over and over\n", "0123456789" * 6])
def test_a_periodic_text_has_the_phrases_of_one_period(unit):
    text = (unit * 1_000_000)[:1_000_000]
    start = time.process_time()
    batch = pa.record_batch({"doc_id": [1], "th": pa.array([1], pa.int64()), "text": [text]})
    phrases = sum(b.num_rows for b in repeats._phrases(iter([batch])))
    assert phrases <= 2 * len(unit) + 2 and time.process_time() - start < 10
    (starts, ends), = repeats.beside(batch["text"]).values()
    assert repeats.digest(text.encode(), np.array(starts), np.array(ends))[1] == len(text)


def test_other_texts_have_no_periodic_window():
    rng = random.Random(3)
    texts = pa.array(["".join(rng.choices("ab", k=5000)), " ".join(str(i) for i in range(3000)), None, "x" * 400])
    assert all(not len(repeats.periodic(p)[0]) for p in pieces(texts)) and not repeats.beside(texts)
