"""Operators of the training-data package against brute force on small fixtures."""

import collections
import hashlib
import re
import zlib

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from civicspark.llm import (components, decontaminate, html_extract, jaccard_join, langid, mixing, repeats, ring, topk,
                            toxicity, warc)
from tests.conftest import SF_SMALL


def table(spark, name):
    return spark.read.parquet(f"{SF_SMALL}/{name}.parquet")


# --- sharding -------------------------------------------------------------------------

def test_ring_counts_slots_and_values(spark, docs):
    rows = ring.shard_documents(docs, shards=4, vnodes=8).collect()
    texts = collections.Counter((i, len((t or "").encode()) + 8, zlib.crc32((t or "").encode()))
                                for i, t in docs.select("doc_id", "text").toLocalIterator())
    assert collections.Counter((r.doc_id, r["size"], r.text_crc32) for r in rows) == texts
    per = collections.defaultdict(list)
    for r in rows:
        per[r.shard].append(r.slot)
    assert all(sorted(v) == list(range(len(v))) for v in per.values())
    assert max(map(len, per.values())) - min(map(len, per.values())) <= 1 and len(per) == 4
    assert {r.law for r in rows} == {"rows"}


def test_ring_empty_and_limited_movement(spark, no_docs):
    assert ring.shard_documents(no_docs).count() == 0
    d = spark.range(5000).select(F.col("id").alias("doc_id"), F.lit("x").alias("text"))
    a = {r.doc_id: r.shard for r in ring.shard_documents(d, 24).collect()}
    b = {r.doc_id: r.shard for r in ring.shard_documents(d, 25).collect()}
    assert sum(a[k] != b[k] for k in a) < 0.15 * len(a)


def test_ring_plan_covers_every_rank():
    nodes = ring.virtual_nodes(5, 4)
    counts = {0: 17, 3: 1, 7: 50, 19: 2}
    runs = ring.plan_runs(nodes, counts, 5)
    for arc, n in counts.items():
        assert sorted(x for a, f, t, _, _ in runs if a == arc for x in range(f, t)) == list(range(n))
    per = collections.Counter()
    for _, f, t, s, _ in runs:
        per[s] += t - f
    assert sorted(per.values()) == [14] * 5


# --- top-k ----------------------------------------------------------------------------

def test_top_k_against_brute_force(spark):
    rng = np.random.default_rng(3)
    vectors = [(int(i), [float(x) for x in rng.integers(-3, 4, 6) / 7]) for i in range(300)]
    vectors += [(1000 + i, vectors[5][1]) for i in range(60)] + [(7000, None), (7020, [1.0, float("nan")] * 3),
                                                                (None, [1.0] * 6), (7040, [1.0, 2.0])]
    df = spark.createDataFrame(vectors + vectors[:3], "vec_id long, embedding array<float>")
    got = collections.defaultdict(list)
    for r in sorted(topk.exact_top_k(df, F.col("vec_id") % 20 == 0, k=20, bins=8).collect()):
        got[r.query_id].append((r.vec_id, r.score))
    ints = {i: [int(np.floor(64 * float(np.float32(x)))) for x in v] for i, v in vectors
            if i is not None and v is not None and len(v) == 6 and all(np.isfinite(v))}
    for q in [i for i in ints if i % 20 == 0]:
        want = sorted(((sum(a * b for a, b in zip(ints[q], v)), -i) for i, v in ints.items() if i != q), reverse=True)[:20]
        assert got[q] == [(-i, s) for s, i in want]
    assert set(got) == {i for i in ints if i % 20 == 0}


# --- repeats, components, Jaccard ------------------------------------------------------

def test_repeats_against_brute_force(spark, docs, no_docs):
    texts = [(t or "").encode() for (t,) in docs.select("text").toLocalIterator()]
    seen = collections.Counter(b[i:i + 400] for b in texts for i in range(len(b) - 399))
    want = collections.Counter()
    for (i,), b in zip(docs.select("doc_id").toLocalIterator(), texts):
        gone = bytearray(len(b))
        for k in range(len(b) - 399):
            if seen[b[k:k + 400]] > 1:
                gone[k:k + 400] = b"\1" * 400
        kept = bytes(x for x, g in zip(b, gone) if not g)
        spans = sum(g and (k == 0 or not gone[k - 1]) for k, g in enumerate(gone))
        want[(i, len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest())] += 1
    assert collections.Counter(tuple(r) for r in repeats.remove_repeats(docs).collect()) == want
    assert repeats.remove_repeats(no_docs).count() == 0


def test_components(spark):
    edges = [(1, 2), (2, 3), (9, 8), (8, 7), (7, 9), (4, 4)] + [(100 + i, 101 + i) for i in range(20)]
    got = {r.node: r.root for r in components.components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {2: 1, 3: 1, 8: 7, 9: 7, **{100 + i: 100 for i in range(1, 21)}}


def brute_components(rows):
    def words(t):
        low = re.sub("[A-Z]", lambda m: m[0].lower(), t or "")
        w = [x for x in re.split(r"[\x20\x09-\x0D]+", low) if x]
        return {tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())
    sets, root = [words(t) for _, t in rows], list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j]):
                old, new = root[i], root[j]
                root = [new if r == old else r for r in root]
    least = {r: min((rows[k][0] for k in range(len(rows)) if root[k] == r and rows[k][0] is not None), default=None)
             for r in root}
    return collections.Counter((rows[k][0], len(sets[k]), least[root[k]] if sets[k] else rows[k][0])
                               for k in range(len(rows)))


def test_jaccard_against_brute_force(spark, docs, no_docs):
    rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    got = collections.Counter(tuple(r) for r in jaccard_join.link_components(docs).collect())
    assert got == brute_components(rows)
    assert jaccard_join.link_components(no_docs).count() == 0


def test_jaccard_near_copy_cluster(spark, monkeypatch):
    monkeypatch.setattr(jaccard_join, "LARGE", 8)        # small groups take the way of large ones
    rng = np.random.default_rng(1)
    base = [f"w{i}" for i in range(60)]
    rows = []
    for i in range(80):
        w = list(base)
        for k in rng.integers(0, 60, rng.integers(0, 5)):
            w[k] = f"x{rng.integers(0, 50)}"
        rows.append((i, " ".join(w)))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = collections.Counter(tuple(r) for r in jaccard_join.link_components(df).collect())
    assert got == brute_components(rows)


# --- classifiers ------------------------------------------------------------------------

def test_codewords_part_every_pair():
    for n in (1, 2, 4, 6, 9):
        code = langid.codewords(n)
        assert len({tuple(r) for r in code.tolist()}) == (n if n > 1 else len(code))


def test_language_cases(spark, docs, no_docs):
    rows = {(r.doc_id, r.lang_pred): r for r in langid.identify(docs).collect()}
    assert {p for i, p in rows if i in (4, 5, 6, 11)} == {"und"}
    assert all(0 <= r.score <= 1 for r in rows.values())
    assert langid.identify(no_docs).count() == 0


def test_language_held_out_accuracy(spark):
    d = table(spark, "documents")
    r = langid.identify(d).join(d.select("doc_id", "lang"), "doc_id").filter("held_out")
    assert r.agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).first()[0] > 0.95


def test_toxicity_cases_and_learning(spark, docs, no_docs):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert {r.score for r in toxicity.classify(docs, none).collect()} == {0.0}
    assert toxicity.classify(no_docs, none).count() == 0
    rows = [(i, ("plain words here " * 5) + ("scum idiot " if i % 10 == 0 else ""), int(i % 10 == 0)) for i in range(400)]
    d = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    out = toxicity.classify(d, d.select("doc_id", "toxic")).collect()
    assert all(r.predicted == int(r.doc_id % 10 == 0) for r in out)


# --- archives, pages, benchmark, mixing ---------------------------------------------------

def test_warc_round_trip(spark):
    big = "<p>" + "x" * 2000 + "\r\n\r\nWARC/1.1\r\n</p>"
    rows = [(1, "http://a/ b", big), (2, None, big), (3, "u", "small"), (4, "u", "small"), (None, "v", big), (5, "n", None),
            (2, None, big)]
    got = collections.Counter(tuple(r) for r in warc.round_trip(
        spark.createDataFrame(rows, "page_id long, url string, html string")).collect())
    sha = lambda t: hashlib.sha1((t or "").encode()).hexdigest()
    n = len(big)
    want = [(1, n, sha(big), "revisit", 2), (2, n, sha(big), "response", None), (2, n, sha(big), "revisit", 2),
            (None, n, sha(big), "revisit", 2), (3, 5, sha("small"), "response", None),
            (4, 5, sha("small"), "response", None), (5, 0, sha(""), "response", None)]
    assert got == collections.Counter(want)


@pytest.mark.parametrize("page,want", [
    (None, ""), ("", ""), ("<script>var a='<p>x</p>';</script>", ""),
    ("<body><nav><a>Menu one</a></nav><article><h1>Head &amp; line</h1><p>First  long text, with points. More."
     "<p>Second<br>paragraph here.</article><div class=comments><p>Nice post, thanks!</p></div><footer>c</footer>",
     "Head & line\nFirst long text, with points. More.\nSecond paragraph here."),
    ("<body><div id=main><p>A sentence of some length, it goes on.</p><p>Another one, also long enough.</p></div>"
     "<aside>ads</aside><form>q</form><!-- open", "A sentence of some length, it goes on.\nAnother one, also long enough."),
])
def test_main_text(page, want):
    assert html_extract.main_text(page) == want


def test_templates_find_new_parameters(spark):
    item = "A train leaves the station at 9 and travels 120 km before Anna boards with 3 heavy bags of old books."
    other = "A train leaves the station at 7 and travels 300 miles before Peter boards with 5 heavy bags of old books."
    broken = "A train leaves the station at 9 and travels 9 km then a train leaves the station at 4 and travels 4 km"
    docs = spark.createDataFrame([(1, "intro. " + item), (2, "So. " + other + " end"), (3, "nothing of it"), (4, None), (5, "")],
                                 "doc_id long, text string")
    bench = spark.createDataFrame([(7, item), (8, item), (9, None)], "item_id long, text string")
    got = {(r.doc_id, r.item_id, r.exact) for r in decontaminate.contaminated(docs, bench).collect()}
    assert got == {(1, 7, True), (2, 7, False)}
    same = spark.createDataFrame([(1, "we count 5 apples and 5 pears and 5 plums in the big basket today")], "item_id long, text string")
    mixed = spark.createDataFrame([(1, "we count 5 apples and 6 pears and 7 plums in the big basket today"),
                                   (2, "we count 8 apples and 8 pears and 8 plums in the big basket today")], "doc_id long, text string")
    assert {r.doc_id for r in decontaminate.contaminated(mixed, same).collect()} == {2}
    assert broken and decontaminate.contaminated(docs.limit(0), bench).count() == 0
    assert decontaminate.contaminated(docs, bench.limit(0)).count() == 0


LONG = "A sentence of some length, it goes on, and on."
OTHER = "Another sentence, also long enough, with points."


@pytest.mark.parametrize("page,want", [
    (f"<body><div>{x}</div><article><p>{LONG}</p><p>{OTHER}</p></article></body>", f"{LONG}\n{OTHER}")
    for x in ("<svg class=icon />", "<math/>", "<a><svg class=icon><path d='M0'/></a>", "<object data=x>", "<template><p>no",
              "<svg><title/><g><text>no</text></g></svg>", "<svg><foreignObject><p>no</p></foreignObject></svg>")
] + [
    (f"<article><p>{LONG} <svg><text>no</text></svg><math><mi>x</mi><mo>=</mo><mn>2</mn></math> holds.</p><p>{OTHER}</p></article>",
     f"{LONG} x=2 holds.\n{OTHER}"),
    (f"<article><p><svg><g>{LONG}</p><p>{OTHER}</p><object>Kept, as text.</object></article>", f"{OTHER}\nKept, as text."),
])
def test_main_text_beside_foreign_elements(page, want):
    assert html_extract.main_text(page) == want


PARTS = f"<p>{LONG}</p><p>{OTHER}</p>"


@pytest.mark.parametrize("page,want", [
    (f"<body><div class='{c}'>{PARTS}</div></body>", f"{LONG}\n{OTHER}")
    for c in ("content has-sidebar", "no-sidebar", "with-comments", "header-fixed", "page modal-ready", "sidebar")
] + [
    (f"<body><div class=widget><article>{PARTS}</article></div><div class=related><p>{LONG}</p></div>", f"{LONG}\n{OTHER}"),
    (f"<article><div class='article-header'><h1>Head</h1></div><h2 id='related-work'>Work</h2>{PARTS}"
     f"<section id='side-effects'><p>{OTHER}</p></section><p id='notice-period'>{LONG}</p></article>",
     f"Head\nWork\n{LONG}\n{OTHER}\n{OTHER}\n{LONG}"),
] + [
    (f"<body><article>{PARTS}</article><div class='{c}'><p>{LONG}</p></div></body>", f"{LONG}\n{OTHER}")
    for c in ("sidebar", "comments-area", "ad-slot", "page__sidebar", "x related-posts")
])
def test_main_text_rejecting_words(page, want):
    assert html_extract.main_text(page) == want


def paragraphs(name, n):
    return [f"{name} number {i} is a sentence of some length, it goes on, and on." for i in range(n)]


@pytest.mark.parametrize("frame", [
    "<body><div class=part-a>{a}</div><div class=part-b>{b}</div></body>",
    "<body><main><article>{a}</article><section>{b}</section></main></body>",
    "<body><div class=part-a>{a}</div>{b}</body>", "<body>{b}<article>{a}</article></body>",
])
def test_main_text_keeps_all_content_paths(frame):
    a, b = paragraphs("First", 6), paragraphs("Second", 3)
    page = frame.format(a="".join(f"<p>{x}</p>" for x in a), b="".join(f"<p>{x}</p>" for x in b))
    assert sorted(html_extract.main_text(page).split("\n")) == sorted(a + b)


def leaks(spark, docs, items):
    frame = lambda texts, key: spark.createDataFrame(list(enumerate(texts)), f"{key} long, text string")
    found = decontaminate.contaminated(frame(docs, "doc_id"), frame(items, "item_id")).collect()
    return {(r.doc_id, r.item_id, r.exact) for r in found}


def test_templates_of_mostly_placeholders_match_literally(spark):
    items = ["3 apples, 4 pears, 5 plums, 6 figs, 7 nuts, 8 eggs", "Compute 12 + 45 * 7",
             "the Quick Brown Fox Jumps Over The Lazy Dog And Runs Far Away Home",
             "Add 3 km 4 kg 5 cm 6 mg 7 ml and then say how many whole litres"]
    docs = ["We bought: " + items[0] + ". Done.", "We bought: 3 apples, 4 pears, 5 plums, 6 figs, 9 nuts, 8 eggs",
            items[1], "Compute 12 + 45 * 8", "so " + items[2] + " they say", "nothing of it",
            "Add 1 km 2 kg 8 cm 9 mg 0 ml and then say how many whole litres"]
    assert leaks(spark, docs, items) == {(0, 0, True), (2, 1, True), (4, 2, True), (6, 3, False)}


def test_templates_find_short_items_in_any_context(spark):
    items = ["What is the capital of France?", "Which of these planets has the largest known ring system?",
             "Days are counted from the spring of each year", "Anna has 3 cats", "12"]
    docs = ["Question: " + items[0] + " Paris, of course, as everybody in the room knew.", items[0],
            "Later he asked, " + items[1] + " Nobody said anything for a while.", "we read 'which " + items[1][6:] + "'",
            "After 3 days are counted from the spring of each year it ends", "They said that Anna has 3 cats and one dog",
            "They said that Peter has 5 cats and one dog", "Which of these planets has the largest", "page 12 of it"]
    assert leaks(spark, docs, items) == {(0, 0, True), (1, 0, True), (2, 1, True), (3, 1, True), (4, 2, True),
                                         (5, 3, True), (8, 4, True)}


def test_mixing_meets_targets(spark, no_docs):
    d, labels = table(spark, "documents"), table(spark, "labels")
    domain = F.when(F.col("quality") == 1, "high").when(F.col("quality") == 0, "low")
    for keep_all in (False, True):
        out = mixing.mix(d, labels, domain, {"high": 0.7, "low": 0.3}, keep_all=keep_all).collect()
        total = sum(r.rate * r.tokens for r in out)
        for name, share in (("high", 0.7), ("low", 0.3)):
            assert abs(sum(r.rate * r.tokens * r[f"p_{name}"] for r in out) / total - share) < 1e-4
        assert min(r.rate for r in out) >= float(keep_all) and {r.gap for r in out} == {out[0].gap} and out[0].gap <= 1e-5
        assert min(r.copies for r in out) >= int(keep_all)
    assert mixing.mix(no_docs, labels, domain, {"high": 1.0}).count() == 0
    assert {r.rate for r in mixing.mix(d, labels.limit(0), domain, {"high": 1.0}).collect()} == {1.0}


def test_mixing_posterior_against_brute_force(spark, docs):
    """Words hashed with Spark's hash, counts and weights in plain Python."""
    d = docs.select("doc_id", "text", F.lit("x").alias("chars"))
    said = spark.createDataFrame([(1, "a"), (2, "a"), (8, "b"), (9, "b"), (7, "b"), (10, "c"), (4, "c")], "doc_id long, g string")
    rows = [(r.doc_id, r.text) for r in d.collect()]
    got = {(r.doc_id, r.tokens): [r.p_a, r.p_b, r.p_c] for r in mixing.mix(d, said, F.col("g"), {"a": 1.0, "b": 1.0, "c": 1.0}).collect()}

    def features(text):
        words = (text or "").lower().split()
        kinds = {xxhash.xxh64(w.encode(), seed=42).intdigest() for w in words}
        n = max(1, len(words))
        bins = [min(15, int(np.log2(len(words) + 1))), min(15, max(1, len(text or "")) // n), int(min(0.999, len(kinds) / n) * 16)]
        return len(words), [int(np.uint64(h).view(np.int64)) % mixing.BUCKETS for h in kinds], bins
    domains, label = ["a", "b", "c"], {r.doc_id: r.g for r in said.collect()}
    counts, n = np.zeros((3, mixing.BUCKETS)), np.zeros(3)
    bins = np.zeros((3, 3, 16))
    for i, t in rows:
        if i in label:
            k = domains.index(label[i])
            _, f, b = features(t)
            n[k] += 1
            for x in f:
                counts[k, x] += 1
            for j, x in enumerate(b):
                bins[k, j, x] += 1
    prior = np.array([2.0, 3.0, 2.0])
    p, share = (np.minimum(counts, n[:, None]) + 0.5) / (n[:, None] + 1), prior / prior.sum()
    for i, t in rows:
        tokens, f, b = features(t)
        log = np.log(share)
        for k in range(3):
            for x in f:
                rest = n.sum() - n[k]
                q = (np.minimum(counts, n[:, None]).sum(0)[x] - min(counts[k, x], n[k]) + 0.5) / (rest + 1)
                pooled = (np.minimum(counts, n[:, None]).sum(0)[x] + 0.5) / (n.sum() + 1)
                z = (p[k, x] - q) / np.sqrt(pooled * (1 - pooled) * (1 / n[k] + 1 / rest))
                if abs(z) >= mixing.Z_LEAST:
                    log[k] += np.log(p[k, x]) - np.log(share @ p[:, x])
            for j, x in enumerate(b):
                log[k] += np.log((bins[k, j, x] + 0.5) / (n[k] + 8))
        want = np.exp(log - log.max())
        assert np.allclose(got[i, tokens], want / want.sum(), atol=1e-6)


def test_mixing_fit_is_optimal_and_reports_what_it_cannot_meet(spark):
    rng = np.random.default_rng(5)
    p = rng.dirichlet([0.4, 0.4, 0.4], 400)
    rows = [(int(w), [float(x) for x in q]) for w, q in zip(rng.integers(0, 900, 400), p)]
    df = spark.createDataFrame(rows + rows[:40], "tokens long, p array<double>")
    for keep_all in (False, True):
        rate, gap = mixing.fit_rates(df, [0.6, 0.3, 0.1], keep_all)
        out = df.withColumn("rate", rate).collect()
        have = sum(r.rate * r.tokens * np.array(r.p) for r in out)
        assert gap <= 1e-5 and np.allclose(have / have.sum(), [0.6, 0.3, 0.1], atol=1e-4)
        assert min(r.rate for r in out) >= float(keep_all)
    # no mixture of these posteriors has 9 tenths of the first: the best is taken and its gap told
    stuck = spark.createDataFrame([(100, [0.5, 0.5]), (50, [0.4, 0.6])] * 5, "tokens long, p array<double>")
    rate, gap = mixing.fit_rates(stuck, [0.9, 0.1])
    have = sum(r.rate * r.tokens * np.array(r.p) for r in stuck.withColumn("rate", rate).collect())
    assert gap > 0.01 and np.isclose(np.abs(have - np.array([0.9, 0.1]) * 750).max() / 750, gap)
    first = sum(r.tokens * np.array(r.p) for r in stuck.collect())
    assert gap <= np.abs(first - np.array([0.9, 0.1]) * 750).max() / 750
