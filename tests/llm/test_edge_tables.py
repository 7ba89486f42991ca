"""Empty tables, very long texts and clashing columns where the operators' own tests have none."""

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from civicspark.llm import decontaminate, topk, warc

PAGES = "page_id long, url string, html string"


def test_archives_of_no_pages(spark):
    assert warc.round_trip(spark.createDataFrame([], PAGES)).count() == 0


def test_archives_keep_very_long_pages_and_clashing_columns(spark):
    rng = random.Random(1)
    long = "<p>é" + " ".join(str(rng.random()) for _ in range(200_000)) + "</p>\r\n\r\nWARC/1.1\r\n"
    rows = [(1, "u", long, "a", "b"), (3, "v", long, None, None), (2, None, long[:-1], "c", "d"), (4, "", "", "e", "f")]
    df = spark.createDataFrame(rows, PAGES + ", record_type string, payload string")
    got = {r.page_id: (r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in warc.round_trip(df).collect()}
    told = lambda t: (len(t.encode()), hashlib.sha1(t.encode()).hexdigest())
    assert got == {1: (*told(long), "revisit", 3), 3: (*told(long), "response", None),
                   2: (*told(long[:-1]), "response", None), 4: (*told(""), "response", None)}


def test_top_k_of_no_vectors(spark):
    none = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert topk.exact_top_k(none, F.col("vec_id") % 20 == 0).count() == 0
    only = spark.createDataFrame([(20, [1.0]), (21, None)], "vec_id long, embedding array<float>")
    assert topk.exact_top_k(only, F.col("vec_id") % 20 == 0).count() == 0


def test_top_k_beside_clashing_columns(spark):
    df = spark.createDataFrame([(20, [1.0], 5, "a"), (21, [0.5], 6, "b"), (40, [2.0], 7, None)],
                               "vec_id long, embedding array<double>, query_id long, score string")
    got = [tuple(r) for r in topk.exact_top_k(df, F.col("vec_id") % 20 == 0).orderBy("query_id", "rank").collect()]
    assert got == [(20, 1, 40, 64 * 128), (20, 2, 21, 64 * 32), (40, 1, 20, 128 * 64), (40, 2, 21, 128 * 32)]


def test_a_component_beyond_64_bits_ends_the_run(spark):
    df = spark.createDataFrame([(20, [1e300]), (21, [1.0])], "vec_id long, embedding array<double>")
    with pytest.raises(Exception, match="(?i)overflow"):
        topk.exact_top_k(df, F.col("vec_id") % 20 == 0).collect()


ITEM = "A train leaves the old station at 9 and travels 120 km before it stops to take in water and coal"


def test_an_item_deep_inside_a_very_long_text(spark):
    rng = random.Random(2)
    filler = [" ".join(rng.choice(["alder", "birch", "cedar", "dogwood", "elm", "fir"]) + str(rng.randrange(50))
                       for _ in range(60_000)) for _ in range(2)]
    other = ITEM.replace("120", "85").replace("9", "7")
    docs = spark.createDataFrame(
        [(1, f"{filler[0]}. {ITEM}. {filler[1]}", "x", 1), (2, f"{filler[1]}. {other}.", "y", 2), (3, filler[0], "z", 3),
         (4, None, None, None), (5, "", "", 0)], "doc_id long, text string, item_id string, position int")
    items = spark.createDataFrame([(70, ITEM), (71, None), (72, "")], "item_id long, text string")
    got = decontaminate.contaminated(docs, items)
    assert {r.doc_id for r in got.collect()} == {1, 2}
    assert decontaminate.contaminated(docs.limit(0), items).count() == 0
    assert decontaminate.contaminated(docs, items.limit(0)).count() == 0
