"""Windows of long texts are rows that hold their own words; pieces of a text change no row."""

import re

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from civicspark.llm import decontaminate

ITEM = "A baker sells 12 trays of fresh bread each morning and keeps 3 trays for the evening."
SHORT = "Is 7 km far?"
NAMES = "Mr. Smith Went To Washington In 1939 And Ate 3 Eggs. He Left At 5 Pm"


@pytest.fixture
def tables(spark):
    texts = [f"{before}{item}{after}" for item in (ITEM, SHORT, NAMES) for before, after in
             [("", ""), ("x " * 5, " y" * 40), ("word. " * 13, " km 3 km"), ("He asked, ", " and so on." * 20), (". ", "")]]
    texts += [ITEM.replace("12", "7"), "word " * 300, "", " ", ". . .", "(Hello World", None]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    return docs, spark.createDataFrame([(1, ITEM), (2, SHORT), (3, NAMES)], "item_id long, text string")


def test_a_window_is_a_row_with_its_own_words(spark):
    """Before, a text was one row with all its words and a struct for each window."""
    words = [f"W{i % 977}" if i % 5 else str(i) for i in range(5_000)]
    docs = spark.createDataFrame([(1, " ".join(words)), (2, "one, two")], "doc_id long, text string")
    rows = decontaminate.templates(docs, ["doc_id"], [8], False).orderBy("doc_at").collect()
    assert [r.doc_at for r in rows] == list(range(len(words) - 7))
    low = [w.lower() for w in words]
    assert all(r.words == low[r.doc_at:r.doc_at + 8] and r.doc_id == 1 for r in rows)
    assert len({r.hash for r in rows}) > 900


def test_words_are_those_between_marks(spark):
    texts = ["(Hello World", "Hello. World 3 km, 3.5 Km.  Km 7 . km", "a,. .b  .. C d", "1,000.5 kg and 2.Kg 3! kg", "x\nY z|Q r",
             "ΑΣ. ΣΑΣ Σ", "don't Stop. e.g. Smith's", "end.", "", " .", "..."]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for r in decontaminate.canonical_words(docs, ["doc_id"]).collect():
        plain = re.sub(r"(\d)[.,](?=\d)", r"\1", texts[r.doc_id])
        assert [x.v for x in r.w] == [w.lower() for w in re.findall(r"[^\W_]+", plain)]
    forms = {r.doc_id: [x.t for x in r.w] for r in decontaminate.canonical_words(docs, ["doc_id"]).collect()}
    assert forms[0] == ["<name>", "<name>"] and forms[1][:5] == ["hello", "world", "<num>", "<unit>", "<num>"]
    assert forms[1][5:] == ["<name>", "km", "<num>", "km"] and forms[2] == ["a", "b", "c", "d"]


def test_pieces_change_no_row(spark, tables, monkeypatch):
    docs, benchmark = tables
    found = []
    for words in (1, 7, 16, decontaminate.PIECE_WORDS):
        for index_bytes in (decontaminate.INDEX_BYTES, 0):
            with monkeypatch.context() as m:
                m.setattr(decontaminate, "PIECE_WORDS", words)
                m.setattr(decontaminate, "INDEX_BYTES", index_bytes)
                found.append(sorted(map(tuple, decontaminate.contaminated(docs, benchmark).collect())))
    assert all(rows == found[0] for rows in found)
    assert {(r[0], r[1]) for r in found[0]} >= {(5 * k + n, k + 1) for k in range(3) for n in range(5)} | {(15, 1)}
    assert {r[0] for r in found[0]} <= set(range(16)) and {r[3] for r in found[0] if r[0] == 15} == {False}


def test_pipeline_stage_keeps_what_holds_no_item(spark, tables, monkeypatch, tmp_path):
    """The third stage, with texts over many pieces."""
    docs, benchmark = tables
    benchmark.write.parquet(f"{tmp_path}/benchmark.parquet")
    long = spark.createDataFrame([(100, "word " * 3_000 + ITEM + " word" * 3_000), (101, "word " * 6_000)], docs.schema)
    monkeypatch.setattr(decontaminate, "PIECE_WORDS", 64)
    kept = corpus_pipeline.drop_contaminated(spark, docs.unionByName(long), str(tmp_path))
    assert {r.doc_id for r in kept.select(F.col("doc_id")).collect()} == {101} | set(range(16, 22))
