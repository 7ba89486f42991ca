"""What a task of the toxicity stage holds: pieces of a few lowered rows, and no text but the one scored."""

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import functions as F

from civicspark.llm import toxicity


def test_pieces_of_a_batch_are_small_and_whole():
    texts = [f"Ein Ärger ÖL {i} " + "Straße " * (i % 90) for i in range(1_400)] + [None, "", "x" * 500_000, "İstanbul", "END"]
    got = {}
    for batch in (pa.array(texts), pa.array(["ahead"] * 7 + texts).slice(7)):
        for p in toxicity.lowered(batch):
            assert len(p.data) <= toxicity.LOWERED_BYTES or len(p.starts) == 1
            got.update({p.first + k: p.data[s:e].tobytes().decode() for k, (s, e) in enumerate(zip(p.starts, p.ends))})
        assert [got[k] for k in range(len(texts))] == pc.utf8_lower(pc.fill_null(pa.array(texts), "")).to_pylist()
        assert len(got) == len(texts)
        got.clear()


def model(word: str) -> toxicity.Model:
    place = np.full(1 << toxicity.HASH_BITS, -1, np.int32)
    for p in toxicity.lowered(pa.array([word])):
        place[toxicity.hashed_words(p)[0][0]] = 0
    return toxicity.Model(place, np.array([3.0, 0.5, -2.0]), 0.1)


def test_texts_without_a_known_word_are_scored(spark):
    docs = spark.createDataFrame([(k, "plain prose") for k in range(3)] + [(3, None), (4, "")], "doc_id long, text string")
    rows = {r.doc_id: r.score for r in toxicity.score(docs.repartition(5), model("vile"), ["doc_id"]).collect()}
    at = lambda words: 1 / (1 + np.exp(2.0 - 0.5 * np.log1p(words) / 5.0))
    assert np.allclose([rows[k] for k in range(5)], [at(2)] * 3 + [at(0)] * 2)


def test_other_columns_do_not_go_through_python(spark):
    docs = spark.createDataFrame([(1, "vile", "a"), (2, None, "b"), (2, None, "b"), (None, "fine VILE", None)],
                                 "doc_id long, text string, score string")
    out = toxicity.score(docs, model("vile"), docs.columns, "_toxicity")
    assert out.columns == [*docs.columns, "_toxicity"] and out.schema["_toxicity"].dataType.simpleString() == "double"
    plan = out.filter(F.col("_toxicity") < 0.5).select(*docs.columns)._jdf.queryExecution().executedPlan().toString()
    assert "MapInArrow" not in plan and plan.count("ArrowEvalPython") == 1
    rows = out.collect()
    assert sorted((str(r.doc_id), r.text, r.score) for r in rows if r.text) == [("1", "vile", "a"), ("None", "fine VILE", None)]
    assert {r.doc_id: r._toxicity > 0.4 for r in rows} == {1: True, 2: False, None: True}
