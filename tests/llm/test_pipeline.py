"""The pipeline's stages: what goes, what stays, columns kept."""

import corpus_pipeline as P
from pyspark.sql import functions as F

from tests.conftest import SF_SMALL


def test_stages(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    first = {r.doc_id for r in docs.select("doc_id").collect()}
    for name, stage in P.STAGES:
        out = P.written(stage(spark, docs, SF_SMALL), "test-stage")
        if name != "sharding":
            assert out.columns == docs.columns
        if name == "mixing":
            assert {r.doc_id for r in out.select("doc_id").collect()} == {r.doc_id for r in docs.select("doc_id").collect()}
        docs = out
    sizes = [r["count"] for r in docs.groupBy("shard").count().collect()]
    assert max(sizes) - min(sizes) <= 1
    assert {r.doc_id for r in docs.select("doc_id").collect()} <= first


def test_near_copies_keep_the_smallest(spark):
    text = "one two three four five six seven eight nine ten eleven twelve thirteen fourteen"
    docs = spark.createDataFrame([(5, text, "a"), (3, text + " ", "b"), (4, None, "c"), (9, "", "d"), (3, "other text here", "e")],
                                 "doc_id long, text string, lang string")
    got = sorted((r.doc_id, r.lang) for r in P.drop_near_copies(spark, docs, SF_SMALL).collect())
    assert got == [(3, "b"), (3, "e"), (4, "c"), (9, "d")]


def test_contaminated_rows_go(spark):
    item = spark.read.parquet(f"{SF_SMALL}/benchmark.parquet").orderBy(F.desc(F.length("text"))).first().text
    docs = spark.createDataFrame([(1, "clean words " * 9, "a"), (1, "x. " + item + " y", "b"), (None, "clean", "c")],
                                 "doc_id long, text string, lang string")
    assert sorted(r.lang for r in P.drop_contaminated(spark, docs, SF_SMALL).collect()) == ["a", "c"]


CLASHES = ["_text", "_toxicity", "_row_key", "_copies", "_copy", "Tokens", "rate", "component_id"]


def test_stages_with_nulls_repeats_empty_tables_and_clashing_columns(spark, docs):
    wide = docs
    for c in CLASHES:
        wide = wide.withColumn(c, F.lit(c))
    keep = [r for r in wide.collect()]
    for name, stage in P.STAGES[:-1]:
        out = stage(spark, wide, SF_SMALL)
        assert out.columns == wide.columns, name
        rows = out.collect()
        assert rows and all(r["_text"] == "_text" and r["_row_key"] == "_row_key" and r["_copies"] == "_copies" for r in rows)
        assert {tuple(r) for r in rows} <= {tuple(r) for r in keep}
        if name != "jaccard_join":                                   # clean rows stay, as often as they were
            assert len(rows) >= len(keep)
        assert stage(spark, wide.limit(0), SF_SMALL).count() == 0
    assert P.shard(spark, wide, SF_SMALL).count() == len(keep)
    assert P.shard(spark, wide.limit(0), SF_SMALL).count() == 0
