"""Both joins of the template index give the same rows; cases of the document table."""

import pytest
from pyspark.sql import functions as F

from civicspark.llm import decontaminate
from tests.conftest import SF_SMALL


@pytest.fixture
def documents(spark):
    """The small tables' documents, with items planted whole, with other slots, and near others."""
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text")
    items = [r.text for r in spark.read.parquet(f"{SF_SMALL}/benchmark.parquet").orderBy("item_id").limit(12).collect()]
    planted = [(90_000 + i, "He asked, " + t + " and so on. " * 30) for i, t in enumerate(items)]
    planted += [(91_000 + i, "x " * 4_000 + t) for i, t in enumerate(items[:4])]
    planted += [(None, items[0]), (92_000, None), (92_001, ""), (92_002, " . . "), (90_000, planted[0][1])]
    return docs.unionByName(spark.createDataFrame(planted, "doc_id long, text string")).withColumn("hash", F.lit("x")), items


def test_shuffled_index_equals_the_broadcast_one(spark, documents, monkeypatch):
    docs, items = documents
    benchmark = spark.read.parquet(f"{SF_SMALL}/benchmark.parquet").withColumn("w", F.lit(1))
    short = spark.createDataFrame([(70_001, "Is 7 km far?", 1), (70_002, "3 apples, 4 pears, 5 plums, 6 figs, 7 nuts, 8 eggs", 1),
                                   (70_003, None, 1), (70_004, "", 1)], "item_id long, text string, w int")
    benchmark = benchmark.unionByName(short)
    one = decontaminate.contaminated(docs, benchmark)
    rows = sorted(map(tuple, one.collect()), key=str)
    with monkeypatch.context() as m:
        m.setattr(decontaminate, "INDEX_BYTES", 0)
        two = decontaminate.contaminated(docs, benchmark)
        assert "ResolvedHint" not in two._jdf.queryExecution().analyzed().toString()
        assert sorted(map(tuple, two.collect()), key=str) == rows
    found = {r[0] for r in rows}
    assert {90_000 + i for i in range(len(items))} <= found and {91_000 + i for i in range(4)} <= found and None in found
    assert not found & {92_000, 92_001, 92_002}


def test_empty_tables(spark, documents):
    docs, _ = documents
    benchmark = spark.read.parquet(f"{SF_SMALL}/benchmark.parquet")
    assert decontaminate.contaminated(docs.limit(0), benchmark).count() == 0
    assert decontaminate.contaminated(docs, benchmark.limit(0)).count() == 0
