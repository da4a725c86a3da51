"""The registered queries of the operators, and the pipeline, on the smallest tables."""

import os

import brute
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
import corpus_pipeline
from tidemark.llm import oracles, queries

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


def test_every_operator_is_registered():
    numbers = sorted(int(name[2:].split("_")[0]) for name in queries.QUERIES)
    assert numbers == list(range(1, 14))
    assert set(queries.QUERIES) | {"pipeline"} <= set(entry.queries())
    assert set(oracles.ORACLES) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", ["op4_pieces", "op6_histogram_sort", "op10_simhash"])
def test_one_row_for_each_document(spark, name):
    got = queries.QUERIES[name](spark, SF).select("doc_id").collect()
    want = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id").collect()
    assert sorted(r.doc_id for r in got) == sorted(r.doc_id for r in want)


def test_stages(spark, tmp_path):
    passage = "A shop sells 12 red and 30 blue pens and Maria buys 7 of them for 3 dollars on a rainy day in May."
    text = lambda k: ". ".join(" ".join(f"word{(k * 7919 + j * 31 + s * 17) % 5000}" for j in range(12)) for s in range(8))
    shout = " ".join(f"junk{k}###" for k in range(60))
    rows = [(k, f"{text(k)}\nShared footer of the site", "en", "a") for k in range(40)]
    rows += [(100, text(3) + " tail", "en", "a"), (101, text(200) + f"\n{passage}", "en", "a"), (102, shout, "en", "a"), (103, "too short", "en", "a")]
    rows += [(104, None, "en", "a"), (105, "", None, None), (3, rows[3][1], "en", "a"), (None, text(300), "en", "a")]
    schema = f"{brute.SCHEMA}, n_chars long"
    docs = spark.createDataFrame([(*r, len(r[1] or "")) for r in rows], schema)
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(1, passage.replace("12", "15").replace("Maria", "Paula"))], "item_id long, text string").write.parquet(
        str(tmp_path / "benchmark.parquet")
    )
    found = docs
    for number, (name, stage) in enumerate(corpus_pipeline.STAGES):
        path = str(tmp_path / f"stage-{number}")
        stage(spark, found, str(tmp_path)).write.parquet(path)
        found = spark.read.parquet(path)
        if number < 4:
            assert found.columns == docs.columns
    got = {r.doc_id: r for r in found.collect()}
    # Junk, short and empty texts, copies and leaks are gone; every clean document stays.
    assert set(got) == {*range(40), None}
    assert found.count() == 41
    assert all("footer" not in r.text and r.restored and r.n_chars == len(r.text) for r in got.values())
    assert got[3].text == text(3) and len(got[3].ids) == got[3].n_pieces
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs.filter("false"), str(tmp_path)).count() == 0


def test_run(spark):
    assert len(corpus_pipeline.STAGES) == 5
    out = corpus_pipeline.run(spark, SF)
    total = spark.read.parquet(f"{SF}/documents.parquet").count()
    assert 0 < out.count() < total
    assert out.filter(~F.col("restored")).count() == 0
