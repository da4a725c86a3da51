"""Every registered query against its SQL on the smallest tables."""

import os

import compare
import numpy as np
import pytest

import __spark_entry__ as entry

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def duck():
    return compare.connect(SF)


# Approximate; its recall is tested below and, on clustered vectors, in test_retrieval.py.
NO_SQL = {"vector_ivf_probe"}


def test_every_query_of_the_plans_has_sql():
    for plan in (entry.knowledge, entry.events, entry.listings, entry.brief):
        assert set(plan.QUERIES) - NO_SQL <= set(entry.oracle_sql())
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry(spark):
    assert entry.entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_matches_sql(spark, duck, name):
    sql = entry.oracle_sql()[name]
    df = entry.queries()[name](spark, SF)
    assert compare.spark_types(df) == compare.duck_types(duck, sql)
    columns, rows = compare.spark_rows(df)
    assert (columns, rows) == compare.duck_rows(duck, sql)


def test_probed_lists_find_most(spark):
    vectors = spark.read.parquet(f"{SF}/embeddings.parquet").collect()
    unit = {r.vec_id: np.array(r.embedding, float) / np.linalg.norm(r.embedding) for r in vectors}
    got = entry.queries()["vector_ivf_probe"](spark, SF).collect()
    asked = [i for i in unit if i % 100 == 0]
    found = 0
    for q in asked:
        exact = sorted(unit, key=lambda i: (-round(float(unit[i] @ unit[q]), 12), i))[:10]
        mine = {r.chunk_id: r.score for r in got if r.query_id == q}
        assert len(mine) == 10 and all(abs(s - unit[i] @ unit[q]) < 1e-5 for i, s in mine.items())
        found += len(set(exact) & set(mine))
    assert found >= 0.9 * 10 * len(asked)
