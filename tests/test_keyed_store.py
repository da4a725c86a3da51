import os

import pytest
from pyspark.sql import functions as F

from tidemark.operators import keyed, ordered
from tidemark.sources import keyed_store


def table(spark, ids, value="old"):
    return spark.createDataFrame([(i, f"k{i}", value) for i in ids], "id long, name string, value string")


def contents(df):
    return sorted(map(tuple, df.collect()))


def upsert(batch):
    return lambda rows, _: keyed.upsert(rows, batch, ["name"], ["value"])


def test_a_small_batch_reads_and_writes_its_buckets_only(spark, tmp_path):
    root = str(tmp_path / "t")
    first = keyed_store.create(table(spark, range(200)), root, ["name"], buckets=16, counter="id")
    batch = table(spark, [3, 500], "new")
    hit = {r[0] for r in batch.select(first.bucket()).collect()}
    seen = []
    after = keyed_store.change(
        spark, root, batch, lambda rows, v: seen.append(rows.inputFiles()) or upsert(batch)(rows, v)
    )
    assert {int(f.split("bucket=")[1].split("/")[0]) for f in seen[0]} <= hit and seen[0]
    assert {b for b in after.holders if after.holders[b] != first.holders.get(b)} == hit
    (name,) = {after.holders[b] for b in hit}
    assert {d for d in os.listdir(f"{root}/rows/set={name}") if d.startswith("bucket=")} == {f"bucket={b}" for b in hit}
    assert after.last == 500
    expected = [(i, f"k{i}", "new" if i == 3 else "old") for i in range(200)] + [(500, "k500", "new")]
    assert contents(keyed_store.read(spark, root)) == sorted(expected)
    # A reader that opened the earlier version still sees it whole.
    assert contents(keyed_store.read(spark, root, first)) == contents(table(spark, range(200)))


def test_the_counter_never_falls(spark, tmp_path):
    root = str(tmp_path / "t")
    keyed_store.create(table(spark, [1, 9]), root, ["name"], buckets=4, counter="id")
    gone = table(spark, [9])
    after = keyed_store.change(spark, root, gone, lambda rows, _: rows.join(gone.select("name"), "name", "left_anti"))
    assert after.last == 9 and contents(keyed_store.read(spark, root)) == [(1, "k1", "old")]


def test_a_failed_change_leaves_the_version(spark, tmp_path):
    root = str(tmp_path / "t")
    first = keyed_store.create(table(spark, range(20)), root, ["name"], buckets=4)
    batch = table(spark, [1], "new")
    boom = F.raise_error(F.lit("lost")).cast("string")
    with pytest.raises(Exception, match="lost"):
        keyed_store.change(spark, root, batch, lambda rows, _: rows.withColumn("value", boom))
    with pytest.raises(ValueError, match="outside"):
        keyed_store.change(spark, root, batch, lambda rows, _: table(spark, range(100)))
    assert keyed_store.latest(spark, root) == first


def test_of_two_changes_to_one_version_the_second_fails(spark, tmp_path):
    root = str(tmp_path / "t")
    keyed_store.create(table(spark, range(20)), root, ["name"], buckets=4)
    a, b = table(spark, [1], "a"), table(spark, [1], "b")

    def meanwhile(rows, version):
        keyed_store.change(spark, root, b, upsert(b))
        return upsert(a)(rows, version)

    with pytest.raises(Exception, match="(?i)exist"):
        keyed_store.change(spark, root, a, meanwhile)
    assert (1, "k1", "b") in contents(keyed_store.read(spark, root))


def test_empty_tables_and_batches_and_null_keys(spark, tmp_path):
    root = str(tmp_path / "t")
    first = keyed_store.create(table(spark, []), root, ["name"], buckets=4, counter="id")
    assert first.holders == {} and first.last is None and contents(keyed_store.read(spark, root)) == []
    assert keyed_store.change(spark, root, table(spark, []), upsert(table(spark, []))) == first
    batch = spark.createDataFrame([(1, None, "x")], "id long, name string, value string")
    keyed_store.change(spark, root, batch, upsert(batch))
    assert [tuple(r) for r in keyed_store.read(spark, root).collect()] == [(1, None, "x")]


def test_ranks_of_a_hot_key(spark):
    rows = [("hot" if i % 10 else None, i % 7, i) for i in range(3000)] + [("one", 0, 0)]
    df = spark.createDataFrame(rows, "key string, weight int, id int")
    got = ordered.with_ranks(df, ["key"], [F.desc("weight"), F.asc("id")], "rank").collect()
    assert len(got) == len(rows)
    for key in ("hot", None, "one"):
        mine = sorted((-w, i) for k, w, i in rows if k == key)
        assert [(-r.weight, r.id) for r in sorted((r for r in got if r.key == key), key=lambda r: r["rank"])] == mine
        assert sorted(r["rank"] for r in got if r.key == key) == list(range(1, len(mine) + 1))
