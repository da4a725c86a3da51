"""Faults that once hid behind equal SQL: each with data that shows the difference."""

import json
import shutil
import uuid

import pytest
from pyspark.sql import functions as F

from tidemark.operators import brief as br
from tidemark.operators import chunking
from tidemark.operators import listings as ls
from tidemark.plans import inputs
from tidemark.sources import files, workdir
from tidemark.streaming import backfill as stream_vectors
from tidemark.streaming import changes

KEY = "AKIA" + "A1B2C3D4E5F6G7H8"


def detail(**amounts):
    item = {
        "itemId": 1, "salesType": "월세", "roomType": "투룸", "status": "open", "bjdCode": "1129010100",
        "price": {"deposit": 1000, "rent": 90}, "manageCost": {"amount": 5},
    }
    for name, value in amounts.items():
        (item["manageCost"] if name == "amount" else item["price"])[name] = value
    return json.dumps({"item": item})


@pytest.mark.parametrize(
    ("amounts", "accepted", "stored"),
    [
        ({}, True, (1000, 90, 5)),
        ({"deposit": 5_000_000_000}, False, None),
        ({"deposit": 3000.5}, False, None),
        ({"deposit": 2999.5}, True, (3000, 90, 5)),
        ({"rent": 120.25, "amount": 0}, False, None),
        ({"amount": 29.5, "rent": 90.25}, True, (1000, 90, 30)),
    ],
)
def test_amounts_are_compared_as_sent(spark, amounts, accepted, stored):
    parsed = ls.parse_details(spark.createDataFrame([(detail(**amounts),)], "detail string"))
    rows = ls.flatten(parsed.filter(ls.wanted(F.col("item"))), "s", "v/%s", "o/%s").collect()
    assert bool(rows) == accepted
    if rows:
        assert (rows[0].deposit, rows[0].rent, rows[0].manage_cost) == stored


def test_geohash_prefix_reaches_the_scan(spark, tmp_path):
    path = str(tmp_path / "listed")
    spark.createDataFrame([("wydm9zz", "월세", 1, 1, 7)], "geohash string, sales_type string, deposit int, rent int, item_id long").write.parquet(path)
    scan = ls.scan(spark.read.parquet(path))
    assert [r.item_id for r in scan.collect()] == [7]
    plan = scan._jdf.queryExecution().executedPlan().toString()
    assert "StringStarts" in plan.split("PushedFilters")[1]


def test_titles_hold_no_secret(spark, tmp_path):
    rows = [("s", 0, 0, "t0", None, "user", f"use {KEY} for it"), ("s", 0, 1, "t1", None, "assistant", "yes")]
    messages = spark.createDataFrame(rows, "session string, bucket int, seq int, turn_id string, ts string, role string, text string")
    title = chunking.session_titles(chunking.redact_turns(chunking.pair_turns(messages))).first().title
    assert title == "use [REDACTED] for it"
    docs = spark.createDataFrame([(1, f"# {KEY} in the title\n" + "and more text after it " * 5, "en", "src")], "doc_id long, text string, lang string, source string")
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    assert KEY not in inputs.documents(spark, str(tmp_path)).first().title
    assert all(KEY not in r.text for r in inputs.chunks(spark, str(tmp_path)).collect())


def test_failed_vectors_are_tried_again(spark, tmp_path):
    chunks = spark.createDataFrame([(1, "one", None), (2, "two", None), (3, "three", [1.0])], "chunk_id long, text string, embedding array<float>")
    chunks.write.parquet(str(tmp_path / "chunks"))
    read = lambda: spark.readStream.schema(chunks.schema).parquet(str(tmp_path / "chunks"))
    out = str(tmp_path / "vectors")

    def broken(texts, mode):
        return None if "two" in texts else [[float(len(t))] for t in texts]

    def works(texts, mode):
        return [[float(len(t))] for t in texts]

    one_by_one = lambda embedder: lambda texts, mode: [v for t in texts for v in embedder([t], mode)] if embedder is works else embedder(texts, mode)
    stream_vectors.append_vectors(read(), one_by_one(broken), out, str(tmp_path / "state")).awaitTermination()
    left = {r.chunk_id for r in stream_vectors.waiting(spark, out).collect()}
    assert 2 in left
    # Nothing new has landed; the waiting chunks get their vectors all the same.
    stream_vectors.append_vectors(read(), works, out, str(tmp_path / "state")).awaitTermination()
    assert stream_vectors.waiting(spark, out).count() == 0
    assert {r.chunk_id: r.embedding for r in stream_vectors.read_vectors(spark, out).collect()} == {1: [3.0], 2: [3.0]}


def test_upsert_of_a_day_keeps_the_month(spark, tmp_path):
    path = str(tmp_path / "days")
    days = lambda *rows: spark.createDataFrame(rows, "d string, n int").select(F.col("d").cast("date").alias("run_date"), "n")
    br.upsert_days(days(("2024-05-01", 1), ("2024-05-02", 2), ("2024-06-01", 3)), path)
    br.upsert_days(days(("2024-05-02", 20), ("2024-05-03", 30)), path)
    got = {str(r.run_date): r.n for r in spark.read.parquet(path).collect()}
    assert got == {"2024-05-01": 1, "2024-05-02": 20, "2024-05-03": 30, "2024-06-01": 3}


def test_only_faults_of_the_data_are_isolated(spark, monkeypatch):
    fine = lambda: spark.range(1).withColumn("run_date", F.current_date())
    bad = lambda: spark.range(1).select(F.raise_error(F.lit("odd row")).alias("x"))
    sections, errors = br.isolate({"a": fine, "b": bad, "c": lambda: {}["gone"]})
    assert set(sections) == {"a"} and len(errors) == 2
    monkeypatch.setattr(br, "shared_dir", lambda spark: (_ for _ in ()).throw(RuntimeError("no folder")))
    with pytest.raises(RuntimeError, match="no folder"):
        br.isolate({"a": fine})


def test_files_that_are_gone_count_as_failed(spark, tmp_path):
    (tmp_path / "a.txt").write_text("some text")
    listing = files.discover(spark, [str(tmp_path / "a.txt")])
    listing = listing.unionByName(listing.withColumn("path", F.concat("path", F.lit(".gone"))))
    read = files.read_documents(spark, listing, [str(tmp_path)])
    counted = files.file_sources(read, "doc").select(F.col("origin").alias("path"), F.lit(1).alias("chunks"), "hits")
    total = files.ingest_totals(files.file_results(read, counted)).first()
    assert (total.files, total.chunks, total.failed) == (2, 1, 1)


def test_only_plain_local_masters_get_a_folder_of_their_own():
    class Fake:
        class sparkContext:
            master = "local-cluster[2,1,1024]"

        class conf:
            get = staticmethod(lambda key, default=None: default)

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        workdir.shared_dir(Fake)


def test_vectors_outlive_checkpoints_replays_and_failures(spark, tmp_path):
    path, out = str(tmp_path / "chunks"), str(tmp_path / "vectors")
    schema = "chunk_id bigint, text string, embedding array<float>"
    land = lambda *ids: spark.createDataFrame([(i, f"t{i}", None) for i in ids], schema).coalesce(1).write.mode("append").parquet(path)
    read = lambda: spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(path)
    asked = tmp_path / "asked"
    asked.mkdir()

    def embed(texts, mode, bad=()):
        if any(t in bad for t in texts):
            return None
        for t in texts:
            (asked / f"{t}-{uuid.uuid4().hex}").touch()
        return [[float(t[1:])] for t in texts]

    def run(state, bad=(), **more):
        one = lambda texts, mode: [v for t in texts for v in (embed([t], mode, bad) or [None])]
        stream_vectors.append_vectors(read(), one, out, str(tmp_path / state), **more).awaitTermination()

    def made():
        return {r.chunk_id: r.embedding[0] for r in stream_vectors.read_vectors(spark, out).collect()}

    assert made() == {} and stream_vectors.waiting(spark, out).count() == 0
    for i in (1, 2, 3):
        land(i)
    run("one", bad=("t3",))
    assert made() == {1: 1.0, 2: 2.0} and [r.chunk_id for r in stream_vectors.waiting(spark, out).collect()] == [3]
    # A new checkpoint goes through all files again: nothing is lost, nothing embedded twice.
    land(4)
    run("two")
    assert made() == {1: 1.0, 2: 2.0, 3: 3.0, 4: 4.0}
    assert sorted(p.name.split("-")[0] for p in asked.iterdir()) == ["t1", "t2", "t3", "t4"]
    # The last micro-batch again, as after a crash before it was committed.
    commits = sorted((tmp_path / "two" / "commits").glob("[0-9]*"), key=lambda p: int(p.name))
    commits[-1].unlink()
    (commits[-1].parent / f".{commits[-1].name}.crc").unlink(missing_ok=True)
    run("two")
    assert made() == {1: 1.0, 2: 2.0, 3: 3.0, 4: 4.0}
    # A checkpoint that is deleted and made again at the same place is a run of its own.
    shutil.rmtree(tmp_path / "one")
    land(5)
    run("one", fold_after=2)
    assert made() == {i: float(i) for i in range(1, 6)}
    stream_vectors.compact_vectors(spark, out)
    land(6)
    run("one")
    assert made() == {i: float(i) for i in range(1, 7)}
    newest = changes.current(spark, f"{out}/tried", stream_vectors._TRIED)
    assert newest.select("version").distinct().count() <= 2
