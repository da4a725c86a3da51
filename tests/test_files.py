import os
import time
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from tidemark.sources import files, snapshots, workdir


def make(path, text, day=None):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_bytes(text)
    if day:
        at = time.mktime(time.strptime(day, "%Y-%m-%d %H:%M:%S")) - time.timezone
        os.utime(path, (at, at))


def names(df):
    return [os.path.basename(r.path) for r in df.collect()]


def test_discover(spark, tmp_path):
    make(tmp_path / "b.md", b"B")
    make(tmp_path / "sub" / "a.md", b"A")
    make(tmp_path / "sub" / "c.txt", b"C")
    paths = [str(tmp_path / "b.md"), str(tmp_path / "gone.md")]
    globs = [str(tmp_path / "*" / "*.md"), str(tmp_path / "*.md"), str(tmp_path / "none*")]
    found = files.discover(spark, paths, globs)
    assert sorted(names(found)) == ["a.md", "b.md"]
    assert names(files.discover(spark, paths, globs, limit=1)) == ["b.md"]
    assert files.discover(spark, [str(tmp_path / "gone.md")]).count() == 0
    plan = found._jdf.queryExecution().toString()
    assert "content" not in plan.split("Physical Plan")[1]


def test_modified_since_is_midnight_utc(spark, tmp_path):
    make(tmp_path / "old.jsonl", b"{}", "2024-03-13 23:59:59")
    make(tmp_path / "new.jsonl", b"{}", "2024-03-14 00:00:00")
    for zone in ("UTC", "Asia/Seoul"):
        spark.conf.set("spark.sql.session.timeZone", zone)
        try:
            kept = files.discover(spark, globs=[str(tmp_path / "*")], since="2024-03-14")
            assert names(kept) == ["new.jsonl"]
        finally:
            spark.conf.unset("spark.sql.session.timeZone")
    lines = files.read_session_lines(spark, str(tmp_path), since="2024-03-14")
    assert lines.count() == 1


def test_documents_with_bad_bytes_and_missing_files(spark, tmp_path):
    make(tmp_path / "ok.md", "# Title\nbody é".encode())
    make(tmp_path / "bad.md", b"caf\xe9 \xff end")
    listing = files.discover(spark, globs=[str(tmp_path / "*.md")])
    ghost = listing.limit(1).withColumn("path", F.lit("file:/gone.md"))
    docs = files.read_documents(spark, listing.unionByName(ghost), [str(tmp_path)])
    got = {os.path.basename(r.path): (r.text, r.error) for r in docs.collect()}
    assert got["ok.md"] == ("# Title\nbody é", None)
    assert got["bad.md"] == (b"caf\xe9 \xff end".decode(errors="replace"), None)
    assert got["gone.md"] == (None, "unreadable")
    sources = {r.title for r in files.file_sources(docs, "plan").collect()}
    assert "Title" in sources and len(sources) == 2


def test_bad_huge_and_missing_files_do_not_touch_the_others(spark, tmp_path):
    folder = tmp_path / "a b+c%20d"
    make(folder / "ok.md", b"fine")
    spark.range(1).selectExpr("'some text that is long enough for a checksum' AS value").coalesce(1).write.text(str(folder / "sub"))
    bad = next((folder / "sub").glob("part-*.txt"))
    bad.write_bytes(b"x" * bad.stat().st_size)  # no longer what its checksum says
    lines = [f"line {k} é" for k in range(400)]
    make(folder / "huge.md", "\n".join(lines).encode() + b"\n\xff")
    listing = files.discover(spark, globs=[str(folder)])
    listing = listing.unionByName(listing.filter("path like '%ok.md'").withColumn("path", F.concat("path", F.lit(".gone"))))
    spark.conf.set("spark.sql.files.maxPartitionBytes", 1500)
    try:
        read = workdir.saved(files.read_documents(spark, listing, [str(folder)], max_bytes=1000, part_bytes=700), "read")
        got = {}
        for r in read.orderBy("path", "part").collect():
            got.setdefault(os.path.basename(r.path), []).append((r.part, r.text, r.error))
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert got["ok.md"] == [(0, "fine", None)]
    assert got["ok.md.gone"] == [(0, None, "unreadable")] and got[bad.name] == [(0, None, "unreadable")]
    huge = got["huge.md"]
    assert len(huge) > 4 and [p for p, _, _ in huge] == list(range(len(huge))) and all(len(t) < 1500 for _, t, _ in huge)
    assert "\n".join(t for _, t, _ in huge) == "\n".join([*lines, "\ufffd"])
    sources = files.file_sources(read, "doc").select("origin", "path", "hits").collect()
    assert len({r.origin for r in sources}) == len(sources) == len(huge) + 1
    counted = files.file_sources(read, "doc").select("path", F.lit(1).alias("chunks"), "hits")
    total = files.ingest_totals(files.file_results(read, counted, counted.filter("path like '%huge.md'").select("path"))).first()
    assert (total.files, total.chunks, total.embedded_files, total.failed) == (4, len(huge) + 1, 1, 2)


def test_ingest_totals(spark):
    rows = [("a", 3, 1, True, None), ("b", 2, 0, False, None), ("c", 9, 9, False, "unreadable")]
    df = spark.createDataFrame(rows, "path string, chunks int, hits int, embedded boolean, error string")
    assert tuple(files.ingest_totals(df).first()) == (3, 5, 1, 1, 1)
    assert [tuple(r) for r in files.first_failures(df).collect()] == [("c", "unreadable")]


def test_scans_skip_missing_results(spark, tmp_path):
    spark.range(3).write.parquet(str(tmp_path / "a"))
    scans = files.read_scans(spark, [str(tmp_path / "a"), str(tmp_path / "gone")], "id bigint")
    assert [s.count() for s in scans] == [3]


def test_snapshots(spark, tmp_path):
    path = str(tmp_path / "snap")
    for day, n in (("2024-01-01", 1), ("2024-01-02", 2), ("2024-01-09", 3), ("2024-01-02", 5)):
        snapshots.write_snapshot(spark.range(n), path, day)
    stored = spark.read.parquet(path)
    as_of = F.lit("2024-01-09").cast("date")
    kept = snapshots.retained(stored, as_of)
    counts = {str(r.snapshot_date): r["count"] for r in kept.groupBy("snapshot_date").count().collect()}
    assert counts == {"2024-01-02": 5, "2024-01-09": 3}
    assert [str(r[0]) for r in snapshots.expired_dates(stored, as_of).collect()] == ["2024-01-01"]


def test_work_folder_follows_the_setting(spark):
    named = spark.conf.get("spark.checkpoint.dir")
    assert workdir.new_dir(spark, "x").startswith(f"{named}/x-")
    assert workdir.new_dir(spark, "x") != workdir.new_dir(spark, "x")


@pytest.mark.parametrize("master, allowed", [("local[4]", True), ("yarn", False)])
def test_work_folder_without_the_setting(master, allowed):
    held = {}
    session = SimpleNamespace(
        conf=SimpleNamespace(get=held.get, set=held.__setitem__), sparkContext=SimpleNamespace(master=master)
    )
    if allowed:
        folder = workdir.shared_dir(session)
        assert os.path.isdir(folder) and workdir.shared_dir(session) == folder
    else:
        with pytest.raises(RuntimeError):
            workdir.shared_dir(session)
