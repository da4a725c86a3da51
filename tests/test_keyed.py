from pyspark.sql import functions as F

from tidemark import fixed, tools
from tidemark.operators import chunking, keyed, ordered

SOURCES = "source_id long, kind string, origin string, title string, metadata string, created_at string, updated_at string"


def sources(spark):
    rows = [(1, "plan", "a", "A", "{}", "d0", "d0"), (2, "plan", "b", "B", "{}", "d0", "d0"),
            (3, "manual_note", "a", "N", "{}", "d0", "d0")]
    return spark.createDataFrame(rows, SOURCES)


def chunks(spark):
    rows = [(1, 0, "one"), (1, 1, "two"), (3, 0, "note")]
    return spark.createDataFrame(rows, "source_id long, chunk_index int, text string")


def rows(df, *columns):
    return sorted(tuple(r) for r in df.select(*columns).collect())


def test_upsert_keeps_id_and_creation(spark):
    batch = spark.createDataFrame(
        [("plan", "a", "first", "m1", "d1", "d1", 1), ("plan", "a", "last", "m2", "d1", "d1", 2),
         ("plan", "z", "new", "m3", "d1", "d1", 1)],
        "kind string, origin string, title string, metadata string, created_at string, updated_at string, at int",
    )
    once = keyed.upsert_sources(sources(spark), batch, ["at"])
    new_id = once.filter("origin = 'z'").first().source_id
    assert new_id > 3
    want = [
        ("manual_note", "a", 3, "N", "d0", "d0"),
        ("plan", "a", 1, "last", "d0", "d1"),
        ("plan", "b", 2, "B", "d0", "d0"),
        ("plan", "z", new_id, "new", "d1", "d1"),
    ]
    columns = ("kind", "origin", "source_id", "title", "created_at", "updated_at")
    assert rows(once, *columns) == want
    assert rows(keyed.upsert_sources(once, batch, ["at"]), *columns) == want


def test_upsert_takes_null_values(spark):
    current = spark.createDataFrame([(1, "x")], "k int, v string")
    batch = spark.createDataFrame([(1, None), (2, None)], "k int, v string")
    assert sorted(map(tuple, keyed.upsert(current, batch, ["k"]).collect())) == [(1, None), (2, None)]


def test_replace_children(spark):
    batch = spark.createDataFrame([(1, 0, "ONE"), (9, 0, "nine")], "source_id long, chunk_index int, text string")
    columns = ("source_id", "chunk_index", "text")
    once = keyed.replace_children(chunks(spark), batch)
    assert rows(once, *columns) == [(1, 0, "ONE"), (3, 0, "note"), (9, 0, "nine")]
    assert rows(keyed.replace_children(once, batch), *columns) == rows(once, *columns)
    parents = spark.createDataFrame([(3,)], "source_id long")
    emptied = keyed.replace_children(chunks(spark), batch.limit(0), parents=parents)
    assert rows(emptied, "source_id") == [(1,), (1,)]


def test_only_notes_are_deleted(spark):
    outcome, left, left_chunks = tools.delete_note(spark, sources(spark), chunks(spark), 3)
    assert tuple(outcome.first()) == (3, True, None)
    assert rows(left, "source_id") == [(1,), (2,)] and rows(left_chunks, "source_id") == [(1,), (1,)]
    outcome, left, left_chunks = tools.delete_note(spark, sources(spark), chunks(spark), 1)
    assert tuple(outcome.first()) == (1, False, "refuse: kind=plan cannot be deleted via MCP")
    assert left.count() == 3 and left_chunks.count() == 3
    assert tools.delete_note(spark, sources(spark), chunks(spark), 77)[0].first().reason == "not_found"


def test_notes(spark):
    secret = "sk-" + "Ab" * 12
    content = f"Remember {secret}\n" + "body " * 20
    args = (spark, sources(spark), chunks(spark))
    receipt, next_sources, next_chunks = tools.add_note(*args, content, ["t"], now=F.lit("d9"))
    row = receipt.first()
    assert (row.title, row.chunk_count, row.redacted_hits) == (f"Remember {fixed.REDACTED}", 1, 1)
    note = next_sources.filter("origin like 'note:%'").first()
    clean = content.replace(secret, fixed.REDACTED)
    assert note.origin == f"note:{row.title}:{len(clean)}" and note.kind == "manual_note"
    assert note.metadata == '{"tags":["t"],"redacted_hits":1}' and note.source_id == row.source_id
    added = next_chunks.filter(F.col("source_id") == row.source_id).first()
    assert added.text == clean.strip() and secret not in added.text
    again = tools.add_note(spark, next_sources, next_chunks, content, ["t"], now=F.lit("d10"))
    assert again[1].count() == 4 and again[2].count() == 4
    blank = tools.add_note(*args, "  \n ")
    assert blank[0].count() == 0 and blank[1].count() == 3 and blank[2].count() == 3


def test_touch_and_runs(spark):
    seen = spark.createDataFrame([(1,), (1,), (9,)], "source_id long")
    touched = keyed.touch(sources(spark), seen, ["source_id"], "updated_at", F.lit("now"))
    assert rows(touched, "source_id", "updated_at") == [(1, "now"), (2, "d0"), (3, "d0")]
    log = spark.createDataFrame(
        [(1, "2024-01-01", None, "running", None), (1, "2024-01-01", "2024-01-01", "ok", 5),
         (2, "2024-01-02", None, "running", None)],
        "run_id int, started_at string, finished_at string, status string, new_count int",
    )
    folded = keyed.fold_runs(log)
    assert rows(folded, "run_id", "status", "new_count") == [(1, "ok", 5), (2, "running", None)]


def test_new_columns_get_defaults(spark):
    old = spark.createDataFrame([(1,)], "id int")
    new = spark.createDataFrame([(2, "x"), (3, None)], "id int, reads string")
    both = keyed.with_new_columns(old, new, {"reads": F.lit("[]")})
    assert rows(both, "id", "reads") == [(1, "[]"), (2, "x"), (3, "[]")]


def test_chunk_ids_keep_the_natural_order(spark):
    df = spark.createDataFrame([(1, 2_097_151), (2, 0), (0, 5)], "s long, i int")
    ids = [r[0] for r in df.select(chunking.chunk_id(F.col("s"), F.col("i"))).collect()]
    assert ids[2] < ids[0] < ids[1]


def test_upsert_chunks_overwrites_vectors(spark):
    schema = "source_id long, chunk_index int, text string, embedding array<float>"
    current = spark.createDataFrame([(1, 0, "a", [1.0]), (1, 1, "b", [2.0])], schema)
    batch = spark.createDataFrame([(1, 0, "c", None)], schema)
    got = keyed.upsert_chunks(current, batch)
    assert sorted((r.chunk_index, r.text, r.embedding) for r in got.collect()) == [(0, "c", None), (1, "b", [2.0])]


def test_numbers_are_dense(spark):
    df = spark.createDataFrame([(i, str(i % 7)) for i in range(500)], "a int, b string")
    for buckets in (1, 16, 4096):
        numbered = ordered.with_numbers(df, ["a", "b"], "n", buckets)
        assert sorted(r.n for r in numbered.collect()) == list(range(1, 501))


def test_answers_of_the_tools(spark):
    args = (spark, sources(spark), chunks(spark))
    saved_note = tools.note_reply(spark, tools.add_note(*args, "Remember this")[0], "Remember this").first().json
    assert saved_note.startswith('{"source_id":') and '"title":"Remember this"' in saved_note
    for content in (" \n", "", None):
        receipt = tools.add_note(*args, content or "")[0]
        assert [r.json for r in tools.note_reply(spark, receipt, content).collect()] == ['{"error":"empty_content"}']
    replies = lambda i: keyed.delete_replies(tools.delete_note(*args, i)[0]).first().reply
    assert replies(3) == '{"deleted":true,"source_id":3}'
    assert replies(77) == '{"deleted":false,"reason":"not_found"}'
    gone = tools.get_document_head(*args, 77).first()
    assert (gone.source_id, gone.error) == (77, "not_found")
    there = tools.get_document_head(*args, 3).first()
    assert there.error is None and there.chunk_count == chunks(spark).filter("source_id = 3").count()
    rows = spark.createDataFrame([(2, "b"), (1, 'a"')], "id int, name string")
    assert tools.as_json_list(rows, [F.asc("id")]).first().json == '[{"id":1,"name":"a\\""},{"id":2,"name":"b"}]'
    assert tools.as_json_list(rows.limit(0), [F.asc("id")]).first().json == "[]"
