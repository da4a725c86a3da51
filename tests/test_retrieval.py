import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark import tools
from tidemark.operators import backfill, batches, corpus, fusion, ivf, lexical, vector
from tidemark.plans import inputs

DIM = 8


@pytest.fixture(scope="module")
def vectors():
    rng = np.random.default_rng(1)
    rows = rng.normal(size=(300, DIM)).astype(np.float32)
    rows[10] = rows[5]
    rows[11] = rows[5] * 3
    rows[20] = 0
    return rows


@pytest.fixture(scope="module")
def chunks(spark, vectors):
    rows = [
        (i, i % 7, i // 7, f"word{i % 5} common text {i}", None if i % 9 == 8 else [float(x) for x in v])
        for i, v in enumerate(vectors)
    ]
    schema = "chunk_id long, source_id long, chunk_index int, text string, embedding array<float>"
    return spark.createDataFrame(rows, schema).repartition(5).cache()


@pytest.fixture(scope="module")
def sources(spark):
    rows = [(i, "manual_note" if i % 2 else "plan", f"o{i}", f"t{i}", f"2024-01-0{i + 1}") for i in range(8)]
    return spark.createDataFrame(rows, "source_id long, kind string, origin string, title string, created_at string")


def plain_topk(vectors, query, k, keep=lambda i: True):
    query = np.asarray(query, dtype=np.float64)
    scored = []
    for i, v in enumerate(vectors.astype(np.float64)):
        if i % 9 == 8 or not np.linalg.norm(v) or not keep(i):
            continue
        scored.append((-round(float(v @ query / np.linalg.norm(v) / np.linalg.norm(query)), 12), i))
    return [i for _, i in sorted(scored)[:k]]


def ids(df):
    return [r.chunk_id for r in df.collect()]


def test_vector_topk(chunks, sources, vectors):
    for query in (vectors[5], vectors[17]):
        query = [float(x) for x in query]
        assert ids(vector.vector_topk(chunks, query, 12)) == plain_topk(vectors, query, 12)
        only = vector.vector_topk(chunks, query, 12, sources, "plan")
        assert ids(only) == plain_topk(vectors, query, 12, lambda i: (i % 7) % 2 == 0)
        stored = vector.with_norm(chunks)
        assert ids(vector.vector_topk(stored, query, 3)) == plain_topk(vectors, query, 3)


@pytest.mark.parametrize("block_rows", [4096, 3])
def test_batch_search_equals_single_searches(spark, chunks, vectors, block_rows):
    rows = [(q, [float(x) for x in vectors[q]]) for q in (5, 17, 20, 40, 41, 60, 77)]
    rows.append((99, None))
    queries = spark.createDataFrame(rows, "query_id long, embedding array<float>")
    got = vector.vector_topk_batch(chunks, queries, 6, block_rows=block_rows).collect()
    for q, v in rows:
        mine = [r.chunk_id for r in sorted(got, key=lambda r: r["rank"]) if r.query_id == q]
        usable = v is not None and any(v)
        assert mine == (plain_topk(vectors, v, 6) if usable else [])


def test_batch_search_in_small_slices(spark, chunks, vectors, monkeypatch):
    monkeypatch.setattr(vector, "SCORES_IN_MEMORY", 10)
    monkeypatch.setattr(batches, "ROW_BLOCK_ROWS", 3)
    queries = spark.createDataFrame(
        [(q, [float(x) for x in vectors[q]]) for q in (1, 5)], "query_id long, embedding array<float>"
    )
    got = vector.vector_topk_batch(chunks, queries, 4).orderBy("query_id", "rank")
    assert ids(got) == plain_topk(vectors, vectors[1], 4) + plain_topk(vectors, vectors[5], 4)


@pytest.mark.parametrize("block_rows", [4096, 2])
def test_batch_of_word_queries_equals_single_ones(spark, chunks, monkeypatch, block_rows):
    monkeypatch.setattr(lexical, "POSTING_BLOCK_ROWS", 100 if block_rows == 2 else 1 << 20)
    texts = {1: "word3 text", 2: "common common text 17", 3: "absent", 4: "? a", 5: "word0 word1 word2 99"}
    queries = spark.createDataFrame(list(texts.items()), "query_id long, query string")
    got = lexical.lexical_topk_batch(lexical.postings(chunks), queries, 7, block_rows=block_rows).collect()
    for q, text in texts.items():
        mine = sorted((r["rank"], r.chunk_id, r.score) for r in got if r.query_id == q)
        terms = lexical.query_terms(spark, text)
        alone = lexical.lexical_topk(lexical.scan(chunks, terms), terms, 7, keep=["chunk_id"])
        assert mine == [(n, r.chunk_id, r.score) for n, r in enumerate(alone.collect())]


def test_lists_are_exact_when_all_are_probed(spark, chunks, vectors, tmp_path):
    lists = ivf.build_lists(chunks, n_lists=6)
    query = [float(x) for x in vectors[17]]
    assert ids(ivf.ivf_topk(lists, query, 10, n_probe=6)) == plain_topk(vectors, query, 10)
    path = str(tmp_path / "lists")
    ivf.write_lists(lists, path)
    stored = ivf.open_lists(spark, path)
    assert (stored.centroids == lists.centroids).all()
    near = ivf.ivf_topk(stored, query, 10, n_probe=1)
    probed = ivf.nearest_lists(lists.centroids, query, 1)
    members = {r.chunk_id for r in stored.chunks.filter(F.col("list_id").isin(probed)).collect()}
    assert ids(near) == plain_topk(vectors, query, 10, lambda i: i in members)
    plan = near._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^\]]*list_id", plan)


def clustered(n, seed=3, dim=8, centers=12):
    rng = np.random.default_rng(seed)
    middle = rng.normal(size=(centers, dim))
    return np.array([middle[i % centers] + 0.25 * rng.normal(size=dim) for i in range(n)], np.float32)


def test_few_lists_find_most(spark, tmp_path):
    vectors = clustered(600)
    rows = [(i, i, None if i % 9 == 8 else [float(x) for x in v]) for i, v in enumerate(vectors)]
    frame = spark.createDataFrame([*rows, (900, 900, None), (901, 901, [0.0] * 8)], "chunk_id long, source_id long, embedding array<float>")
    path = str(tmp_path / "lists")
    ivf.write_lists(ivf.build_lists(frame.filter("chunk_id < 300"), n_lists=12), path)
    trained = {r.chunk_id: r.list_id for r in ivf.open_lists(spark, path).chunks.collect()}
    ivf.add_to_lists(frame.filter("chunk_id >= 300"), path)
    lists = ivf.open_lists(spark, path)
    every = {r.chunk_id: r.list_id for r in lists.chunks.collect()}
    assert set(every) == {i for i in range(600) if i % 9 != 8} and {i: every[i] for i in trained} == trained
    # New chunks go where training would have put them.
    again = {r.chunk_id: r.list_id for r in ivf.assigned(frame, lists.centroids).collect()}
    assert again == every
    queries = frame.filter("chunk_id % 50 = 0").withColumnRenamed("chunk_id", "query_id").select("query_id", "embedding")
    asked = [i for i in range(0, 600, 50) if i % 9 != 8]
    n_probe = ivf.probes_for(lists, queries, 10, 0.9)
    assert 1 <= n_probe <= 4
    got = ivf.ivf_topk_batch(lists, queries, 10, n_probe).collect()
    found = sum(r.chunk_id in plain_topk(vectors, vectors[r.query_id], 10) for r in got)
    share = {r.n_probe: r.recall for r in ivf.recall(lists, queries, 10).collect()}
    assert found / (10 * len(asked)) == share[n_probe] >= 0.9 and share[max(share)] == 1.0
    assert sorted(share.values()) == [share[n] for n in sorted(share)]
    # All lists probed is the exact search.
    full = ivf.ivf_topk_batch(lists, queries, 10, 12).collect()
    for q in asked:
        mine = [r.chunk_id for r in sorted(full, key=lambda r: r["rank"]) if r.query_id == q]
        assert mine == plain_topk(vectors, vectors[q], 10)


def test_batch_search_reads_once_and_collects_nothing(spark, chunks, tmp_path, monkeypatch):
    lexical.postings(chunks).write.parquet(str(tmp_path / "p"))
    index = spark.read.parquet(str(tmp_path / "p"))
    queries = spark.createDataFrame([(1, "word3 text")], "query_id long, query string")
    monkeypatch.setattr(type(index), "collect", lambda self: pytest.fail("collected"))
    plan = lexical.lexical_topk_batch(index, queries, 5)._jdf.queryExecution().optimizedPlan().toString()
    assert "FlatMapCoGroupsInArrow" in plan and "Cartesian" not in plan


def hits(spark, scores):
    return spark.createDataFrame(scores, "chunk_id long, score double, rank int")


def test_fusion_counts_ranks_from_zero(spark):
    first = hits(spark, [(1, 0.9, 0), (2, 0.8, 1), (3, 0.7, 2)])
    second = hits(spark, [(4, 5.0, 0), (2, 4.0, 1), (1, 3.0, 2)])
    rows = {r.chunk_id: r for r in fusion.rrf([first, second]).collect()}
    assert rows[1].fusion_score == 1 / 60 + 1 / 62
    assert rows[2].fusion_score == 1 / 61 + 1 / 61
    assert rows[4].fusion_score == 1 / 60
    assert rows[2].score == 0.8 and rows[4].score == 5.0
    order = [r.chunk_id for r in fusion.rrf([first, second]).orderBy(*fusion._fused_order()).collect()]
    assert order == [1, 2, 4, 3]
    tied = fusion.rrf([hits(spark, [(9, 1.0, 0)]), hits(spark, [(1, 1.0, 0)])])
    assert [r.chunk_id for r in tied.orderBy(*fusion._fused_order()).collect()] == [9, 1]


def test_search(spark, chunks, sources, vectors):
    query = [float(x) for x in vectors[17]]
    both = tools.search(spark, chunks, sources, "word2 missing", query, limit=5)
    index = lexical.postings(chunks, ["chunk_id", "source_id"])
    stored = tools.search(spark, chunks, sources, "word2 missing", query, limit=5, index=index)
    assert both.collect() == stored.collect() and both.count() == 5
    words_only = tools.search(spark, chunks, sources, "word2", None, limit=500)
    assert words_only.count() == 50
    assert all("word2" in r.text for r in words_only.collect())
    none = tools.search(spark, chunks, sources, "? a", None)
    assert none.count() == 0
    notes = tools.search(spark, chunks, sources, "common", query, kind="manual_note")
    assert {r.source_kind for r in notes.collect()} == {"manual_note"}


def test_batch_of_searches_equals_single_ones(spark, chunks, sources, vectors):
    queries = [(1, "word1 common", [float(x) for x in vectors[3]]), (2, "word2", None), (3, "zzz", None)]
    df = spark.createDataFrame(queries, "query_id long, query string, embedding array<float>")
    got = fusion.search_batch(chunks, df, k=4).collect()
    for number, text, v in queries:
        mine = sorted((r for r in got if r.query_id == number), key=lambda r: r.position)
        alone = fusion.search(spark, chunks, sources, text, v, limit=4)
        assert [r.chunk_id for r in mine] == [r.chunk_id for r in alone.collect()]


def test_documents_and_inventory(spark, chunks, sources):
    assert [r.chunk_index for r in corpus.get_document(sources, chunks, 3).collect()] == list(range(43))
    assert corpus.get_document(sources, chunks, 3).first().chunk_count == 43
    empty = corpus.get_document(sources, chunks, 7).collect()
    assert len(empty) == 1 and empty[0].chunk_count == 0 and empty[0].text is None
    assert corpus.get_document(sources, chunks, 1234).count() == 0
    listed = tools.list_sources(sources, chunks, limit=2).collect()
    assert [(r.id, r.chunk_count) for r in listed] == [(7, 0), (6, 42)]
    assert tools.list_sources(sources, chunks, "plan", 0).count() == 1
    stats = corpus.corpus_stats(sources, chunks).first()
    assert (stats.sources_total, stats.chunks_total, stats.chunks_embedded) == (8, 300, 267)
    assert stats.by_kind == '{"manual_note":4,"plan":4}'
    nothing = corpus.corpus_stats(sources.limit(0), chunks.limit(0)).first()
    assert tuple(nothing) == (0, 0, 0, "{}")


def test_backlog_order(chunks, sources):
    pending = [i for i in range(300) if i % 9 == 8]
    assert ids(backfill.fifo_batch(chunks, 5)) == pending[:5]
    notes = sorted((i for i in pending if (i % 7) % 2), reverse=True)
    others = [i for i in pending if not (i % 7) % 2]
    assert ids(backfill.priority_batch(chunks, sources, 20)) == (notes + others)[:20]
    assert ids(backfill.pending_of_kind(chunks, sources)) == notes[::-1]
    label = backfill.batch_label(backfill.priority_batch(chunks, sources, 3), chunks, sources).first()
    assert label.label == "NOTE" and label.kinds == ["manual_note"]


def test_failed_calls_leave_vectors_missing(chunks):
    embedder = backfill.hashing_embedder(DIM)

    def flaky(texts, mode):
        return None if any("text 8" == t[-6:] for t in texts) else embedder(texts, mode)

    vectors = backfill.embed_chunks(backfill.pending(chunks).coalesce(1), flaky, batch=4)
    filled = backfill.write_back(chunks, vectors)
    missing = filled.filter(F.col("embedding").isNull()).count()
    assert 1 <= missing <= 4
    assert filled.count() == 300
    kept = filled.filter(F.col("chunk_id") == 5).first().embedding
    assert kept == chunks.filter(F.col("chunk_id") == 5).first().embedding


def test_hashing_embedder():
    embed = backfill.hashing_embedder(16)
    one, two, none = embed(["The cat", "cat THE the", "!"], "document")
    assert abs(sum(x * x for x in one) - 1) < 1e-12 and not any(none)
    assert one != two


def test_progress_without_batches(spark, chunks):
    schema = "n_chunks long, started_at timestamp, finished_at timestamp"
    row = backfill.progress(spark.createDataFrame([], schema), chunks).first()
    assert row.remaining == 33 and row.per_minute is None and row.minutes_left is None


def test_index_is_written_where_the_postings_are(spark, tmp_path):
    rows = [(i, " ".join(f"w{(i * j) % 97}" for j in range(i % 60))) for i in range(300)]
    index = lexical.postings(spark.createDataFrame(rows, "chunk_id long, text string").repartition(3))
    path = str(tmp_path / "index")
    lexical.write_index(index, path, buckets=8)
    stored = spark.read.parquet(path)
    files = {}
    for r in stored.select(F.input_file_name().alias("file"), F.monotonically_increasing_id().alias("at"), "term").collect():
        files.setdefault(r.file, []).append((r.at, r.term))
    # A file for each task, not one for each task and bucket; sorted inside.
    assert 1 <= len(files) <= 3
    for found in files.values():
        order = [term for _, term in sorted(found)]
        assert order == sorted(order)
    assert sorted(stored.collect()) == sorted(index.select(stored.columns).collect())


def test_stored_corpus_keeps_vectors_apart_from_texts(spark, tmp_path):
    text = lambda k: f"# title {k}\n" + " ".join(f"w{(k * 31 + j) % 211}" for j in range(k * 40))
    docs = [(k % 9, text(k), "en", "a") for k in range(12)] + [(None, text(5), "de", "b"), (20, None, "de", "b"), (21, "", "de", "b")]
    spark.createDataFrame(docs, "doc_id long, text string, lang string, source string").write.parquet(str(tmp_path / "documents.parquet"))
    vectors = [(k % 7, [float(k), 1.0]) for k in range(10)] + [(1, None), (None, [1.0, 2.0]), (None, [1.0, 3.0]), (21, [0.0, 1.0])]
    spark.createDataFrame(vectors, "vec_id long, embedding array<float>").write.parquet(str(tmp_path / "embeddings.parquet"))
    corpus = inputs.corpus(spark, str(tmp_path))
    joined = inputs.embedded_chunks(spark, str(tmp_path))
    bag = lambda df, *columns: sorted(map(repr, df.select(*columns).collect()))
    columns = ["chunk_id", "source_id", "chunk_index", "text", "token_count"]
    assert bag(corpus.chunks, *columns) == bag(joined, *columns)
    assert "text" not in corpus.vectors.columns and "embedding" not in corpus.chunks.columns
    columns = ["chunk_id", "source_id", "embedding"]
    assert bag(corpus.vectors, *columns) == bag(joined.filter("embedding IS NOT NULL"), *columns)
    assert bag(spark.read.parquet(corpus.postings), "chunk_id", "term", "tf") == bag(lexical.postings(joined), "chunk_id", "term", "tf")
