"""Registered queries over documents, conversations and vectors."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from tidemark import fixed, tools
from tidemark.functions import text as tx
from tidemark.functions import vectors as vx
from tidemark.operators import backfill, chunking, corpus, fusion, ivf, keyed, lexical, vector
from tidemark.plans import inputs
from tidemark.plans.inputs import table
from tidemark.sources import files, keyed_store, snapshots
from tidemark.sources.workdir import new_dir, saved
from tidemark.streaming import backfill as stream_vectors

TOP = 10
IVF_LISTS, IVF_RECALL = 16, 0.95
STORE_BUCKETS = 16


# --- text preparation -------------------------------------------------------

def chunk_documents(spark, sf_dir):
    return inputs.chunks(spark, sf_dir).select(
        "source_id", "chunk_index", "text", "token_count"
    )


def redact_documents(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").withColumn("clean", tx.redact(F.col("text")))
    return docs.select(
        "doc_id", tx.redaction_hits(F.col("text"), F.col("clean")).alias("hits"), "clean"
    )


def doc_titles(spark, sf_dir):
    return inputs.documents(spark, sf_dir).select("source_id", "title")


def doc_previews(spark, sf_dir):
    docs = inputs.documents(spark, sf_dir)
    return fusion.preview(docs).select("source_id", "short_title", "short_text")


def pair_turns(spark, sf_dir):
    turns = chunking.pair_turns(inputs.messages(spark, sf_dir))
    return turns.select("session", "seq", "turn_id", "user_text", "assistant_text")


def chunk_turns(spark, sf_dir):
    turns = chunking.redact_turns(chunking.pair_turns(inputs.messages(spark, sf_dir)))
    return chunking.chunk_turns(turns).select(
        "session", "chunk_index", "turn_id", "sub_chunk", "text", "token_count"
    )


def session_titles(spark, sf_dir):
    return chunking.session_titles(chunking.redact_turns(chunking.pair_turns(inputs.messages(spark, sf_dir))))


def postings(spark, sf_dir):
    return inputs.chunk_postings(spark, sf_dir).select("chunk_id", "term", "tf", "n_words")


# --- retrieval --------------------------------------------------------------

def vector_topk(spark, sf_dir):
    hits = vector.vector_topk(
        inputs.chunk_vectors(spark, sf_dir), inputs.query_vector(spark, sf_dir), TOP
    )
    return hits.select("chunk_id", F.round("score", 6).alias("score"))


def vector_topk_kind(spark, sf_dir):
    hits = vector.vector_topk(
        inputs.chunk_vectors(spark, sf_dir),
        inputs.query_vector(spark, sf_dir),
        TOP,
        inputs.sources(spark, sf_dir),
        "en",
    )
    return hits.select("chunk_id", F.round("score", 6).alias("score"))


def vector_ivf_full_probe(spark, sf_dir):
    vectors = table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").alias("chunk_id"), F.col("vec_id").alias("source_id"), "embedding"
    )
    built = ivf.build_lists(vectors, n_lists=16)
    path = new_dir(spark, "lists")
    ivf.write_lists(built, path)
    lists = ivf.open_lists(spark, path)
    hits = ivf.ivf_topk(lists, inputs.query_vector(spark, sf_dir), TOP, n_probe=16)
    return hits.select("chunk_id", F.round("score", 6).alias("score"))


def vector_ivf_probe(spark, sf_dir):
    """Approximate search: the vectors whose id 100 divides, in the fewest lists that reach the wanted recall.

    Lists are trained on even ids; the others are added to the stored lists as new
    chunks are. The number of lists to probe is measured on a tenth of the queries.
    """
    vectors = table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").alias("chunk_id"), F.col("vec_id").alias("source_id"), "embedding"
    )
    path = new_dir(spark, "lists")
    ivf.write_lists(ivf.build_lists(vectors.filter("chunk_id % 2 = 0"), n_lists=IVF_LISTS), path)
    ivf.add_to_lists(vectors.filter("chunk_id % 2 <> 0"), path)
    lists = ivf.open_lists(spark, path)
    queries = vectors.filter("chunk_id % 100 = 0").select(F.col("chunk_id").alias("query_id"), "embedding")
    n_probe = ivf.probes_for(lists, queries.filter("query_id % 1000 = 0"), TOP, IVF_RECALL)
    hits = ivf.ivf_topk_batch(lists, queries, TOP, n_probe)
    return hits.select("query_id", "rank", "chunk_id", F.round("score", 6).alias("score"))


def lexical_topk(spark, sf_dir):
    terms = lexical.query_terms(spark, inputs.query_text(spark, sf_dir))
    index = lexical.read_index(spark, inputs.corpus(spark, sf_dir).postings, terms)
    hits = lexical.lexical_topk(index, terms, TOP)
    return hits.select("chunk_id", F.round("score", 6).alias("score"))


def lexical_bm25(spark, sf_dir):
    corpus = inputs.corpus(spark, sf_dir)
    terms = lexical.query_terms(spark, inputs.query_text(spark, sf_dir))
    scores = lexical.bm25_scores(lexical.read_index(spark, corpus.postings, terms), terms, corpus.sizes)
    return lexical.top(scores, TOP).select("chunk_id", F.round("score", 6).alias("score"))


def hybrid_search(spark, sf_dir):
    corpus, query = inputs.corpus(spark, sf_dir), inputs.query_text(spark, sf_dir)
    hits = fusion.search(
        spark,
        corpus.chunks,
        corpus.sources,
        query,
        inputs.query_vector(spark, sf_dir),
        limit=TOP,
        index=lexical.read_index(spark, corpus.postings, lexical.query_terms(spark, query)),
        vectors=corpus.vectors,
    )
    return hits.select(
        "chunk_id", "source_id", "kind", "origin", "title", "chunk_index", "text",
        F.round("fusion_score", fixed.SCORE_PLACES).alias("fusion_score"),
    )


def hybrid_search_json(spark, sf_dir):
    """Hits as JSON lines, the form the search tool returns."""
    hits = hybrid_search(spark, sf_dir)
    fields = [
        F.col("chunk_id").alias("id"), "source_id", F.col("kind").alias("source_kind"),
        F.col("origin").alias("source_origin"), F.col("title").alias("source_title"), "chunk_index",
        "text", "fusion_score",
    ]
    return hits.select(F.to_json(F.struct(*fields)).alias("hit"))


def hybrid_batch(spark, sf_dir):
    corpus = inputs.corpus(spark, sf_dir)
    index = spark.read.parquet(corpus.postings)
    hits = fusion.search_batch(corpus.chunks, inputs.queries(spark, sf_dir), index=index, vectors=corpus.vectors)
    return hits.select(
        "query_id", "position", "chunk_id", F.round("fusion_score", 6).alias("fusion_score")
    )


def get_document(spark, sf_dir):
    """The longest document with all its chunks."""
    longest = table(spark, sf_dir, "documents").orderBy(F.desc("n_chars"), "doc_id").first()
    rows = corpus.get_document(
        inputs.sources(spark, sf_dir), inputs.chunks(spark, sf_dir), longest.doc_id
    )
    return rows.select("source_id", "kind", "origin", "title", "chunk_count", "chunk_index", "text")


def list_sources(spark, sf_dir):
    rows = corpus.list_sources(
        inputs.sources(spark, sf_dir), inputs.chunks(spark, sf_dir), limit=200
    )
    return rows.select(
        "source_id", "kind", "origin", "title", "chunk_count",
        F.date_format("created_at", "yyyy-MM-dd HH:mm:ss").alias("created_at"),
    )


def list_sources_reply(spark, sf_dir):
    """The inventory as the JSON array that the tool returns."""
    rows = list_sources(spark, sf_dir).withColumnRenamed("source_id", "id")
    fields = rows.select("id", "kind", "origin", "title", "created_at", "chunk_count")
    return tools.as_json_list(fields, [F.desc("created_at"), F.asc("id")])


def document_heads(spark, sf_dir):
    """Every labelled document asked for, and as many ids that do not exist."""
    heads = corpus.document_heads(
        inputs.sources(spark, sf_dir), inputs.chunks(spark, sf_dir), _delete_requests(spark, sf_dir)
    )
    return heads.select("source_id", "kind", "origin", "title", "chunk_count", "error")


def source_chunk_counts(spark, sf_dir):
    rows = corpus.with_chunk_counts(inputs.sources(spark, sf_dir), inputs.chunks(spark, sf_dir))
    return rows.select("source_id", "kind", "chunk_count")


def corpus_stats(spark, sf_dir):
    return corpus.corpus_stats(
        inputs.sources(spark, sf_dir), inputs.embedded_chunks(spark, sf_dir)
    )


def kind_counts(spark, sf_dir):
    return corpus.kind_counts(inputs.sources(spark, sf_dir))


# --- keyed tables -----------------------------------------------------------

def _source_batch(spark, sf_dir):
    """Re-ingested sources: every labelled document twice, and one new origin for each."""
    rows = (
        table(spark, sf_dir, "labels")
        .join(table(spark, sf_dir, "documents"), "doc_id")
        .select("doc_id", F.col("lang").alias("kind"), "source", "quality", "toxic")
    )
    passes = rows.withColumn("pass", F.explode(F.array(F.lit(0), F.lit(1), F.lit(2))))
    known = F.concat_ws("/", "source", F.col("doc_id").cast("string"))
    return passes.select(
        "kind",
        F.when(F.col("pass") < 2, known).otherwise(F.concat(known, F.lit("/new"))).alias("origin"),
        F.concat_ws("-", F.lit("pass"), F.col("pass").cast("string")).alias("title"),
        F.concat_ws(",", F.col("quality").cast("string"), F.col("toxic").cast("string")).alias(
            "metadata"
        ),
        F.lit("2024-06-01").alias("created_at"),
        F.lit("2024-06-01").alias("updated_at"),
        "pass",
    )


def upsert_sources(spark, sf_dir):
    current = inputs.sources(spark, sf_dir).select(
        "kind",
        "origin",
        "title",
        F.lit("").alias("metadata"),
        F.date_format("created_at", "yyyy-MM-dd").alias("created_at"),
        F.date_format("created_at", "yyyy-MM-dd").alias("updated_at"),
    )
    return keyed.upsert_sources(current, _source_batch(spark, sf_dir), ["pass"])


def stored_sources(spark, sf_dir):
    """The same upsert on a table stored in buckets, in three batches that each rewrite the buckets of their keys.

    Known sources keep their ids; ids of new ones lie above all that were ever given.
    """
    path = new_dir(spark, "stored")
    day = F.date_format("created_at", "yyyy-MM-dd")
    current = inputs.sources(spark, sf_dir).select(
        "source_id", "kind", "origin", "title", F.lit("").alias("metadata"),
        day.alias("created_at"), day.alias("updated_at"),
    )
    first = keyed_store.create(current, path, ["kind", "origin"], STORE_BUCKETS, counter="source_id")
    batch = saved(_source_batch(spark, sf_dir), "batch")
    for n in range(3):
        part = batch.filter(F.col("pass") == n)
        keyed_store.change(
            spark, path, part,
            lambda rows, version, part=part: keyed.upsert_sources(rows, part, ["pass"], F.lit(version.last)),
        )
    rows = keyed_store.read(spark, path)
    owners = F.count("*").over(Window.partitionBy("source_id"))  # ids are unique: no large group
    return rows.select(
        F.when(F.col("source_id") <= first.last, F.col("source_id")).alias("source_id"), owners.alias("owners"),
        "kind", "origin", "title", "metadata", "created_at", "updated_at",
    )


def stored_chunks(spark, sf_dir):
    """Chunks stored by source: labelled documents are read again, then the sources of one language go."""
    path = new_dir(spark, "stored")
    columns = ["source_id", "chunk_index", "text", "token_count"]
    keyed_store.create(inputs.chunks(spark, sf_dir).select(*columns), path, ["source_id"], STORE_BUCKETS)
    labels = table(spark, sf_dir, "labels").select(F.col("doc_id").alias("source_id"))
    again = saved(_second_reading(spark, sf_dir).select(*columns), "again")
    keyed_store.change(spark, path, again, lambda rows, _: keyed.replace_children(rows, again))
    gone = keyed.delete_outcomes(inputs.sources(spark, sf_dir), labels, deletable="es").filter("deleted")
    gone = saved(gone.select("source_id"), "gone")
    keyed_store.change(spark, path, gone, lambda rows, _: rows.join(gone, "source_id", "left_anti"))
    return keyed_store.read(spark, path)


def _second_reading(spark, sf_dir):
    labels = table(spark, sf_dir, "labels").select(F.col("doc_id").alias("source_id"))
    again = (
        inputs.redacted(spark, sf_dir)
        .withColumnRenamed("doc_id", "source_id")
        .join(labels, "source_id", "left_semi")
        .withColumn("text", F.concat(F.lit("second reading: "), "text"))
    )
    return chunking.chunk_documents(again)


def replace_chunks(spark, sf_dir):
    """Labelled documents come back in upper case and replace their old chunks."""
    current = inputs.chunks(spark, sf_dir)
    rows = keyed.replace_children(current.drop("chunk_id"), _second_reading(spark, sf_dir))
    return rows.select("source_id", "chunk_index", "text", "token_count")


def upsert_chunks(spark, sf_dir):
    """First chunks of labelled documents are overwritten by key; other chunks stay."""
    current = inputs.chunks(spark, sf_dir).select("source_id", "chunk_index", "text", "token_count")
    batch = table(spark, sf_dir, "labels").select(
        F.col("doc_id").alias("source_id"),
        F.lit(0).alias("chunk_index"),
        F.concat(F.lit("label "), F.col("quality").cast("string")).alias("text"),
        F.lit(7).alias("token_count"),
    )
    return keyed.upsert_chunks(current, batch)


def _delete_requests(spark, sf_dir):
    """Every label, and for each a request for a source that does not exist."""
    ids = table(spark, sf_dir, "labels").select(F.col("doc_id").alias("source_id"))
    return ids.unionByName(ids.select((-F.col("source_id") - 1).alias("source_id")))


def guarded_delete(spark, sf_dir):
    outcomes, _, _ = keyed.guarded_delete(
        inputs.sources(spark, sf_dir),
        inputs.chunks(spark, sf_dir),
        _delete_requests(spark, sf_dir),
        deletable="es",
    )
    return outcomes


def delete_replies(spark, sf_dir):
    """The JSON answer to every delete request."""
    return keyed.delete_replies(guarded_delete(spark, sf_dir))


def guarded_delete_chunks(spark, sf_dir):
    _, _, chunks = keyed.guarded_delete(
        inputs.sources(spark, sf_dir),
        inputs.chunks(spark, sf_dir),
        _delete_requests(spark, sf_dir),
        deletable="es",
    )
    return chunks.select("source_id", "chunk_index")


def _notes(spark, sf_dir):
    """Every document saved as a note; one language brings its own titles."""
    docs = table(spark, sf_dir, "documents")
    title = F.when(F.col("lang") == "de", F.concat(F.lit("note "), F.col("doc_id").cast("string")))
    return docs.select(
        F.col("text").alias("content"), F.array("lang").alias("tags"), title.alias("title"), "doc_id"
    )


def _add_notes(spark, sf_dir):
    at = F.lit("2024-06-01").cast("timestamp_ntz")
    sources = inputs.sources(spark, sf_dir).withColumn("metadata", F.lit("{}"))
    sources = sources.withColumn("updated_at", F.col("created_at"))
    chunks = inputs.embedded_chunks(spark, sf_dir).withColumn("metadata", F.lit("{}"))
    return keyed.add_notes(_notes(spark, sf_dir), sources, chunks, ["doc_id"], at)


def add_notes(spark, sf_dir):
    receipts, _, _ = _add_notes(spark, sf_dir)
    return receipts.select("title", "chunk_count", "redacted_hits", "status")


def note_rejections(spark, sf_dir):
    """Notes of which every third has blank content: the ones refused and why."""
    notes = _notes(spark, sf_dir)
    blank = F.when(F.col("doc_id") % 3 == 0, F.lit(" \n\t ")).otherwise(F.col("content"))
    return keyed.rejected_notes(notes.withColumn("content", blank)).select("doc_id", "error")


def add_notes_chunks(spark, sf_dir):
    """All chunks after the notes were added, by kind, with how many wait for a vector."""
    _, sources, chunks = _add_notes(spark, sf_dir)
    rows = chunks.join(sources.select("source_id", "kind"), "source_id")
    return rows.groupBy("kind").agg(
        F.count("*").alias("n_chunks"),
        F.count_if(F.col("embedding").isNull()).alias("n_pending"),
        F.sum("token_count").alias("n_chars"),
    )


# --- embedding backlog ------------------------------------------------------

def embed_pending_count(spark, sf_dir):
    return backfill.pending(inputs.embedded_chunks(spark, sf_dir)).agg(
        F.count("*").alias("pending")
    )


def embed_backlog_fifo(spark, sf_dir):
    return backfill.fifo_batch(inputs.embedded_chunks(spark, sf_dir))


def embed_backlog_priority(spark, sf_dir):
    return backfill.priority_batch(
        inputs.embedded_chunks(spark, sf_dir), inputs.sources(spark, sf_dir), first_kind="es"
    )


def embed_backlog_notes(spark, sf_dir):
    return backfill.pending_of_kind(
        inputs.embedded_chunks(spark, sf_dir), inputs.sources(spark, sf_dir), kind="es"
    )


def embed_batch_kinds(spark, sf_dir):
    chunks = inputs.embedded_chunks(spark, sf_dir)
    sources = inputs.sources(spark, sf_dir)
    batch = backfill.priority_batch(chunks, sources, first_kind="es")
    label = backfill.batch_label(batch, chunks, sources, first_kind="es")
    return label.select(F.array_join("kinds", ",").alias("kinds"), "label")


def embed_progress(spark, sf_dir):
    """Progress when every language was one finished batch of a minute."""
    chunks = inputs.embedded_chunks(spark, sf_dir)
    kinds = inputs.sources(spark, sf_dir).select("source_id", "kind")
    done = chunks.filter(F.col("embedding").isNotNull()).join(kinds, "source_id")
    start = F.lit("2024-06-01T00:00:00Z").cast("timestamp")
    batches = done.groupBy("kind").agg(F.count("*").alias("n_chunks")).select(
        "n_chunks",
        start.alias("started_at"),
        (start + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(4))).alias("finished_at"),
    )
    row = backfill.progress(batches, chunks)
    return row.select(
        "processed",
        "remaining",
        F.round("per_minute", 6).alias("per_minute"),
        F.round("minutes_left", 6).alias("minutes_left"),
    )


def _vector_facts(chunks):
    return chunks.select(
        "chunk_id",
        F.size("embedding").alias("dim"),
        F.round(vx.dot(F.col("embedding"), F.col("embedding")), 4).alias("squared"),
        F.round(F.get("embedding", F.lit(0)).cast("double"), 4).alias("first_value"),
        F.round(F.get("embedding", F.lit(63)).cast("double"), 4).alias("last_value"),
    )


def embed_writeback(spark, sf_dir):
    """Every pending chunk gets a hashed vector; the given vectors stay."""
    chunks = inputs.embedded_chunks(spark, sf_dir)
    vectors = backfill.embed_chunks(backfill.pending(chunks), backfill.hashing_embedder())
    return _vector_facts(backfill.write_back(chunks, vectors))


def stream_backfill(spark, sf_dir):
    """The same by a stream over a stored chunk table, in several micro-batches and two runs.

    A first run sees a part of the chunks; a second one, with a checkpoint of
    its own, sees all of them and embeds the rest.
    """
    path = new_dir(spark, "backfill")
    inputs.embedded_chunks(spark, sf_dir).repartition(6, "source_id").write.parquet(f"{path}/chunks")
    chunks = spark.read.parquet(f"{path}/chunks")
    landed = spark.readStream.schema(chunks.schema).option("maxFilesPerTrigger", 2).parquet(f"{path}/chunks")
    early = landed.filter(F.col("source_id") % 2 == 0)
    for run, rows in (("early", early), ("all", landed)):
        stream_vectors.append_vectors(
            rows, backfill.hashing_embedder(), f"{path}/vectors", f"{path}/state-{run}", fold_after=4
        ).awaitTermination()
    return _vector_facts(backfill.write_back(chunks, stream_vectors.read_vectors(spark, f"{path}/vectors")))


def embed_sources(spark, sf_dir):
    """Chunks embedded as a whole corpus, then the number of vectors per language."""
    vectors = backfill.embed_chunks(inputs.chunks(spark, sf_dir), backfill.hashing_embedder(), "chunk_id")
    owner = inputs.sources(spark, sf_dir).select("source_id", "kind")
    by_source = vectors.withColumn("source_id", F.expr(f"chunk_id div {chunking.CHUNKS_PER_SOURCE}"))
    first = F.round(F.get("embedding", F.lit(0)).cast("double"), 4).cast("decimal(10,4)")
    rows = by_source.join(owner, "source_id").groupBy("kind")
    return rows.agg(F.count("embedding").alias("n_vectors"), F.sum(first).cast("double").alias("first_values"))


def snapshot_retention(spark, sf_dir):
    """Orders as daily snapshots: which are kept as of the last day, and their size."""
    orders = table(spark, sf_dir, "orders").withColumn("snapshot_date", F.to_date("o_orderdate"))
    as_of = orders.agg(F.max("snapshot_date")).scalar()
    kept = snapshots.retained(orders, as_of).groupBy("snapshot_date").agg(F.count("*").alias("n"))
    gone = snapshots.expired_dates(orders, as_of).withColumn("n", F.lit(0).cast("bigint"))
    return kept.unionByName(gone).select(F.col("snapshot_date").cast("string").alias("day"), "n")


# --- files ------------------------------------------------------------------

def _write_sessions(spark, sf_dir, path):
    """Conversations as JSON lines, a folder per conversation; every third row as blocks."""
    rows = table(spark, sf_dir, "conversations")
    text = F.to_json(F.struct(F.lit("text").alias("type"), "text"))
    tool = F.concat(
        F.lit('{"type":"tool_use","name":"lookup","input":{"turn":'),
        F.col("turn").cast("string"),
        F.lit("}}"),
    )
    result = F.lit('{"type":"tool_result","content":[{"text":"found"},{"text":"it"}]}')
    as_blocks = F.concat(F.lit("["), text, F.lit(","), tool, F.lit(","), result, F.lit("]"))
    as_string = F.regexp_extract(F.to_json(F.struct("text")), r'(?s)\A\{"text":(.*)\}\z', 1)
    content = F.when(F.col("turn") % 3 == 2, as_blocks).otherwise(as_string)
    line = F.concat(
        F.lit('{"type":"'), F.col("role"),
        F.lit('","uuid":"'), F.concat_ws("-", F.col("conv_id").cast("string"), F.col("turn").cast("string")),
        F.lit('","timestamp":"2024-01-01T00:00:00Z","message":{"role":"'), F.col("role"),
        F.lit('","content":'), content, F.lit("}}"),
    )
    noise = F.array(line, F.lit(""), F.lit('{"broken": '))
    out = rows.select("conv_id", "turn", F.explode(noise).alias("value"))
    (
        out.repartitionByRange("conv_id", "turn")
        .sortWithinPartitions("conv_id", "turn")
        .select("conv_id", "value")
        .write.partitionBy("conv_id")
        .text(path)
    )


def _conversation_of(path):
    return F.regexp_extract(path, r"conv_id=(\d+)/", 1).cast("bigint")


def read_sessions(spark, sf_dir):
    path = new_dir(spark, "sessions")
    _write_sessions(spark, sf_dir, path)
    lines = files.read_session_lines(spark, path, session=_conversation_of)
    return files.session_messages(lines).select("session", "turn_id", "role", "text", "ts")


def ingest_sessions(spark, sf_dir):
    """Session files to turns to chunks, one chunk table over all sessions."""
    path = new_dir(spark, "sessions")
    _write_sessions(spark, sf_dir, path)
    lines = files.read_session_lines(spark, path, session=_conversation_of)
    # Pairing and chunking go over the messages several times; the lines are parsed once.
    messages = saved(files.session_messages(lines), "messages")
    turns = chunking.redact_turns(chunking.pair_turns(messages))
    return chunking.chunk_turns(turns).select("session", "chunk_index", "turn_id", "text")


def ingest_session_sources(spark, sf_dir):
    """The source row of every session file: title of the first user turn, number of turns."""
    path = new_dir(spark, "sessions")
    _write_sessions(spark, sf_dir, path)
    lines = files.read_session_lines(spark, path, session=_conversation_of)
    turns = chunking.redact_turns(chunking.pair_turns(saved(files.session_messages(lines), "messages")))
    titles = chunking.session_titles(turns)
    listing = files.discover(spark, globs=[path]).withColumn("session", _conversation_of(F.col("path")))
    rows = files.session_sources(titles, listing)
    turns = F.get_json_object("metadata", "$.turn_count").cast("bigint")
    recent = F.get_json_object("metadata", "$.file_mtime").cast("bigint") > 1_700_000_000
    return rows.select("kind", "origin", "title", turns.alias("turn_count"), recent.alias("has_time"))


def discover_files(spark, sf_dir):
    path = new_dir(spark, "sessions")
    _write_sessions(spark, sf_dir, path)
    found = files.discover(spark, [f"{path}/missing.jsonl"], [f"{path}/*/*", f"{path}/*/*.txt"])
    return found.select(_conversation_of(F.col("path")).alias("conv_id")).distinct()


def ingest_files(spark, sf_dir):
    """Documents written as files of a hundred, read back whole, redacted, titled and chunked; totals."""
    path = new_dir(spark, "documents")
    group = F.floor(F.col("doc_id") / 100).cast("bigint")
    grouped = table(spark, sf_dir, "documents").groupBy(group.alias("part")).agg(
        F.array_sort(F.collect_list(F.struct("doc_id", "text"))).alias("docs")
    )
    text = F.array_join(F.col("docs.text"), "\n\n")
    grouped.select(text.alias("value"), "part").write.partitionBy("part").text(path)
    listing = files.discover(spark, globs=[f"{path}/*/*.txt"])
    # A file that is listed and gone when it is read.
    gone = listing.orderBy("path").limit(1).withColumn("path", F.concat("path", F.lit(".gone")))
    read = saved(files.read_documents(spark, listing.unionByName(gone), [path]), "documents")
    pieces = saved(chunking.with_pieces(files.file_sources(read, "project_doc"), "text").select("path", "hits", "pieces"), "pieces")
    counted = pieces.select("path", F.size("pieces").cast("bigint").alias("chunks"), "hits")
    # The ids of the run's chunks are places in the saved table; its rows do not change.
    chunks = pieces.select("path", F.explode("pieces").alias("text")).withColumn("chunk_id", F.monotonically_increasing_id())
    vectors = backfill.embed_chunks(chunks, backfill.hashing_embedder()).filter(F.col("embedding").isNotNull())
    embedded = chunks.select("chunk_id", "path").join(vectors.select("chunk_id"), "chunk_id").select("path")
    return files.ingest_totals(files.file_results(read, counted, embedded))


QUERIES = {
    f.__name__: f
    for f in (
        hybrid_search, hybrid_search_json, hybrid_batch, vector_topk, vector_topk_kind,
        vector_ivf_full_probe, vector_ivf_probe, lexical_topk, lexical_bm25, postings, chunk_documents,
        redact_documents, doc_titles, doc_previews, pair_turns, chunk_turns, session_titles,
        get_document, document_heads, list_sources, list_sources_reply, source_chunk_counts, corpus_stats, kind_counts,
        upsert_sources, stored_sources, upsert_chunks, replace_chunks, stored_chunks, guarded_delete, delete_replies,
        guarded_delete_chunks, add_notes, note_rejections, add_notes_chunks, embed_pending_count, embed_backlog_fifo,
        embed_backlog_priority, embed_backlog_notes, embed_batch_kinds, embed_progress,
        embed_writeback, embed_sources, stream_backfill, snapshot_retention, read_sessions, ingest_sessions, ingest_session_sources, discover_files, ingest_files,
    )
}
