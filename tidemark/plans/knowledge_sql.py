"""SQL counterparts of the queries in ``knowledge``."""

from __future__ import annotations

from tidemark.fixed import NOTE_STATUS, REDACTED
from tidemark.functions.text import SECRETS

_TRIM = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"


def windows(text: str) -> str:
    """List of trimmed 2000-character windows, step 1800, of an expression."""
    n = f"greatest(ceil((length({text}) - 200) / 1800.0), 1)::BIGINT"
    cut = f"list_transform(range({n}), lambda i: trim(substr({text}, i * 1800 + 1, 2000), {_TRIM}))"
    return f"list_filter({cut}, lambda p: length(p) >= 50)"


def chunk_rows(table: str, key: str, text: str, name: str) -> str:
    return f"""{name} AS (
      SELECT source_id, chunk_index, pieces[chunk_index + 1] AS text,
             source_id * 2097152 + chunk_index AS chunk_id
      FROM (SELECT {key} AS source_id, {windows(text)} AS pieces,
                   unnest(range(length({windows(text)}))) AS chunk_index FROM {table}))"""


def _clean(text: str) -> str:
    return f"regexp_replace({text}, '{SECRETS}', '{REDACTED}', 'g')"


# Secrets are gone before a title is taken or a chunk is cut.
REDACTED_DOCUMENTS = f"(SELECT * REPLACE ({_clean('text')} AS text) FROM documents)"
CHUNKS = chunk_rows(REDACTED_DOCUMENTS, "doc_id", f"trim(text, {_TRIM})", "chunks")
EMBEDDED = f"""{CHUNKS}, embedded AS (
  SELECT c.*, e.embedding FROM chunks c
  LEFT JOIN embeddings e ON e.vec_id = c.source_id AND c.chunk_index = 0)"""
_LINE = f"regexp_extract(trim(text, {_TRIM}), '^[^\\n\\r]*')"
_BARE = f"CASE WHEN starts_with(trim({_LINE}), '# ') THEN trim(substr(trim({_LINE}), 3)) ELSE trim({_LINE}) END"
SOURCES = f"""sources AS (
  SELECT doc_id AS source_id, lang AS kind, source || '/' || doc_id AS origin,
         CASE WHEN trim({_LINE}) <> '' THEN left({_BARE}, 120) ELSE source END AS title,
         TIMESTAMP '2024-01-01' + to_minutes(doc_id::INT) AS created_at FROM {REDACTED_DOCUMENTS})"""


def term_rows(rows: str, keep: str, text: str) -> str:
    return f"""SELECT {keep}, term, count(*) AS tf,
        sum(count(*)) OVER (PARTITION BY {keep}) AS n_words
      FROM (SELECT {keep}, unnest(regexp_split_to_array(lower({text}), '[^\\p{{L}}\\p{{N}}_]+')) AS term
            FROM {rows}) WHERE term <> '' GROUP BY {keep}, term"""


POSTINGS = f"postings AS ({term_rows('chunks', 'chunk_id', 'text')})"
TERMS = """terms AS (
  SELECT item_id AS query_id, term, count(*) OVER (PARTITION BY item_id) AS n_terms
  FROM (SELECT DISTINCT item_id, term FROM (
    SELECT item_id, unnest(regexp_split_to_array(lower(text), '[^\\p{L}\\p{N}_]+')) AS term FROM benchmark)
    WHERE length(term) >= 2))"""
_H2 = "list_sum(list_transform(range(1, tf + 1), lambda j: 1e0 / (j * j)))"
LEXICAL = f"""lexical AS (
  SELECT query_id, chunk_id, round(sum(0.1::DOUBLE * {_H2} / 1.64493406685::DOUBLE) / any_value(n_terms), 12) AS score
  FROM postings JOIN terms USING (term) GROUP BY query_id, chunk_id)"""
FIRST_QUERY = "(SELECT min(item_id) FROM benchmark)"


def cosine(a: str, b: str) -> str:
    dot = lambda x, y: (
        f"list_sum(list_transform(range(1, 65), lambda i: {x}[i]::DOUBLE * {y}[i]::DOUBLE))"
    )
    return f"round({dot(a, b)} / (sqrt({dot(a, a)}) * sqrt({dot(b, b)})), 12)"


def one_vector(rows: str, where: str = "true") -> str:
    return f"""SELECT chunk_id, round(score, 6) AS score FROM (
      SELECT chunk_id, {cosine('e.embedding', 'q.embedding')} AS score
      FROM {rows} e, (SELECT embedding FROM embeddings ORDER BY vec_id LIMIT 1) q
      WHERE e.embedding IS NOT NULL AND {where}) ORDER BY score DESC, chunk_id LIMIT 10"""


def fused(queries: str, fetch: int) -> str:
    """Both rankings of every query, cut to ``fetch`` and fused."""
    return f"""by_vector AS (
      SELECT * FROM (SELECT q.query_id, e.chunk_id,
          row_number() OVER (PARTITION BY q.query_id
            ORDER BY {cosine('e.embedding', 'q.embedding')} DESC, e.chunk_id) - 1 AS rank
        FROM embedded e, ({queries}) q WHERE e.embedding IS NOT NULL AND q.embedding IS NOT NULL)
      WHERE rank < {fetch}),
    by_word AS (
      SELECT * FROM (SELECT l.query_id, chunk_id,
          row_number() OVER (PARTITION BY l.query_id ORDER BY score DESC, chunk_id) - 1 AS rank
        FROM lexical l JOIN ({queries}) q USING (query_id)) WHERE rank < {fetch}),
    fused AS (
      SELECT query_id, chunk_id, sum(1e0 / (60 + rank)) AS fusion_score,
             min(list) AS first_list, arg_min(rank, list) AS first_rank
      FROM (SELECT *, 0 AS list FROM by_vector UNION ALL SELECT *, 1 AS list FROM by_word)
      GROUP BY query_id, chunk_id),
    placed AS (
      SELECT *, row_number() OVER (PARTITION BY query_id
        ORDER BY fusion_score DESC, first_list, first_rank) - 1 AS position FROM fused)"""


_ONE = f"""SELECT {FIRST_QUERY} AS query_id,
  (SELECT embedding FROM embeddings ORDER BY vec_id LIMIT 1) AS embedding"""
_HYBRID = f"""WITH {EMBEDDED}, {SOURCES}, {POSTINGS}, {TERMS}, {LEXICAL}, {fused(_ONE, 20)},
  hits AS (
    SELECT c.chunk_id, c.source_id, s.kind, s.origin, s.title, c.chunk_index, c.text,
           round(p.fusion_score, 4) AS fusion_score
    FROM placed p JOIN chunks c USING (chunk_id) JOIN sources s USING (source_id)
    WHERE p.position < 10)"""

_KEPT = "SELECT * FROM conversations WHERE role IN ('user', 'assistant') AND trim(text) <> ''"


def turns(kept: str) -> str:
    return f"""turns AS (
      SELECT conv_id AS session, turn AS seq, conv_id || '-' || turn AS turn_id,
             CASE WHEN role = 'user' THEN text ELSE '' END AS user_text,
             CASE WHEN role = 'assistant' THEN text WHEN next_role = 'assistant' THEN next_text
                  ELSE '' END AS assistant_text
      FROM (SELECT *, lag(role) OVER w AS prev_role, lead(role) OVER w AS next_role,
                   lead(text) OVER w AS next_text
            FROM ({kept}) WINDOW w AS (PARTITION BY conv_id ORDER BY turn))
      WHERE role = 'user' OR prev_role IS DISTINCT FROM 'user')"""


def turn_chunks(kept: str) -> str:
    body = "trim(concat_ws(chr(10) || chr(10), CASE WHEN u <> '' THEN 'User: ' || u END, CASE WHEN a <> '' THEN 'Assistant: ' || a END), " + _TRIM + ")"
    return f"""{turns(kept)}, rendered AS (
      SELECT session, seq, turn_id, {body} AS body FROM (
        SELECT *, {_clean('user_text')} AS u, {_clean('assistant_text')} AS a FROM turns)),
    cut AS (SELECT *, {windows('body')} AS pieces FROM rendered),
    turn_chunks AS (
      SELECT session, turn_id, sub, pieces[sub + 1] AS text, length(body) > 2000 AS is_long,
             row_number() OVER (PARTITION BY session ORDER BY seq, sub) - 1 AS chunk_index
      FROM (SELECT *, unnest(range(length(pieces))) AS sub FROM cut))"""


_BLOCKS = """SELECT * REPLACE (CASE WHEN turn % 3 = 2
  THEN text || chr(10) || '[tool: lookup({"turn":' || turn || '})]' || chr(10) || '[tool-result: found it]'
  ELSE text END AS text) FROM conversations WHERE role IN ('user', 'assistant')"""

_BATCH = """batch AS (
  SELECT d.lang AS kind, d.source || '/' || d.doc_id || CASE WHEN pass = 2 THEN '/new' ELSE '' END AS origin,
         'pass-' || pass AS title, l.quality || ',' || l.toxic AS metadata, pass
  FROM labels l JOIN documents d USING (doc_id), range(3) t(pass)),
latest AS (SELECT * FROM batch QUALIFY row_number() OVER (PARTITION BY kind, origin ORDER BY pass DESC) = 1)"""

_REQUESTS = """requests AS (SELECT DISTINCT source_id FROM (
  SELECT doc_id AS source_id FROM labels UNION ALL SELECT -doc_id - 1 FROM labels))"""

_NOTES = f"""notes AS (
  SELECT *, 'note:' || title || ':' || length(clean) AS origin FROM (
    SELECT *, CASE WHEN lang = 'de' THEN 'note ' || doc_id
                   ELSE left(regexp_extract(trim(clean, {_TRIM}), '^[^\\n\\r]*'), 120) END AS title
    FROM (SELECT doc_id, lang, {_clean('text')} AS clean, len(regexp_extract_all(text, '{SECRETS}')) AS hits
          FROM documents WHERE trim(text, {_TRIM}) <> ''))),
kept_notes AS (SELECT *, trim(clean, {_TRIM}) AS body FROM notes
  QUALIFY row_number() OVER (PARTITION BY origin ORDER BY doc_id DESC) = 1)"""

def hashed(rows: str) -> str:
    """Lengths and end values of the hashed vectors of all rows."""
    return f"""words AS (
  SELECT chunk_id, unnest(regexp_split_to_array(lower(text), '[^\\p{{L}}\\p{{N}}_]+')) AS term FROM {rows}),
slots AS (
  SELECT chunk_id, ('0x' || md5(term)[1:4])::BIGINT % 64 AS slot,
         sum(CASE WHEN ('0x' || md5(term)[5:5])::BIGINT < 8 THEN 1 ELSE -1 END)::DOUBLE AS v
  FROM words WHERE term <> '' GROUP BY chunk_id, slot),
lengths AS (
  SELECT chunk_id, sqrt(sum(v * v)) AS len, coalesce(max(v) FILTER (slot = 0), 0) AS v0,
         coalesce(max(v) FILTER (slot = 63), 0) AS v63 FROM slots GROUP BY chunk_id)"""


_HASHED = hashed("(SELECT * FROM embedded WHERE embedding IS NULL)")

ORACLES = {
    "chunk_documents": f"""WITH {CHUNKS} SELECT source_id, chunk_index::INT AS chunk_index, text,
        length(text)::INT AS token_count FROM chunks""",
    "redact_documents": f"""SELECT doc_id, len(regexp_extract_all(text, '{SECRETS}'))::BIGINT AS hits,
        {_clean('text')} AS clean FROM documents""",
    "doc_titles": f"WITH {SOURCES} SELECT source_id, title FROM sources",
    "doc_previews": f"""WITH {SOURCES} SELECT source_id, left(title, 60) AS short_title,
        replace(left(text, 120), chr(10), ' ') AS short_text
        FROM sources JOIN {REDACTED_DOCUMENTS} ON doc_id = source_id""",
    "pair_turns": f"WITH {turns(_KEPT)} SELECT * FROM turns",
    "chunk_turns": f"""WITH {turn_chunks(_KEPT)} SELECT session, chunk_index::INT AS chunk_index, turn_id,
        CASE WHEN is_long THEN sub END::INT AS sub_chunk, text, length(text)::INT AS token_count
        FROM turn_chunks""",
    "session_titles": f"""WITH {turns(_KEPT)} SELECT session,
        coalesce(arg_min(left(regexp_extract(trim({_clean('user_text')}, {_TRIM}), '^[^\\n\\r]*'), 120), seq)
          FILTER (user_text <> ''), '(untitled session)') AS title, count(*) AS turn_count
        FROM turns GROUP BY session""",
    "postings": f"""WITH {CHUNKS}, {POSTINGS} SELECT chunk_id, term, tf::INT AS tf,
        n_words::INT AS n_words FROM postings""",
    "vector_topk": f"WITH {EMBEDDED} {one_vector('embedded')}",
    "vector_topk_kind": f"""WITH {EMBEDDED} {one_vector(
        'embedded', "source_id IN (SELECT doc_id FROM documents WHERE lang = 'en')")}""",
    "vector_ivf_full_probe": one_vector("(SELECT vec_id AS chunk_id, embedding FROM embeddings)"),
    "lexical_topk": f"""WITH {CHUNKS}, {POSTINGS}, {TERMS}, {LEXICAL}
        SELECT chunk_id, round(score, 6) AS score FROM (SELECT chunk_id, score FROM lexical
        WHERE query_id = {FIRST_QUERY} ORDER BY score DESC, chunk_id LIMIT 10)""",
    "lexical_bm25": f"""WITH {CHUNKS}, {POSTINGS}, {TERMS},
        sizes AS (SELECT count(DISTINCT chunk_id) AS n, sum(tf) / count(DISTINCT chunk_id) AS mean FROM postings),
        rare AS (SELECT term, count(*) AS df FROM postings GROUP BY term),
        scored AS (SELECT chunk_id, round(sum(ln(1 + (n - df + 0.5::DOUBLE) / (df + 0.5::DOUBLE))
            * tf * 2.2::DOUBLE / (tf + 1.2::DOUBLE * (0.25::DOUBLE + 0.75::DOUBLE * n_words / mean))), 12) AS score
          FROM postings JOIN terms USING (term) JOIN rare USING (term), sizes
          WHERE query_id = {FIRST_QUERY} GROUP BY chunk_id)
        SELECT chunk_id, round(score, 6) AS score FROM (
          SELECT * FROM scored ORDER BY score DESC, chunk_id LIMIT 10)""",
    "hybrid_search": f"{_HYBRID} SELECT * REPLACE (chunk_index::INT AS chunk_index) FROM hits",
    "hybrid_search_json": f"""{_HYBRID} SELECT '{{"id":' || chunk_id || ',"source_id":' || source_id
        || ',"source_kind":"' || kind || '","source_origin":"' || origin || '","source_title":' || to_json(title)
        || ',"chunk_index":' || chunk_index || ',"text":' || to_json(text) || ',"fusion_score":' || fusion_score || '}}' AS hit FROM hits""",
    "hybrid_batch": f"""WITH {EMBEDDED}, {POSTINGS}, {TERMS}, {LEXICAL}, {fused(
        'SELECT b.item_id AS query_id, v.embedding FROM benchmark b LEFT JOIN embeddings v ON v.vec_id = b.item_id', 6)}
        SELECT query_id, position::INT AS position, chunk_id, round(fusion_score, 6) AS fusion_score
        FROM placed WHERE position < 3""",
    "get_document": f"""WITH {CHUNKS}, {SOURCES}
        SELECT s.source_id, kind, origin, title, count(c.chunk_id) OVER () AS chunk_count,
               chunk_index::INT AS chunk_index, text
        FROM sources s LEFT JOIN chunks c USING (source_id)
        WHERE s.source_id = (SELECT doc_id FROM documents ORDER BY n_chars DESC, doc_id LIMIT 1)""",
    "list_sources": f"""WITH {CHUNKS}, {SOURCES}
        SELECT source_id, kind, origin, title, count(chunk_id) AS chunk_count,
               strftime(created_at, '%Y-%m-%d %H:%M:%S') AS created_at
        FROM sources LEFT JOIN chunks USING (source_id) GROUP BY ALL
        ORDER BY created_at DESC, source_id LIMIT 200""",
    "source_chunk_counts": f"""WITH {CHUNKS} SELECT doc_id AS source_id, lang AS kind,
        count(chunk_id) AS chunk_count FROM documents LEFT JOIN chunks ON source_id = doc_id GROUP BY ALL""",
    "corpus_stats": f"""WITH {EMBEDDED} SELECT (SELECT count(*) FROM documents) AS sources_total,
        count(*) AS chunks_total, count(embedding) AS chunks_embedded,
        (SELECT '{{' || string_agg('"' || lang || '":' || n, ',' ORDER BY lang) || '}}'
         FROM (SELECT lang, count(*) AS n FROM documents GROUP BY lang)) AS by_kind FROM embedded""",
    "kind_counts": "SELECT lang AS kind, count(*) AS n FROM documents GROUP BY lang",
    "upsert_sources": f"""WITH {SOURCES}, {_BATCH}
        SELECT coalesce(s.kind, b.kind) AS kind, coalesce(s.origin, b.origin) AS origin,
               coalesce(b.title, s.title) AS title, coalesce(b.metadata, '') AS metadata,
               coalesce(strftime(s.created_at, '%Y-%m-%d'), '2024-06-01') AS created_at,
               CASE WHEN b.origin IS NULL THEN strftime(s.created_at, '%Y-%m-%d') ELSE '2024-06-01' END AS updated_at
        FROM sources s FULL JOIN latest b ON s.kind = b.kind AND s.origin = b.origin""",
    "upsert_chunks": f"""WITH {CHUNKS}
        SELECT coalesce(c.source_id, l.doc_id) AS source_id, coalesce(c.chunk_index, 0)::INT AS chunk_index,
               CASE WHEN l.doc_id IS NOT NULL THEN 'label ' || l.quality ELSE c.text END AS text,
               CASE WHEN l.doc_id IS NOT NULL THEN 7 ELSE length(c.text) END::INT AS token_count
        FROM chunks c FULL JOIN labels l ON l.doc_id = c.source_id AND c.chunk_index = 0""",
    "replace_chunks": f"""WITH {CHUNKS}, again AS (
          SELECT doc_id, 'second reading: ' || text AS text FROM {REDACTED_DOCUMENTS}
          WHERE doc_id IN (SELECT doc_id FROM labels)),
        {chunk_rows('again', 'doc_id', f"trim(text, {_TRIM})", 'fresh')}
        SELECT source_id, chunk_index::INT AS chunk_index, text, length(text)::INT AS token_count FROM (
          SELECT source_id, chunk_index, text FROM chunks
          WHERE source_id NOT IN (SELECT source_id FROM fresh)
          UNION ALL SELECT source_id, chunk_index, text FROM fresh)""",
    "guarded_delete": f"""WITH {_REQUESTS} SELECT source_id, coalesce(lang = 'es', false) AS deleted,
        CASE WHEN lang IS NULL THEN 'not_found'
             WHEN lang <> 'es' THEN 'refuse: kind=' || lang || ' cannot be deleted via MCP' END AS reason
        FROM requests LEFT JOIN documents ON doc_id = source_id""",
    "guarded_delete_chunks": f"""WITH {CHUNKS} SELECT source_id, chunk_index::INT AS chunk_index FROM chunks
        WHERE source_id NOT IN (SELECT doc_id FROM labels JOIN documents USING (doc_id) WHERE lang = 'es')""",
    "add_notes": f"""WITH {_NOTES} SELECT title, length({windows('body')})::BIGINT AS chunk_count,
        hits::BIGINT AS redacted_hits, '{NOTE_STATUS}' AS status FROM kept_notes""",
    "add_notes_chunks": f"""WITH {EMBEDDED}, {_NOTES}
        SELECT kind, count(*) AS n_chunks, count(*) FILTER (pending) AS n_pending, sum(chars)::BIGINT AS n_chars
        FROM (SELECT lang AS kind, embedding IS NULL AS pending, length(e.text) AS chars
              FROM embedded e JOIN documents ON doc_id = source_id
              UNION ALL
              SELECT 'manual_note', true, length(piece)
              FROM (SELECT unnest({windows('body')}) AS piece FROM kept_notes)) GROUP BY kind""",
    "embed_pending_count": f"WITH {EMBEDDED} SELECT count(*) AS pending FROM embedded WHERE embedding IS NULL",
    "embed_backlog_fifo": f"""WITH {EMBEDDED} SELECT chunk_id, text FROM embedded
        WHERE embedding IS NULL ORDER BY chunk_id LIMIT 15""",
    "embed_backlog_priority": f"""WITH {EMBEDDED} SELECT chunk_id, e.text, lang = 'es' AS is_note
        FROM embedded e JOIN documents ON doc_id = source_id WHERE embedding IS NULL
        ORDER BY CASE WHEN lang = 'es' THEN 0 ELSE 1 END, CASE WHEN lang = 'es' THEN -chunk_id ELSE chunk_id END
        LIMIT 32""",
    "embed_backlog_notes": f"""WITH {EMBEDDED} SELECT chunk_id, e.text FROM embedded e
        JOIN documents ON doc_id = source_id WHERE embedding IS NULL AND lang = 'es'""",
    "embed_batch_kinds": f"""WITH {EMBEDDED}, batch AS (SELECT lang
          FROM embedded e JOIN documents ON doc_id = source_id WHERE embedding IS NULL
          ORDER BY CASE WHEN lang = 'es' THEN 0 ELSE 1 END, CASE WHEN lang = 'es' THEN -chunk_id ELSE chunk_id END
          LIMIT 32)
        SELECT string_agg(DISTINCT lang, ',' ORDER BY lang) AS kinds,
               CASE WHEN bool_or(lang = 'es') THEN 'NOTE' ELSE 'queue' END AS label FROM batch""",
    "embed_progress": f"""WITH {EMBEDDED} SELECT count(embedding) AS processed,
        count(*) - count(embedding) AS remaining, round(count(embedding) * 60.0::DOUBLE / 240, 6) AS per_minute,
        round((count(*) - count(embedding)) / (count(embedding) * 60.0::DOUBLE / 240), 6) AS minutes_left
        FROM embedded""",
    "embed_writeback": f"""WITH {EMBEDDED}, {_HASHED}
        SELECT chunk_id, 64 AS dim, round(list_sum(list_transform(embedding, lambda v: v::DOUBLE * v::DOUBLE)), 4) AS squared,
               round(embedding[1]::DOUBLE, 4) AS first_value, round(embedding[64]::DOUBLE, 4) AS last_value
        FROM embedded WHERE embedding IS NOT NULL
        UNION ALL
        SELECT chunk_id, 64, CASE WHEN coalesce(len, 0) = 0 THEN 0e0 ELSE 1e0 END,
               round(coalesce(v0 / nullif(len, 0), 0), 4), round(coalesce(v63 / nullif(len, 0), 0), 4)
        FROM embedded LEFT JOIN lengths USING (chunk_id) WHERE embedding IS NULL""",
    "read_sessions": f"""SELECT conv_id AS session, conv_id || '-' || turn AS turn_id, role, text,
        '2024-01-01T00:00:00Z' AS ts FROM ({_BLOCKS})""",
    "ingest_sessions": f"""WITH {turn_chunks(_BLOCKS)} SELECT session, chunk_index::INT AS chunk_index,
        turn_id, text FROM turn_chunks""",
    "discover_files": "SELECT DISTINCT conv_id FROM conversations",
    "ingest_files": f"""SELECT count(*) + 1 AS files, sum(length({windows(f"trim(clean, {_TRIM})")}))::BIGINT AS chunks,
        sum(hits)::BIGINT AS hits,
        count(*) FILTER (length({windows(f"trim(clean, {_TRIM})")}) > 0)::BIGINT AS embedded_files, 1::BIGINT AS failed
        FROM (SELECT {_clean('text')} AS clean, len(regexp_extract_all(text, '{SECRETS}')) AS hits
              FROM (SELECT string_agg(text, chr(10) || chr(10) ORDER BY doc_id) AS text
                    FROM documents GROUP BY doc_id // 100))""",
}
ORACLES["stream_backfill"] = ORACLES["embed_writeback"]
ORACLES["embed_sources"] = f"""WITH {CHUNKS}, {hashed('chunks')} SELECT lang AS kind, count(*) AS n_vectors,
    sum(round(coalesce(v0 / nullif(len, 0), 0), 4)::DECIMAL(10, 4))::DOUBLE AS first_values
    FROM chunks LEFT JOIN lengths USING (chunk_id) JOIN documents ON doc_id = source_id GROUP BY lang"""
ORACLES["snapshot_retention"] = """WITH days AS (SELECT o_orderdate::DATE AS d, count(*) AS n FROM orders GROUP BY 1)
    SELECT strftime(d, '%Y-%m-%d') AS day,
           CASE WHEN date_diff('day', d, (SELECT max(d) FROM days)) <= 7 THEN n ELSE 0 END AS n FROM days"""
ORACLES["ingest_session_sources"] = f"""WITH {turns(_BLOCKS)} SELECT 'claude_session' AS kind,
    session::VARCHAR AS origin,
    coalesce(arg_min(left(regexp_extract(trim({_clean('user_text')}, {_TRIM}), '^[^\\n\\r]*'), 120), seq)
      FILTER (user_text <> ''), '(untitled session)') AS title,
    count(*) AS turn_count, true AS has_time
    FROM turns GROUP BY session"""
ORACLES["stored_sources"] = f"""WITH {SOURCES}, {_BATCH}
    SELECT s.source_id, 1::BIGINT AS owners,
           coalesce(s.kind, b.kind) AS kind, coalesce(s.origin, b.origin) AS origin,
           coalesce(b.title, s.title) AS title, coalesce(b.metadata, '') AS metadata,
           coalesce(strftime(s.created_at, '%Y-%m-%d'), '2024-06-01') AS created_at,
           CASE WHEN b.origin IS NULL THEN strftime(s.created_at, '%Y-%m-%d') ELSE '2024-06-01' END AS updated_at
    FROM sources s FULL JOIN latest b ON s.kind = b.kind AND s.origin = b.origin"""
ORACLES["stored_chunks"] = f"""SELECT * FROM ({ORACLES['replace_chunks']})
    WHERE source_id NOT IN (SELECT doc_id FROM labels JOIN documents USING (doc_id) WHERE lang = 'es')"""
ORACLES["list_sources_reply"] = f"""SELECT '[' || string_agg('{{"id":' || source_id || ',"kind":"' || kind
    || '","origin":"' || origin || '","title":' || to_json(title) || ',"created_at":"' || created_at
    || '","chunk_count":' || chunk_count || '}}', ',' ORDER BY created_at DESC, source_id) || ']' AS json
    FROM ({ORACLES['list_sources']})"""
ORACLES["document_heads"] = f"""WITH {CHUNKS}, {SOURCES}, {_REQUESTS},
    counted AS (SELECT source_id, count(*) AS n FROM chunks GROUP BY source_id)
    SELECT r.source_id, kind, origin, title, CASE WHEN kind IS NOT NULL THEN coalesce(n, 0) END AS chunk_count,
           CASE WHEN kind IS NULL THEN 'not_found' END AS error
    FROM requests r LEFT JOIN sources s ON s.source_id = r.source_id LEFT JOIN counted c ON c.source_id = r.source_id"""
ORACLES["delete_replies"] = f"""SELECT source_id, CASE WHEN deleted THEN '{{"deleted":true,"source_id":' || source_id || '}}'
    ELSE '{{"deleted":false,"reason":"' || reason || '"}}' END AS reply FROM ({ORACLES['guarded_delete']})"""
ORACLES["note_rejections"] = f"""SELECT doc_id, 'empty_content' AS error FROM documents
    WHERE doc_id % 3 = 0 OR coalesce(trim(text, {_TRIM}), '') = ''"""
