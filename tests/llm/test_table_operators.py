"""Language model, segmentation, shards, lengths and archives against plain answers."""

import base64
import hashlib
import math
import random
import zlib
from collections import Counter

import brute
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tidemark.llm import interpolation, lengths, pieces, queries, shards, warc


@pytest.fixture(scope="module")
def docs(spark):
    clash = {c: F.lit("x") for c in ("doc", "id", "role", "key", "tie", "row", "part", "size", "block", "ids")}
    return spark.createDataFrame(brute.ROWS, brute.SCHEMA).withColumns(clash).repartition(3)


# --- language model ---------------------------------------------------------


def role_of(doc_id):
    rest = zlib.crc32(("" if doc_id is None else str(doc_id)).encode()) % 7
    return 2 if rest == 2 else 1 if rest == 3 else 0


def plain_scores(rows, order, rounds=interpolation.ROUNDS):
    texts = [(role_of(i), brute.words(t, lower=True) + [None]) for i, t, *_ in rows]

    def grams(roles):
        found, docs = Counter(), 0
        for role, w in texts:
            if role in roles:
                docs += 1
                padded = ["<s>"] * (order - 1) + w
                for t in range(order - 1, len(padded)):
                    for k in range(order):
                        found[tuple(padded[t - k : t + 1])] += 1
        return found, docs

    def facts(roles, w):
        found, docs = roles
        padded = ["<s>"] * (order - 1) + w
        for t in range(order - 1, len(padded)):
            c = [found[tuple(padded[t - k : t + 1])] for k in range(order)]
            x = [docs if set(padded[t - k : t]) == {"<s>"} else found[tuple(padded[t - k : t])] for k in range(1, order)]
            bucket = 0
            for k, n in enumerate(x):
                if n:
                    bucket = 1 + 32 * k + min(31, int(math.log2(n)))
            yield bucket, c, x

    def chances(c, x, tokens, vocabulary):
        return [1 / (vocabulary + 1), c[0] / max(tokens, 1), *[a / b if b else 0.0 for a, b in zip(c[1:], x)]]

    unigrams = lambda found: [n for g, n in found.items() if len(g) == 1]
    counted = grams({0})
    tokens, vocabulary = sum(unigrams(counted[0])), len(unigrams(counted[0]))
    held = [(b, chances(c, x, tokens, vocabulary)) for r, w in texts if r == 1 for b, c, x in facts(counted, w)]
    weights = np.full((1 + 32 * (order - 1), order + 1), 1 / (order + 1))
    last = -math.inf
    for _ in range(rounds if held else 0):
        got, fit = np.zeros_like(weights), 0.0
        for b, p in held:
            s = weights[b] * p
            got[b] += s / s.sum()
            fit += math.log10(s.sum())
        whole = np.maximum(got.sum(axis=0) / got.sum(), 1e-9)
        weights = got + whole / whole.sum()
        weights /= weights.sum(axis=1, keepdims=True)
        if fit / len(held) - last < interpolation.ENOUGH:
            break
        last = fit / len(held)
    everything = grams({0, 1})
    tokens, vocabulary = sum(unigrams(everything[0])), len(unigrams(everything[0]))
    out = []
    for (doc_id, *_), (role, w) in zip(rows, texts):
        each = list(facts(everything, w))
        score = sum(math.log10((weights[b] * chances(c, x, tokens, vocabulary)).sum()) for b, c, x in each)
        base = sum(math.log10((c[0] + 1) / (tokens + vocabulary + 1)) for _, c, _ in each)
        out.append((doc_id, role == 2, len(w), sum(c[0] > 0 for _, c, _ in each), tokens, base, score))
    return out


def lm_role():
    rest = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % 7
    return F.when(rest == 2, 2).when(rest == 3, 1).otherwise(0)


@pytest.mark.parametrize("order", [2, 3])
def test_interpolation(spark, order):
    rnd = random.Random(order)
    rows = [r for r in brute.ROWS if r[1] is None or len(r[1]) < 5000]
    vocabulary = [f"w{int(rnd.paretovariate(1))}" for _ in range(300)]
    rows += [(200 + k, " ".join(rnd.choices(vocabulary, k=rnd.randrange(60))), "en", "a") for k in range(120)]
    table = spark.createDataFrame(rows, brute.SCHEMA).repartition(3)
    # Small blocks and parts, so that there are many of both.
    got = interpolation.scored(table, lm_role(), order=order, block_tokens=300, part_keys=200).collect()
    key = lambda r: (r[0] is None, r[0] or 0, r[2], r[6])
    got = sorted(((r.id, r.role == 2, r.n_tokens, r.n_known, r.train_tokens, r.base_score, r.score) for r in got), key=key)
    want = sorted(plain_scores(rows, order), key=key)
    assert [r[:5] for r in got] == [r[:5] for r in want]
    assert np.allclose([r[5:] for r in got], [r[5:] for r in want], rtol=1e-6)
    held_out = [r for r in got if r[1] and r[2] > 5]
    assert sum(r[6] for r in held_out) > sum(r[5] for r in held_out)


def test_interpolation_of_odd_tables(spark, docs):
    assert interpolation.scored(docs.filter("false"), lm_role()).count() == 0
    got = interpolation.scored(docs, lm_role()).collect()
    assert len(got) == len(brute.ROWS) and all(math.isfinite(r.score) for r in got)
    untrained = interpolation.scored(docs, F.lit(2)).collect()
    assert {(r.score, r.base_score, r.n_known) for r in untrained} == {(0.0, 0.0, 0)}


# --- pieces -----------------------------------------------------------------


@pytest.fixture(scope="module")
def tables(spark):
    return pieces.Tables(pieces.vocabulary(spark, queries.PIECE_MODEL).value)


def plain_nbest(tables, text, n):
    """The n best scores by keeping the n best ways to every place."""
    if not text:
        return [0.0]
    data = (" " + text).encode()
    scores = {b: tables.scores[i] for i, b in enumerate(tables.bytes_of) if b and i not in set(tables.byte_ids.tolist())}
    first = pieces._char_lengths(np.frombuffer(data, np.uint8))
    ways = [[0.0]] + [[] for _ in data]
    for end in range(1, len(data) + 1):
        for start in range(max(0, end - tables.longest), end):
            piece = data[start:end]
            if piece in scores:
                ways[end] += [w + scores[piece] for w in ways[start]]
            elif first[start] == len(piece):
                ways[end] += [w + tables.unknown for w in ways[start]]
        ways[end] = sorted(ways[end], reverse=True)[:n]
    return ways[-1]


def test_nbest(tables):
    rnd = random.Random(3)
    texts = ["", "a", " ", "the the the", "Hello  world\n a é 你", "\n", "  \n\n  x ▁ \x00 é\U0001f600", "word" * 30]
    texts += ["".join(rnd.choice("abc de\nfgé你 ▁.") for _ in range(rnd.randint(1, 25))) for _ in range(100)]
    e = pieces.encode_slice(tables, pa.array(texts), 4)
    for k, text in enumerate(texts):
        best = e.ids[e.bounds[k] : e.bounds[k + 1]].tolist()
        every = [pieces._changed(best, c) for c in e.changes[k]]
        assert every[0] == best and len({tuple(x) for x in every}) == len(every)
        assert all(pieces.decoded(tables, x) == text for x in every)
        assert np.allclose(e.scores[k], plain_nbest(tables, text, 4), atol=1e-3)


def test_slices_take_little_memory(tables):
    import tracemalloc

    rnd = random.Random(4)
    texts = pa.array([" ".join(f"w{rnd.randrange(10**6)}" for _ in range(400)) for _ in range(1200)])
    tracemalloc.start()
    for part in pieces.slices(texts):
        pieces.encode_slice(tables, part, 1)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 150e6


def test_ties_and_long_chunks_cost_no_more_than_their_length(tables):
    import time

    texts = ["-" * 10_000, "=-" * 6_000, "a-b" * 400, "你好" * 40_000, "x" * 400_000, "ab" * 300]
    began = time.process_time()
    e = pieces.encode_slice(tables, pa.array(texts), 4)
    took = time.process_time() - began
    for k, text in enumerate(texts):
        best = e.ids[e.bounds[k] : e.bounds[k + 1]].tolist()
        every = [pieces._changed(best, c) for c in e.changes[k]]
        assert len({tuple(x) for x in every}) == len(every) == len(e.scores[k]) == (1 if "你" in text else 4)
        assert all(pieces.decoded(tables, x) == text for x in every)
        if len(text) < 2000:
            assert np.allclose(e.scores[k], plain_nbest(tables, text, 4), atol=1e-3)
    assert took < 60
    began = time.process_time()
    pieces.encode_slice(tables, pa.array(texts[:1]), 4)
    assert time.process_time() - began < 2


def test_long_chunks_score_as_short_ones(tables, monkeypatch):
    rnd = random.Random(9)
    texts = ["".join(rnd.choice("abcé你-") for _ in range(rnd.randint(1, 90))) for _ in range(60)]
    whole = pieces.encode_slice(tables, pa.array(texts), 4)
    monkeypatch.setattr(pieces, "LONG", 8)
    alone = pieces.encode_slice(tables, pa.array(texts), 4)
    assert whole.scores == alone.scores and whole.changes == alone.changes and (whole.ids == alone.ids).all()


def test_encode(spark, docs, tables):
    got = pieces.encode(docs, queries.PIECE_MODEL).select("doc.doc_id", "doc.text", "ids", "scores", "restored").collect()
    assert Counter((r.doc_id, r.text) for r in got) == Counter((r[0], r[1]) for r in brute.ROWS)
    assert all(r.restored and pieces.decoded(tables, r.ids) == (r.text or "") for r in got)
    assert {tuple(r.scores) for r in got if not r.text} == {(0.0,)}
    assert pieces.encode(docs.filter("false"), queries.PIECE_MODEL).count() == 0
    few = pieces.nbest(docs.filter("doc_id = 5"), queries.PIECE_MODEL, n=3).select("doc.text", "segmentations").collect()
    for r in few:
        assert len({tuple(s.ids) for s in r.segmentations}) == 3
        assert [s.score for s in r.segmentations] == sorted((s.score for s in r.segmentations), reverse=True)
        assert all(pieces.decoded(tables, s.ids) == r.text for s in r.segmentations)


# --- shards -----------------------------------------------------------------


def placed(table, count, **settings):
    return shards.sharded(table, count, **settings).select("doc.doc_id", "doc.text", "size", "shard", "slot").collect()


def test_shards(spark, docs):
    got = placed(docs, 4)
    assert Counter((r.doc_id, r.text) for r in got) == Counter((r[0], r[1]) for r in brute.ROWS)
    assert all(r.size == len((r.text or "").encode()) + 8 for r in got)
    for s in range(4):
        assert sorted(r.slot for r in got if r.shard == s) == list(range(sum(r.shard == s for r in got)))
    assert placed(docs.filter("false"), 4) == []


@pytest.mark.parametrize("part_bytes", [shards.PART_BYTES, 3000])
def test_shards_are_even_and_in_order(spark, part_bytes):
    rnd = random.Random(4)
    # Clustered, negative and far keys; one key holds a third of all rows.
    ids = [rnd.choice([rnd.randrange(50), -rnd.getrandbits(62), 10**18 + rnd.randrange(1000)]) for _ in range(2000)] + [7] * 1000
    rows = [(i, "x" * rnd.randrange(1, 80) + str(k)) for k, i in enumerate(ids)]
    got = placed(spark.createDataFrame(rows, "doc_id long, text string").repartition(4), 8, part_bytes=part_bytes)
    sizes = Counter()
    for r in got:
        sizes[r.shard] += r.size
    total = sum(sizes.values())
    assert len(sizes) == 8 and all(abs(n - total / 8) <= 2 * 90 + 0.002 * total for n in sizes.values())
    for a in range(7):
        assert max(r.doc_id for r in got if r.shard == a) <= min(r.doc_id for r in got if r.shard == a + 1)
    for s in range(8):
        mine = sorted((r for r in got if r.shard == s), key=lambda r: r.slot)
        assert [r.slot for r in mine] == list(range(len(mine)))
        if part_bytes == shards.PART_BYTES:
            assert [r.doc_id for r in mine] == sorted(r.doc_id for r in mine)


def test_parts_follow_each_other_in_key_order(spark):
    rnd = random.Random(8)
    rows = [(rnd.randrange(10**6), "x" * rnd.randrange(1, 80)) for _ in range(2000)]
    got = placed(spark.createDataFrame(rows, "doc_id long, text string").repartition(4), 3, part_bytes=4000)
    ordered = sorted(got, key=lambda r: (r.shard, r.slot))
    assert [r.doc_id for r in ordered] == sorted(r[0] for r in rows)


def test_rows_equal_in_key_and_text_are_split(spark):
    rows = [(None, None)] * 3000 + [(k, "x" * 12) for k in range(3000)]
    got = placed(spark.createDataFrame(rows, "doc_id long, text string").coalesce(2), 8)
    sizes = Counter()
    for r in got:
        sizes[r.shard] += r.size
    total = sum(sizes.values())
    assert len(got) == 6000 and len(sizes) == 8 and all(abs(n - total / 8) <= 40 for n in sizes.values())


# --- lengths ----------------------------------------------------------------


def test_lengths(spark, docs):
    import tiktoken

    vocabulary = lengths.ranks(spark, queries.RANKS)
    encoding = tiktoken.Encoding("own", pat_str=queries.SPLIT_PATTERN, mergeable_ranks=vocabulary.value, special_tokens={})
    each = sorted(len(encoding.encode_ordinary(t or "")) for _, t, *_ in brute.ROWS)
    hist = lengths.histogram(docs, lengths.encoded_length(F.col("text"), vocabulary, queries.SPLIT_PATTERN))
    rows = {r.context_limit: r for r in lengths.by_limit(hist).collect()}
    assert sorted(rows) == sorted(set(each))
    for limit, r in rows.items():
        assert (r.docs, r.tokens) == (each.count(limit), limit * each.count(limit))
        assert r.docs_longer == sum(n > limit for n in each)
        assert r.truncated_tokens == sum(min(n, limit) for n in each)
        assert r.lost_tokens == sum(each) - r.truncated_tokens
        assert each[r.first_rank - 1 : r.last_rank] == [limit] * r.docs
        assert (r.all_docs, r.all_tokens) == (len(each), sum(each))
    asked = lengths.at_limits(hist, [0, 5, 100, 10**9]).collect()
    assert {r.context_limit: (r.docs_longer, r.truncated_tokens) for r in asked} == {
        limit: (sum(n > limit for n in each), sum(min(n, limit) for n in each)) for limit in (0, 5, 100, 10**9)
    }
    shares = {r.share: r.length for r in lengths.quantiles(hist, [0.0, 0.5, 0.9, 1.0]).collect()}
    assert shares == {q: each[max(math.ceil(q * len(each)), 1) - 1] for q in (0.0, 0.5, 0.9, 1.0)}
    empty = lengths.histogram(docs.filter("false"), F.lit(0))
    assert lengths.by_limit(empty).count() == 0 and lengths.at_limits(empty, [3]).first().truncated_tokens == 0


# --- archives ---------------------------------------------------------------

NESTED = "x\r\nWARC/1.1\r\nWARC-Type: response\r\nContent-Length: 5\r\n\r\nhello\r\n\r\nWARC/1.1\r\n"


@pytest.fixture(scope="module")
def page_rows():
    rnd = random.Random(1)
    kinds = lambda i: rnd.choice(["", "<p>é</p>" * rnd.randint(0, 50), NESTED * rnd.randint(1, 3), None, "WARC/1.1\r\n", "\r\n\r\n", "same", f"u{i}"])
    rows = [(i, f"http://a/{i}", kinds(i)) for i in range(150)]
    return rows + [(7, "u", "same"), (7, "u", "same"), (None, "u", "same"), (500, None, "WARC/1.1\r\n\r\n\r\n" + NESTED), (501, "a\r\nb", "z" * 50_000)]


@pytest.mark.parametrize("split", ["128m", "5k"])
def test_warc(spark, tmp_path, page_rows, split):
    path = str(tmp_path / "warc")
    pages = spark.createDataFrame(page_rows, "page_id long, url string, html string").withColumn("digest", F.lit("x"))
    warc.write(pages.repartition(2), path)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", split)
    try:
        got = warc.records(spark, path).collect()
        blocks = warc.payloads(spark, path).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    first = {}
    for i, _, html in page_rows:
        if i is not None:
            first[html or ""] = min(first.get(html or "", i), i)
    want = []
    for i, _, html in page_rows:
        data, again = (html or "").encode(), i is not None and i > first[html or ""]
        digest = base64.b32encode(hashlib.sha1(data).digest()).decode()
        refers = f"<urn:x-page:{first[html or '']}>" if again else None
        want.append((f"<urn:x-page:{'' if i is None else i}>", len(data), digest, "revisit" if again else "response", refers))
    assert Counter((r.record_id, r.payload_bytes, r.payload_digest, r.type, r.refers_to) for r in got) == Counter(want)
    held = Counter(r.block.partition("\r\n\r\n")[2] for r in blocks if r.record_id != "<urn:x-page:>")
    assert set(held) == {h or "" for _, _, h in page_rows}


def test_warc_files_are_archives(spark, tmp_path):
    path = tmp_path / "warc"
    warc.write(spark.createDataFrame([(1, "http://a", "é")], "page_id long, url string, html string"), str(path))
    data = b"".join(p.read_bytes() for p in sorted(path.glob("part-*")))
    head, _, rest = data.partition(b"\r\n\r\n")
    length = int(head.split(b"Content-Length: ")[-1].split(b"\r\n")[0])
    assert head.startswith(b"WARC/1.1\r\nWARC-Type: response\r\n")
    assert rest[length:] == b"\r\n\r\n" and rest[:length].endswith("é".encode())
    none = str(tmp_path / "none")
    warc.write(spark.createDataFrame([], "page_id long, url string, html string"), none)
    assert warc.records(spark, none).count() == 0


def test_what_the_chain_does_not_reach_is_no_record(spark, tmp_path):
    record = lambda name, body: f"WARC/1.1\r\nWARC-Type: resource\r\nWARC-Record-ID: {name}\r\nContent-Length: {len(body)}\r\n\r\n{body}\r\n\r\n"
    inner = record("<fake>", "abc")
    folder = tmp_path / "w"
    folder.mkdir()
    (folder / "a.warc").write_bytes((record("<one>", "1") + record("<two>", inner + inner) + record("<three>", "")).encode())
    (folder / "b.warc").write_bytes((record("<four>", "4") + "damage" + record("<lost>", "5")).encode())
    got = {r.record_id: r.payload_bytes for r in warc.records(spark, str(folder)).collect()}
    assert got == {"<one>": 1, "<two>": 2 * len(inner), "<three>": 0, "<four>": 1}
