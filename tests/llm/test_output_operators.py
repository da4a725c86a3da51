"""Fill-in-middle, hard negatives and token files against plain answers."""

import hashlib
import math
import random
import zlib

import brute
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tidemark.llm import fim, negatives, queries, token_files, words

TEXTS = [
    (1, None), (2, ""), (3, "a"), (None, "no id é"), (4, "has <P> inside"), (5, "<M>"), (6, "<S"), (7, "ends in <"),
    (8, "S>starts so"), (9, "日本語のテキスト🙂 mixed ascii"), (10, "éèê" * 50), (11, "🙂" * 1000), (12, "x" * 70_000 + "é" * 3000 + "y"),
    (13, "twice"), (13, "twice"), (-5, "negative id"), *[(100 + k, f"text {k} " + "ä€🙂z"[k % 4] * (k % 23)) for k in range(300)],
]


@pytest.fixture(scope="module")
def docs(spark):
    clash = {c: F.lit("x") for c in ("doc", "body", "form", "cut", "n", "output", "key", "tie", "place", "ids")}
    return spark.createDataFrame(TEXTS, "doc_id long, text string").withColumns(clash).repartition(3)


# --- fill-in-middle ---------------------------------------------------------


def plain_fim(doc_id, text):
    text, n = text or "", len(text or "")
    h = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[8 * k : 8 * k + 8], 16) for k in range(4))
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h3 % 100 >= 90:
        return doc_id, n, "plain", None, None, text
    if h4 % 100 < 20:
        return doc_id, n, "spm", a, b - a, f"<S>{text[b:]}<P>{text[:a]}<M>{text[a:b]}"
    return doc_id, n, "psm", a, b - a, f"<P>{text[:a]}<S>{text[b:]}<M>{text[a:b]}"


def test_fim(docs):
    made = fim.transformed(docs).select(
        "doc.doc_id", "n", "form", "prefix_chars", "middle_chars", "output", fim.restored(F.col("output"), F.col("form")).alias("text"), "doc.text"
    )
    made = [tuple(r) for r in made.collect()]
    assert sorted(map(repr, (r[:6] for r in made))) == sorted(repr(plain_fim(*r)) for r in TEXTS)
    assert all(r[6] == (r[7] or "") for r in made)
    assert {r[2] for r in made} == {"plain", "psm", "spm"}


def test_fim_of_nothing(docs):
    assert fim.transformed(docs.limit(0)).count() == 0


def test_fim_restores_whatever_the_cut():
    text = "<é<S🙂M>P>"
    for a in range(len(text) + 1):
        for b in range(a, len(text) + 1):
            x, y, z = text[:a], text[a:b], text[b:]
            for whole, order in ((f"<P>{x}<S>{z}<M>{y}", (1, 3, 2)), (f"<S>{z}<P>{x}<M>{y}", (2, 3, 1))):
                import re

                part = re.split("<P>|<S>|<M>", whole)
                assert len(part) == 4 and "".join(part[k] for k in order) == text


def test_exception_index():
    rng = random.Random(1)
    text = "".join(rng.choice("abé€\U0001f642") for _ in range(500))
    index = fim.Exceptions(np.frombuffer(text.encode(), np.uint8))
    bytes_at = np.array([len(text[:k].encode()) for k in range(501)])
    assert (index.bytes(np.arange(501)) == bytes_at).all() and (index.chars(bytes_at) == np.arange(501)).all()
    sliced = pa.array(["skip", None, text, ""]).slice(1)
    got = fim._cuts(sliced, np.array([[7, 100, 3], [1, 20, 9]])).to_pylist()
    assert got[1] == {"n": 500, "first": 20, "second": 100, "first_byte": bytes_at[20], "second_byte": bytes_at[100]}
    assert got[0]["n"] == got[2]["n"] == got[2]["second_byte"] == 0


# --- hard negatives ---------------------------------------------------------


def plain_negatives(vectors, is_anchor):
    """(anchor, positive, rank, negative, scores) of (id, label, vector) rows, by comparing everything."""
    kept = []
    for k, (i, label, v) in enumerate(vectors):
        if label is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        q = [math.floor(256 * x) for x in v]
        if sum(x * x for x in q) < 1 << 62:
            kept.append((k, i, label, q))
    score = lambda a, b: sum(x * y for x, y in zip(a[3], b[3]))
    order = lambda a: lambda r: (-score(a, r), r[1] is None, r[1] or 0, r[0])
    out = []
    for a in kept:
        if not is_anchor(a[1]):
            continue
        for p in sorted((r for r in kept if r[2] == a[2] and r[0] != a[0]), key=order(a))[:5]:
            s = score(a, p)
            fits = [r for r in kept if r[2] != a[2] and 50 * s <= 100 * score(a, r) <= 95 * s]
            out += [(a[1], p[1], k + 1, r[1], s, score(a, r)) for k, r in enumerate(sorted(fits, key=order(a))[:3])]
    return out


def clustered(rng, n, dim=12):
    centers = [[rng.gauss(0, 1) for _ in range(dim)] for _ in range(6)]
    for i in range(n):
        c = rng.choice(centers)
        yield i, rng.randrange(4), [x + rng.gauss(0, 0.3) for x in c]


def edge_rows():
    yield from [(1000, None, [1.0]), (1050, 1, None), (1100, 1, [None, 1.0]), (1150, 1, [float("nan")]), (1200, 2, [float("inf")])]
    yield from [(1250, 2, []), (1300, 2, [0.0] * 12), (1350, 3, [1e15] * 12), (1400, 3, [-1.0, 2.0]), (None, 1, [0.5] * 12), (None, 1, [0.5] * 12)]
    yield from [(1450, k % 2, [1.0, 1.0, 0.5]) for k in range(8)]  # repeated rows and ties
    yield from [(1500, 0, [3e5] * 12), (1501, 1, [2.1e5] * 12), (1502, 0, [2.9e5] * 12)]  # beyond 53 bits


SCHEMA = "vec_id long, label int, embedding array<double>"


@pytest.mark.parametrize("small", [False, True])
def test_hard_negatives(spark, monkeypatch, small):
    if small:
        for name, value in (("ROWS", 40), ("ANCHORS", 3), ("STRIP", 2), ("REFERENCES", 3)):
            monkeypatch.setattr(negatives, name, value)
    data = [*clustered(random.Random(7), 400), *edge_rows()]
    df = spark.createDataFrame(data, SCHEMA).withColumns({c: F.lit(1) for c in ("row", "q", "norm", "zone", "rank", "place")}).repartition(4)
    got = negatives.mine(df, F.col("vec_id") % 50 == 0, references=negatives.REFERENCES)
    want = plain_negatives(data, lambda i: i is not None and i % 50 == 0)
    assert sorted(map(repr, (tuple(r) for r in got.collect()))) == sorted(map(repr, want)) and len(want) > 50


def test_hard_negatives_of_nothing(spark):
    for data in ([], [(50, 1, [1.0])], [(50, 1, []), (51, 1, []), (52, 2, [])]):
        df = spark.createDataFrame(data, SCHEMA)
        got = [tuple(r) for r in negatives.mine(df, F.col("vec_id") % 50 == 0).collect()]
        assert got == plain_negatives(data, lambda i: i % 50 == 0)


def test_bounds_hold_every_score():
    rng = np.random.default_rng(3)
    q = np.floor(256 * np.concatenate([rng.normal(size=(60, 8)), rng.normal(size=(1, 8)) + rng.normal(size=(60, 8)) * 1e-3, np.zeros((1, 8))]))
    q = np.concatenate([q, q[:9], -q[:9] - 0.0]).astype(np.int64)
    norm = np.linalg.norm(q, axis=1)
    off = negatives.angles(q, norm, negatives.directions(q.astype(float), 5))
    low, high = negatives.bounds(off, norm, off, norm)
    exact = q @ q.T
    assert (low <= exact).all() and (exact <= high).all()
    # The references are some of the rows; against them the interval is the score, but for rounding.
    assert ((high - low).max(axis=0) < 3).sum() >= 5
    wanted = rng.random(exact.shape) < 0.05
    for largest in (1.0, float(1 << 60)):
        for w in (wanted, ~wanted):
            assert (negatives.scores(q, q, w, largest) == np.where(w, exact, 0)).all()


def test_far_blocks_are_not_met(spark, monkeypatch):
    """Two far clusters in blocks of their own: the cells of block pairs shrink."""
    monkeypatch.setattr(negatives, "ROWS", 50)
    rng = random.Random(2)
    data = [(i, i % 2, [(1 if i % 4 < 2 else -1) + rng.gauss(0, 0.01) for _ in range(4)]) for i in range(200)]
    seen = []
    met = negatives._met
    monkeypatch.setattr(negatives, "_met", lambda a, o, cells, *rest: seen.append((cells.count(), o)) or met(a, o, cells, *rest))
    got = negatives.mine(spark.createDataFrame(data, SCHEMA), F.col("vec_id") % 50 == 0, references=2)
    want = plain_negatives(data, lambda i: i % 50 == 0)
    assert sorted(tuple(r) for r in got.collect()) == sorted(want)
    cells, others = seen[-1]
    assert cells < others.select("r_block").distinct().count() * 2


# --- token files ------------------------------------------------------------

WORDY = [
    (5, "The quick, brown fox's den.\n\nIt isn't  far;  trailing  "), (4, "  leading and\ttabs\r\n and nbsp 　 wide"),
    (3, "don't we'll they're 'sup 3rd 42nd x1y2 snake_case a  b"), (2, "Größe œuvre naïve ×3 a×b c÷d Привет мир, да"),
    (1, "日本語 text 🙂🙂 end<|endoftext|> more"), (0, None), (-1, ""), (7, " "), (8, "\n\n\n"), (9, "a"), (None, "first"), (None, ""),
    (6, "same"), (6, "same"), (6, "other"), (10, "-" * 5000), (11, "word " * 20_000), (12, "é" * 3000 + " x"),
]


@pytest.fixture(scope="module")
def encode():
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(queries.TOKENIZER)
    return lambda text: tokenizer.encode(text or "", add_special_tokens=False).ids


def test_pieces_keep_the_encoding(encode):
    encoder = token_files.Encoder(open(queries.TOKENIZER, "rb").read())
    rng = random.Random(5)
    letters = "aZé ß×÷ 'st.,\n\t 0१你🙂 ́Ж-"
    texts = [t or "" for _, t in WORDY] + ["".join(rng.choice(letters) for _ in range(rng.randrange(60))) for _ in range(3000)]
    for _, _, data, bounds in words.slices(pa.array(texts)):
        ids, lengths = encoder.encode(data, bounds)
        cut = np.split(ids, np.cumsum(lengths)[:-1])
        assert [c.tolist() for c in cut] == [encode(t) for t in texts]


def test_a_task_forgets(encode, monkeypatch):
    monkeypatch.setattr(token_files, "KNOWN", 3)
    encoder = token_files.Encoder(open(queries.TOKENIZER, "rb").read())
    for text in ("one two three four five", "six two", "one six seven"):
        (_, _, data, bounds), = words.slices(pa.array([text]))
        assert encoder.encode(data, bounds)[0].tolist() == encode(text)


@pytest.mark.parametrize("part_bytes", [1 << 30, 2000])
def test_token_files(spark, tmp_path, encode, part_bytes):
    clash = {c: F.lit("x") for c in ("key", "body", "tie", "place", "part", "ids")}
    df = spark.createDataFrame(WORDY, "doc_id long, text string").withColumns(clash).repartition(3)
    path = str(tmp_path / "files")
    manifest = token_files.write(df, path, queries.TOKENIZER, 2, part_bytes=part_bytes).orderBy("part").collect()
    assert sum(r.docs for r in manifest) == len(WORDY) and (part_bytes > 2000 or len(manifest) > 5)
    got = token_files.read(spark, path, ids_at_once=500).orderBy("start").collect()
    want = [(i, encode(t) + [2]) for i, t in WORDY]
    key = lambda i: (i is not None, i or 0)
    assert [r.doc_id for r in got] == sorted((i for i, _ in want), key=key)
    at = 0
    for r in got:
        ids = np.frombuffer(r.ids, "<u4").tolist()
        assert (r.start, r.n_tokens) == (at, len(ids)) and (r.doc_id, ids) in want
        at += len(ids)
    assert sorted(map(repr, ((r.doc_id, np.frombuffer(r.ids, "<u4").tolist()) for r in got))) == sorted(map(repr, want))
    # The flat files alone, mapped, in the order of the manifest, are all ids.
    flat = [np.memmap(f"{path}/{r.name}.ids", "<u2", "r").tolist() if r.tokens else [] for r in manifest]
    assert sum(flat, []) == [x for r in got for x in np.frombuffer(r.ids, "<u4").tolist()]
    assert [r.base for r in manifest] == [sum(map(len, flat[:k])) for k in range(len(flat))]
    # Offsets are 64-bit and one more than documents.
    for r in manifest:
        ends = np.fromfile(f"{path}/{r.name}.ends", "<u8")
        assert len(ends) == r.docs + 1 and ends[-1] == r.tokens
    crc = spark.createDataFrame([(bytearray(np.array([7, 70000], "<u4").tobytes()),)], "ids binary").select(token_files.crc32(F.col("ids"))).first()[0]
    assert crc == zlib.crc32(np.array([7, 70000], "<u4").tobytes())


def test_no_documents(spark, tmp_path):
    path = str(tmp_path / "none")
    token_files.write(spark.createDataFrame([], "doc_id long, text string"), path, queries.TOKENIZER, 2)
    assert token_files.read(spark, path).count() == 0


def test_wide_ids(spark, tmp_path, encode):
    """An end id beyond 16 bits makes every id 32 bits wide."""
    path = str(tmp_path / "wide")
    token_files.write(spark.createDataFrame(WORDY[:5], "doc_id long, text string"), path, queries.TOKENIZER, 70_000)
    got = {r.doc_id: np.frombuffer(r.ids, "<u4").tolist() for r in token_files.read(spark, path).collect()}
    assert got == {i: encode(t) + [70_000] for i, t in WORDY[:5]}


def test_query_on_given_documents(spark, encode):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()
    got = queries.op13_token_files(spark, "/root/testdata/sf0.001").orderBy("start").collect()
    at, want = 0, []
    for r in sorted(docs, key=lambda r: r.doc_id):
        ids = encode(r.text) + [2]
        want.append((r.doc_id, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        at += len(ids)
    assert [tuple(r) for r in got] == want
    assert brute.ROWS
