import json
import random

from pyspark.sql import functions as F

from tidemark.operators import chunking, ordered
from tidemark.sources import files

SCHEMA = "session int, seq int, role string, text string, turn_id string, ts string"


def plain_turns(messages):
    """(turn_id, user text, assistant text) by walking the kept messages once."""
    kept = [m for m in messages if m[2] in ("user", "assistant") and m[3].strip()]
    out = []
    for before, message, after in zip([None, *kept], kept, [*kept[1:], None]):
        if message[2] == "user":
            answer = after[3] if after and after[2] == "assistant" else ""
            out.append((message[4], message[3], answer))
        elif before is None or before[2] != "user":
            out.append((message[4], "", message[3]))
    return out


def sessions(seed, n_sessions=6, n_rows=60):
    rng = random.Random(seed)
    rows = []
    for s in range(n_sessions):
        for i in range(rng.randrange(n_rows)):
            role = rng.choice(["user", "user", "assistant", "assistant", "system"])
            text = rng.choice(["", "  ", "hi", "x" * 30, "word " * 20, "long " * 900])
            rows.append((s, i, role, text, f"{s}-{i}", None))
    return rows


def frame(spark, rows, per_bucket):
    df = spark.createDataFrame(rows, SCHEMA)
    return df.withColumn("bucket", ordered.bucket_of(F.col("seq"), per_bucket))


def test_pairing_does_not_depend_on_buckets(spark):
    rows = sessions(1)
    for per_bucket in (1, 3, 1000):
        got = chunking.pair_turns(frame(spark, rows, per_bucket)).collect()
        for s in range(6):
            mine = [r for r in sorted(got, key=lambda r: r.seq) if r.session == s]
            want = plain_turns([r for r in rows if r[0] == s])
            assert [(r.turn_id, r.user_text, r.assistant_text) for r in mine] == want


def plain_turn_chunks(turns):
    out = []
    for turn_id, user, assistant in turns:
        parts = [f"User: {user}"] if user else []
        parts += [f"Assistant: {assistant}"] if assistant else []
        body = "\n\n".join(parts).strip()
        starts = [0]
        while starts[-1] + 2000 < len(body):
            starts.append(starts[-1] + 1800)
        pieces = [p for p in (body[s : s + 2000].strip() for s in starts) if len(p) >= 50]
        for i, piece in enumerate(pieces):
            out.append((turn_id, i if len(body) > 2000 else None, piece))
    return out


def test_turn_chunks_are_dense(spark):
    rows = sessions(2)
    for per_bucket in (2, 1000):
        turns = chunking.pair_turns(frame(spark, rows, per_bucket))
        got = chunking.chunk_turns(turns).collect()
        for s in range(6):
            mine = sorted((r for r in got if r.session == s), key=lambda r: r.chunk_index)
            want = plain_turn_chunks(plain_turns([r for r in rows if r[0] == s]))
            assert [r.chunk_index for r in mine] == list(range(len(want)))
            assert [(r.turn_id, r.sub_chunk, r.text) for r in mine] == want


def test_session_titles(spark):
    rows = [
        (1, 0, "assistant", "hello", "a", None),
        (1, 1, "user", "  \n first line\nsecond", "b", None),
        (1, 2, "user", "later", "c", None),
        (2, 0, "assistant", "only me", "d", None),
    ]
    turns = chunking.pair_turns(frame(spark, rows, 1))
    got = {r.session: (r.title, r.turn_count) for r in chunking.session_titles(turns).collect()}
    assert got == {1: ("first line", 3), 2: ("(untitled session)", 1)}


def test_redaction_hits_are_summed(spark):
    secret = "sk-" + "A1" * 12
    rows = [(1, 0, "user", f"{secret} {secret}", "a", None), (1, 1, "assistant", secret, "b", None)]
    row = chunking.redact_turns(chunking.pair_turns(frame(spark, rows, 10))).first()
    assert row.hits == 3 and secret not in row.user_text + row.assistant_text


def line(kind, role, text, uuid):
    return json.dumps({"type": kind, "uuid": uuid, "timestamp": "t", "message": {"role": role, "content": text}})


def test_session_file_in_many_splits(spark, tmp_path):
    """A log that several tasks read still gives turns in line order."""
    rng = random.Random(4)
    rows, lines = [], []
    for i in range(400):
        role = rng.choice(["user", "assistant"])
        rows.append((0, i, role, f"text {i} " * 5, f"u{i}", None))
        lines.append(line(role, role, rows[-1][3], f"u{i}"))
        if i % 7 == 0:
            lines += ["", "   ", '{"broken":', "[1, 2", json.dumps({"type": "summary"})]
    (tmp_path / "s.jsonl").write_text("\r\n".join(lines))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        read = files.read_session_lines(spark, str(tmp_path))
        messages = files.session_messages(read)
        assert messages.rdd.getNumPartitions() > 4
        turns = chunking.pair_turns(messages)
        chunks = chunking.chunk_turns(turns).orderBy("chunk_index").collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert [(r.turn_id, r.sub_chunk, r.text) for r in chunks] == plain_turn_chunks(plain_turns(rows))
    assert [r.chunk_index for r in chunks] == list(range(len(chunks)))


def test_bad_bytes_are_replaced(spark, tmp_path):
    (tmp_path / "s.jsonl").write_bytes(
        b'{"type":"user","uuid":"a","message":{"role":"user","content":"caf\xff"}}\n'
    )
    row = files.session_messages(files.read_session_lines(spark, str(tmp_path))).first()
    assert row.text == "caf�" and row.ts is None
