import json
import random
from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F

from tidemark import fixed
from tidemark.functions import jsons, times
from tidemark.operators import events as ev
from tidemark.streaming import events as stream

SCHEMA = "n int, ua string, country string, received_at string, body string"
NOW = "2024-05-01T12:00:00Z"


def envelopes(spark, bodies, ua="Mozilla"):
    rows = []
    for n, body in enumerate(bodies):
        agent, text = body if isinstance(body, tuple) else (ua, body)
        rows.append((n, agent, "KR", NOW, text if text is None or isinstance(text, str) else json.dumps(text)))
    df = spark.createDataFrame(rows, SCHEMA)
    return df.withColumn("received_at", F.col("received_at").cast("timestamp"))


def event(**fields):
    return {"app": "a", "event": "open", "distinct_id": "d", "ts": 0, **fields}


def normalised(spark, bodies, **kw):
    return ev.normalise(envelopes(spark, bodies, **kw), ["n"]).orderBy("n", "pos").collect()


def test_bots_are_dropped(spark):
    agents = ["Googlebot", "my-CRAWLer", "HeadlessChrome", "python-requests", "WhatsApp/2", "Mozilla", "", None]
    rows = normalised(spark, [(a, event()) for a in agents])
    assert [r.n for r in rows] == [5, 6, 7] and rows[2].ua == ""


def test_bodies(spark):
    bodies = [
        [event(event="a"), event(event="b")], event(), "not json", "5", "[]", "", None, '["x", 1, null]',
        [5, event(event="c")], "{}",
    ]
    rows = normalised(spark, bodies)
    assert [(r.n, r.pos, r.event) for r in rows] == [(0, 0, "a"), (0, 1, "b"), (1, 0, "open"), (8, 1, "c")]


def test_limit_comes_before_checks(spark):
    body = [{"app": ""}] * 50 + [event()]
    assert normalised(spark, [body]) == []
    assert len(normalised(spark, [[event()] * 60])) == 50


def test_required_fields_and_cuts(spark):
    bodies = [
        event(app=""), event(event=None), {"app": "a", "event": "e"}, event(distinct_id=7),
        event(app="x" * 100, event="y" * 200, distinct_id="z" * 200, user_id="u" * 200, session_id="s" * 200),
    ]
    rows = normalised(spark, bodies, ua="Moz" + "i" * 400)
    assert [(r.n, r.distinct_id[:1]) for r in rows] == [(3, "7"), (4, "z")]
    sizes = [len(v) for v in (rows[1].app, rows[1].event, rows[1].distinct_id, rows[1].user_id, rows[1].session_id, rows[1].ua)]
    assert sizes == [64, 128, 128, 128, 128, 256]


def test_user_falls_through(spark):
    cases = [
        (event(props={"userId": "p"}, user_id="u"), "p"),
        (event(props={"userId": ""}, user_id="u"), "u"),
        (event(props={"userId": 0}, user_id="u"), "u"),
        (event(props={"userId": 0.0}, user_id=5), "5"),
        (event(props={"userId": False}, user_id="u"), "u"),
        (event(props={"userId": "0"}, user_id="u"), "0"),
        (event(props={"userId": None}), None),
        (event(props=[1], user_id="u"), "u"),
        (event(user_id=""), None),
    ]
    rows = normalised(spark, [c for c, _ in cases])
    assert [r.user_id for r in rows] == [w for _, w in cases]


def test_times(spark):
    cases = [
        (event(ts=1700000000123), 1700000000123000),
        (event(ts="1700000000123.5"), 1700000000123500),
        ({"app": "a", "event": "e", "distinct_id": "d"}, 0),
    ]
    now = int(datetime(2024, 5, 1, 12, tzinfo=timezone.utc).timestamp() * 1e6)
    cases += [(event(ts=bad), now) for bad in (None, "soon", 1e30, -1e30, [1])]
    for zone in ("UTC", "America/New_York"):
        spark.conf.set("spark.sql.session.timeZone", zone)
        try:
            df = ev.normalise(envelopes(spark, [c for c, _ in cases]), ["n"]).orderBy("n")
            assert [r[0] for r in df.select(F.unix_micros("ts")).collect()] == [w for _, w in cases]
        finally:
            spark.conf.unset("spark.sql.session.timeZone")


def test_json_guard(spark):
    rng = random.Random(2)
    alphabet = 'ab"\\,:{}[]é한😀\n '
    values = [{}, {"a": 1, "b": [1, 2, {"c": None}]}]
    for _ in range(60):
        text = lambda: "".join(rng.choice(alphabet) for _ in range(rng.randrange(12)))
        values.append({text(): text(), text(): [text(), rng.randrange(9), True], text(): {text(): None}})
    df = spark.createDataFrame([(json.dumps(v, ensure_ascii=False),) for v in values], "s string")
    got = [r[0] for r in df.select(jsons.rendered_length(F.to_json(F.parse_json("s")))).collect()]
    assert got == [len(json.dumps(v)) for v in values]

    fits = '{"a":"%s"}' % ("x" * (8000 - len('{"a": ""}')))
    over = '{"a":"%s"}' % ("x" * (8001 - len('{"a": ""}')))
    wide = '{"a":"%s"}' % ("한" * 1400)
    cases = {fits: fits, over: "{}", wide: "{}", "[1]": "{}", "5": "{}", '"s"': "{}"}
    df = spark.createDataFrame([(c,) for c in cases], "s string")
    assert [r[0] for r in df.select(jsons.guarded_object(F.col("s"))).collect()] == list(cases.values())


def test_props_and_context(spark):
    rows = normalised(spark, [event(props={"k": 1}, ctx={"z": "y"}), event(props=[1], ctx=5), event()])
    assert [(r.props, r.ctx) for r in rows] == [('{"k":1}', '{"z":"y"}'), ("{}", "{}"), ("{}", "{}")]


def test_identities(spark):
    bodies = [
        event(event="$identify", user_id="u1"), event(event="$identify", user_id="u2"),
        event(event="$identify"), event(event="open", user_id="u3"),
        event(event="$identify", distinct_id="e", user_id="u4"),
    ]
    rows = ev.normalise(envelopes(spark, bodies), ["n"])
    batch = ev.identity_batch(rows, ["n", "pos"])
    assert sorted((r.distinct_id, r.user_id) for r in batch.collect()) == [("d", "u2"), ("e", "u4")]
    known = spark.createDataFrame([("a", "d", "old", "2020-01-01"), ("a", "f", "f1", "2020-01-01")],
                                  "app string, distinct_id string, user_id string, first_seen string")
    known = known.withColumn("first_seen", F.col("first_seen").cast("timestamp"))
    table = ev.upsert_identities(known, batch)
    got = {r.distinct_id: (r.user_id, r.first_seen.year) for r in table.collect()}
    assert got == {"d": ("u2", 2020), "e": ("u4", 2024), "f": ("f1", 2020)}
    people = ev.resolve(rows, table).orderBy("n").collect()
    assert [r.person for r in people] == ["u1", "u2", "u2", "u3", "u4"]


def test_alerts(spark):
    big = {"pkg": "big", "amount": 7, "pad": "x" * 9000}
    bodies = [
        event(event="purchase", props={"pkg": "gold", "amount": 5000, "userId": "u"}), event(event="purchase"), event(),
        event(event="purchase", props=big),
    ]
    rows = ev.alerts(ev.normalise(envelopes(spark, bodies), ["n"], with_raw=True), ["n"]).orderBy("n").collect()
    assert [r.message for r in rows] == [
        "\U0001F4B0 **결제** `a` — gold / 5000원 (user u)",
        "\U0001F4B0 **결제** `a` — ? / ?원 (user anon)",
        # The guard empties the props of this one, its alert is whole.
        "\U0001F4B0 **결제** `a` — big / 7원 (user anon)",
    ]


def test_funnel(spark):
    steps = fixed.FUNNEL_STEPS
    rows = [("a", "x", s, i) for i, s in enumerate(steps)]
    rows += [("a", "y", "signup", 5), ("a", "y", "activate", 1), ("a", "z", "activate", 1), ("a", None, "other", 1)]
    df = spark.createDataFrame(rows, "app string, person string, event string, ts int")
    got = [tuple(r) for r in ev.funnel(df).orderBy("step").collect()]
    assert got == [("a", 0, "signup", 2), ("a", 1, "activate", 1), ("a", 2, "app_open", 1), ("a", 3, "purchase", 1)]


def test_counts(spark):
    rows = ev.normalise(envelopes(spark, [[event(), event()], event(ts=86_400_000)]))
    assert sorted(r.n for r in ev.counts(rows).collect()) == [1, 2]


@pytest.fixture
def landed(spark, tmp_path):
    """Three landing files, read one per micro-batch."""
    path = str(tmp_path / "in")
    for n in range(3):
        bodies = [
            [event(event="$identify", distinct_id=f"d{i % 4}", user_id=f"u{n}-{i}"), event(event="purchase", distinct_id=f"d{i}")]
            for i in range(5)
        ] + [("bot", event())]
        df = envelopes(spark, bodies).withColumn("n", F.col("n") + n * 100)
        df.withColumn("received_at", F.col("received_at") + F.make_dt_interval(F.lit(0), F.lit(n))).coalesce(1).write.mode("append").parquet(path)

    def read():
        schema = spark.read.parquet(path).schema
        return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(path)

    return path, read


def key(rows):
    return sorted(map(str, rows))


def test_stream_equals_batch(spark, tmp_path, landed):
    path, read = landed
    batch = ev.normalise(spark.read.parquet(path), ["n"])
    out, state = str(tmp_path / "out"), str(tmp_path / "state")
    for _ in range(2):
        stream.append_events(read(), out, state, keep=["n"]).awaitTermination()
    stored = spark.read.parquet(out)
    assert {str(r.day) for r in stored.select("day").collect()} == {"1970-01-01"}
    assert key(stored.select(batch.columns).collect()) == key(batch.collect())
    stream.append_alerts(read(), str(tmp_path / "alerts"), str(tmp_path / "s2"), keep=["n"]).awaitTermination()
    assert key(spark.read.parquet(str(tmp_path / "alerts")).collect()) == key(ev.alerts(ev.normalise(spark.read.parquet(path), ["n"], with_raw=True), ["n"]).collect())


def test_identity_stream_and_replay(spark, tmp_path, landed):
    path, read = landed
    want = ev.identity_batch(ev.normalise(spark.read.parquet(path), ["n"]), ["received_at", "n", "pos"])
    root = str(tmp_path / "ids")
    assert stream.read_identities(spark, root).count() == 0
    run = lambda state: stream.maintain_identities(
        read(), root, str(tmp_path / state), order=["received_at", "n", "pos"], keep=["n"]
    ).awaitTermination()
    run("a")
    columns = ["app", "distinct_id", "user_id", "first_seen"]
    assert key(stream.read_identities(spark, root).select(columns).collect()) == key(want.select(columns).collect())
    # A new state folder applies every batch again, on top of what is already there.
    run("b")
    assert key(stream.read_identities(spark, root).select(columns).collect()) == key(want.select(columns).collect())
    # Folding the changes keeps the table, and later changes go on top.
    stream.compact_identities(spark, root)
    assert key(stream.read_identities(spark, root).select(columns).collect()) == key(want.select(columns).collect())
    run("c")
    assert key(stream.read_identities(spark, root).select(columns).collect()) == key(want.select(columns).collect())


def test_identities_survive_a_new_checkpoint(spark, tmp_path):
    root, schema = str(tmp_path / "ids"), "n long, ua string, country string, received_at timestamp, body string"

    def run(state, rows):
        path = str(tmp_path / f"in-{state}")
        for k, (who, user) in enumerate(rows):
            envelopes(spark, [event(event="$identify", distinct_id=who, user_id=user)]).write.mode("append").parquet(path)
        read = spark.readStream.schema(spark.read.parquet(path).schema).option("maxFilesPerTrigger", 1).parquet(path)
        stream.maintain_identities(read, root, str(tmp_path / state), order=["received_at", "pos"]).awaitTermination()

    run("a", [("d0", "u0"), ("d1", "u1"), ("d2", "u2")])
    run("b", [("d3", "u3"), ("d1", "new")])
    got = {r.distinct_id: r.user_id for r in stream.read_identities(spark, root).collect()}
    assert got == {"d0": "u0", "d1": "new", "d2": "u2", "d3": "u3"}


def test_local_days(spark):
    df = spark.createDataFrame([("2024-05-01T14:59:59Z",), ("2024-05-01T15:00:00Z",)], "s string")
    at = F.col("s").cast("timestamp")
    for zone in ("UTC", "America/New_York"):
        spark.conf.set("spark.sql.session.timeZone", zone)
        try:
            rows = df.select(times.local_day(at, "Asia/Seoul"), times.utc_day(at), times.utc_clock(at).cast("string")).collect()
            assert [str(r[0]) for r in rows] == ["2024-05-01", "2024-05-02"]
            assert [str(r[1]) for r in rows] == ["2024-05-01"] * 2
            assert rows[1][2] == "2024-05-01 15:00:00"
        finally:
            spark.conf.unset("spark.sql.session.timeZone")
