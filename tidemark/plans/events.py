"""Registered queries over the event table, in batch and as streams."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.functions import jsons, times
from tidemark.operators import events as ev
from tidemark.plans.inputs import table
from tidemark.sources.workdir import new_dir
from tidemark.streaming import events as stream

# Requests hold as many events as are read of one; a longer one shows where reading ends.
EVENTS_PER_REQUEST, LONG_REQUEST = 50, 60
STEPS = ("signup", "view", "click", "purchase")
AGENTS = ("Mozilla/5.0 (X11)", None, "Googlebot/2.1", "curl/8.5", "okhttp/4.12")


def _ms(ts):
    return F.floor(F.unix_micros(times.as_utc(ts)) / 1000).cast("bigint").cast("string")


def _bodies(events):
    """Every event as the JSON a page would send; only sign-ups and purchases know the user."""
    user = F.concat(F.lit("u"), (F.col("user_id") % 7).cast("string"), F.lit("-"), (F.col("event_id") % 5).cast("string"))
    cents = F.round(F.col("value") * 100).cast("bigint").cast("string")
    props = F.when(
        F.col("event_type") == "purchase",
        # Some purchases are too large for the props that are kept.
        F.concat(
            F.lit('{"amount":'), cents, F.lit(',"pkg":"pack"'),
            F.when(F.col("event_id") % 97 == 0, F.concat(F.lit(',"pad":"'), F.repeat(F.lit("x"), F.lit(9000)), F.lit('"'))).otherwise(""),
            F.lit("}"),
        ),
    ).otherwise(F.col("props"))
    body = F.concat(
        F.lit('{"app":"app'), (F.col("user_id") % 3).cast("string"),
        F.lit('","event":"'), F.col("event_type"),
        F.lit('","distinct_id":"d'), F.col("user_id").cast("string"),
        F.lit('","session_id":'), (F.col("event_id") % 4).cast("string"),
        F.when(F.col("event_type").isin("signup", "purchase"), F.concat(F.lit(',"user_id":"'), user, F.lit('"'))).otherwise(""),
        F.lit(',"ts":'), _ms(F.col("ts")),
        F.lit(',"props":'), props,
        F.lit(',"ctx":[1]}'),
    )
    return events.select("event_id", "ts", body.alias("body"))


def _agent(number):
    return F.get(F.lit([a or "" for a in AGENTS]), (number % len(AGENTS)).cast("int"))


def _envelopes(spark, sf_dir, size=EVENTS_PER_REQUEST):
    """Requests of up to ``size`` events each, in event order."""
    bodies = _bodies(table(spark, sf_dir, "events"))
    request = F.floor(F.col("event_id") / size).cast("bigint")
    entry = F.struct("event_id", "body")
    grouped = bodies.groupBy(request.alias("request")).agg(
        F.array_sort(F.collect_list(entry)).alias("entries"),
        F.max(times.as_utc(F.col("ts"))).alias("received_at"),
    )
    body = F.concat(F.lit("["), F.array_join(F.col("entries.body"), ","), F.lit("]"))
    agent = _agent(F.col("request"))
    return grouped.select(
        "request",
        F.nullif(agent, F.lit("")).alias("ua"),
        F.lit("KR").alias("country"),
        "received_at",
        body.alias("body"),
    )


def _normalised(spark, sf_dir, with_raw=False):
    return ev.normalise(_envelopes(spark, sf_dir), ["request"], with_raw=with_raw)


def _plain(rows):
    """Instants as epoch microseconds, so that no time zone is involved in a comparison."""
    instants = [c for c, t in rows.dtypes if t == "timestamp"]
    return rows.withColumns({c: F.unix_micros(c) for c in instants})


def events_normalise(spark, sf_dir):
    """Requests of sixty events, of which fifty are read."""
    rows = ev.normalise(_envelopes(spark, sf_dir, LONG_REQUEST), ["request"])
    return _plain(rows.withColumn("pos", F.col("pos").cast("bigint")))


def event_json_guard(spark, sf_dir):
    """Which documents would fit into an event, as its props."""
    docs = table(spark, sf_dir, "documents")
    json = F.to_json(F.struct("text"))
    return docs.select(
        "doc_id",
        jsons.rendered_length(json).cast("bigint").alias("n_chars"),
        (jsons.guarded_object(json) == "{}").alias("emptied"),
    )


def _identities(events):
    """Identities of the earlier requests, and those of the later ones written over them."""
    at = F.unix_micros("received_at")
    half = events.agg(F.avg(at)).scalar()
    order = ["received_at", "request", "pos"]
    known, batch = (ev.identity_batch(events.filter(part), order, "signup") for part in (at < half, at >= half))
    return ev.upsert_identities(known, batch)


def identities(spark, sf_dir):
    return _plain(_identities(_normalised(spark, sf_dir)))


def events_resolved(spark, sf_dir):
    events = _normalised(spark, sf_dir)
    rows = ev.resolve(events, _identities(events))
    return rows.select("request", F.col("pos").cast("bigint").alias("pos"), "app", "distinct_id", "person")


def purchase_alerts(spark, sf_dir):
    rows = ev.alerts(_normalised(spark, sf_dir, with_raw=True), ["request", "pos"])
    return rows.select("request", F.col("pos").cast("bigint").alias("pos"), "message")


def event_counts(spark, sf_dir):
    rows = ev.counts(_normalised(spark, sf_dir))
    return rows.withColumn("at", F.date_format("at", "yyyy-MM-dd"))


def event_funnel(spark, sf_dir):
    """Whole event table: people per app who went from step to step."""
    events = table(spark, sf_dir, "events").select(
        F.concat(F.lit("app"), (F.col("user_id") % 3).cast("string")).alias("app"),
        F.col("event_type").alias("event"),
        F.col("user_id").alias("person"),
        "ts",
    )
    return ev.funnel(events, STEPS)


def _stream_envelopes(spark, sf_dir):
    """The event table as a stream of requests with one event each."""
    schema = table(spark, sf_dir, "events").schema
    events = spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(sf_dir)
    bodies = _bodies(events)
    return bodies.select(
        "event_id",
        F.nullif(_agent(F.col("event_id")), F.lit("")).alias("ua"),
        F.lit("KR").alias("country"),
        times.as_utc(F.col("ts")).alias("received_at"),
        "body",
    )


def stream_events(spark, sf_dir):
    path = new_dir(spark, "stream")
    rows = _stream_envelopes(spark, sf_dir)
    stream.append_events(rows, f"{path}/out", f"{path}/state", keep=["event_id"]).awaitTermination()
    out = spark.read.parquet(f"{path}/out")
    return _plain(out.select("event_id", "app", "event", "distinct_id", "user_id", "session_id", "ts", "props", "ctx", "ua"))


def stream_alerts(spark, sf_dir):
    path = new_dir(spark, "stream")
    rows = _stream_envelopes(spark, sf_dir)
    stream.append_alerts(rows, f"{path}/out", f"{path}/state", keep=["event_id"]).awaitTermination()
    return spark.read.parquet(f"{path}/out").select("event_id", "message")


def stream_identities(spark, sf_dir):
    path = new_dir(spark, "stream")
    rows = _stream_envelopes(spark, sf_dir)
    stream.maintain_identities(
        rows, f"{path}/out", f"{path}/state",
        order=["received_at", "event_id", "pos"], keep=["event_id"], identify="signup",
    ).awaitTermination()
    return _plain(stream.read_identities(spark, f"{path}/out"))


QUERIES = {
    f.__name__: f
    for f in (
        events_normalise, event_json_guard, identities, events_resolved, purchase_alerts,
        event_counts, event_funnel, stream_events, stream_alerts, stream_identities,
    )
}

# The wire form of every event, as columns, and which requests are kept.
_SENT = """sent AS (
  SELECT event_id, event_id // 60 AS request, event_id % 60 AS pos, ts AS arrived,
         'app' || user_id % 3 AS app, event_type AS event, 'd' || user_id AS distinct_id,
         CASE WHEN event_type IN ('signup', 'purchase') THEN 'u' || user_id % 7 || '-' || event_id % 5 END AS user_id,
         CASE WHEN event_id % 4 <> 0 THEN (event_id % 4)::VARCHAR END AS session_id,
         epoch_us(ts) // 1000 * 1000 AS ts,
         CASE WHEN event_type = 'purchase' AND event_id % 97 = 0 THEN '{}'
              WHEN event_type = 'purchase' THEN '{"amount":' || round(value * 100)::BIGINT || ',"pkg":"pack"}'
              ELSE replace(props, ' ', '') END AS props,
         '{}' AS ctx, round(value * 100)::BIGINT AS cents
  FROM events)"""
_AGENT = "CASE {n} % 5 WHEN 0 THEN 'Mozilla/5.0 (X11)' WHEN 1 THEN '' WHEN 4 THEN 'okhttp/4.12' END"
_BATCHED = f"""{_SENT.replace('60', str(EVENTS_PER_REQUEST))}, batched AS (
  SELECT *, epoch_us(max(arrived) OVER (PARTITION BY request)) AS received_at, 'KR' AS country,
         {_AGENT.format(n='request')} AS ua
  FROM sent WHERE request % 5 NOT IN (2, 3))"""
_CUT = f"""{_SENT}, kept AS (
  SELECT *, epoch_us(max(arrived) OVER (PARTITION BY request)) AS received_at, 'KR' AS country,
         {_AGENT.format(n='request')} AS ua
  FROM sent WHERE request % 5 NOT IN (2, 3)),
batched AS (SELECT * FROM kept WHERE pos < 50)"""
_MAPPED = """mapped AS (
  SELECT app, distinct_id, arg_max(user_id, (received_at, request, pos)) AS user_id,
         min(received_at) AS first_seen
  FROM batched WHERE event = 'signup' GROUP BY app, distinct_id)"""
_STREAMED = f"streamed AS (SELECT *, {_AGENT.format(n='event_id')} AS ua FROM sent WHERE event_id % 5 NOT IN (2, 3))"
_ALERT = "'💰 **결제** `' || app || '` — pack / ' || cents || '원 (user anon)' AS message"

ORACLES = {
    "events_normalise": f"""WITH {_CUT} SELECT request, pos, app, event, distinct_id, user_id,
        session_id, ts, received_at, props, ctx, country, ua FROM batched""",
    "event_json_guard": """SELECT doc_id, n_chars, n_chars > 8000 AS emptied FROM (
        SELECT doc_id, length('{"text": ') + 1 + length(to_json(text)::VARCHAR)
          + 5 * len(regexp_extract_all(text, '[^\\x00-\\x7f]'))
          + 6 * len(regexp_extract_all(text, '[\\x{10000}-\\x{10ffff}]')) AS n_chars FROM documents)""",
    "identities": f"WITH {_BATCHED}, {_MAPPED} SELECT app, distinct_id, user_id, first_seen FROM mapped",
    "events_resolved": f"""WITH {_BATCHED}, {_MAPPED} SELECT request, pos, b.app, b.distinct_id,
        coalesce(b.user_id, m.user_id) AS person
        FROM batched b LEFT JOIN mapped m ON m.app = b.app AND m.distinct_id = b.distinct_id""",
    "purchase_alerts": f"WITH {_BATCHED} SELECT request, pos, {_ALERT} FROM batched WHERE event = 'purchase'",
    "event_counts": f"""WITH {_BATCHED} SELECT app, event, strftime(make_timestamp(ts), '%Y-%m-%d') AS at,
        count(*) AS n FROM batched GROUP BY ALL""",
    "event_funnel": """WITH people AS (
          SELECT 'app' || user_id % 3 AS app, user_id, min(ts) FILTER (event_type = 'signup') AS t0,
                 min(ts) FILTER (event_type = 'view') AS t1, min(ts) FILTER (event_type = 'click') AS t2,
                 min(ts) FILTER (event_type = 'purchase') AS t3 FROM events GROUP BY ALL),
        wide AS (SELECT app, count(t0) AS n0, count(*) FILTER (t0 <= t1) AS n1,
                 count(*) FILTER (t0 <= t1 AND t1 <= t2) AS n2,
                 count(*) FILTER (t0 <= t1 AND t1 <= t2 AND t2 <= t3) AS n3 FROM people GROUP BY app)
        SELECT app, 0 AS step, 'signup' AS event, n0 AS people FROM wide
        UNION ALL SELECT app, 1, 'view', n1 FROM wide
        UNION ALL SELECT app, 2, 'click', n2 FROM wide
        UNION ALL SELECT app, 3, 'purchase', n3 FROM wide""",
    "stream_events": f"""WITH {_SENT}, {_STREAMED} SELECT event_id, app, event, distinct_id, user_id, session_id,
        ts, props, ctx, ua FROM streamed""",
    "stream_alerts": f"""WITH {_SENT}, {_STREAMED} SELECT event_id, {_ALERT} FROM streamed
        WHERE event = 'purchase'""",
    "stream_identities": f"""WITH {_SENT}, {_STREAMED} SELECT app, distinct_id,
        arg_max(user_id, (arrived, event_id)) AS user_id, epoch_us(min(arrived)) AS first_seen
        FROM streamed WHERE event = 'signup' GROUP BY app, distinct_id""",
}
