"""Event beacons: normalise, identities, alerts, counts and funnels.

The functions hold no state, so they run on batch and streaming tables alike.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark import fixed
from tidemark.functions import jsons, times
from tidemark.operators import keyed


def drop_bots(envelopes: DataFrame) -> DataFrame:
    """Requests whose user agent does not name a bot; no user agent counts as ''."""
    agent = F.coalesce("ua", F.lit(""))
    return envelopes.withColumn("ua", agent).filter(~F.col("ua").rlike(fixed.BOT_PATTERN))


def envelope_events(
    envelopes: DataFrame, keep: Sequence[str], limit: int = fixed.BATCH_EVENTS
) -> DataFrame:
    """One row per event of a request body, an object or an array: ``pos``, ``event``.

    The limit on a request applies before any event is checked. A body that
    is not JSON has no events.
    """
    text = F.coalesce(F.nullif("body", F.lit("")), F.lit("{}"))
    parsed = envelopes.withColumn("_body", F.try_parse_json(text))
    items = F.col("_body").try_cast("array<variant>")
    batch = F.when(items.isNotNull(), F.slice(items, 1, limit)).otherwise(F.array("_body"))
    return parsed.select(*keep, F.posexplode_outer(batch).alias("pos", "event")).filter(
        F.col("event").isNotNull()
    )


def normalise(
    envelopes: DataFrame, keep: Sequence[str] = (), limit: int = fixed.BATCH_EVENTS, with_raw: bool = False
) -> DataFrame:
    """Request envelopes (``ua, country, received_at, body``) to event rows.

    ``keep`` names further envelope columns to carry along. ``with_raw`` adds
    ``raw``: the fields of an alert as they were sent, which the size guard on
    ``props`` may remove from there.
    """
    rows = envelope_events(
        drop_bots(envelopes), [*keep, "ua", "country", "received_at"], limit
    )
    event = F.col("event")
    props = F.to_json(F.try_variant_get(event, "$.props", "variant"))
    context = F.to_json(F.try_variant_get(event, "$.ctx", "variant"))
    # Paths into a value that is no object find nothing, so such a user id is NULL.
    user = F.coalesce(jsons.truthy_field(event, "props.userId"), jsons.truthy_field(event, "user_id"))
    fields = rows.select(
        *keep,
        "pos",
        jsons.text_field(event, "app", fixed.APP_CHARS).alias("app"),
        jsons.text_field(event, "event", fixed.NAME_CHARS).alias("event"),
        jsons.text_field(event, "distinct_id", fixed.NAME_CHARS).alias("distinct_id"),
        F.left(user, F.lit(fixed.NAME_CHARS)).alias("user_id"),
        F.left(jsons.truthy_field(event, "session_id"), F.lit(fixed.NAME_CHARS)).alias("session_id"),
        times.event_time(event, "ts", F.col("received_at")).alias("ts"),
        "received_at",
        F.coalesce(props, F.lit("{}")).alias("props"),
        F.coalesce(context, F.lit("{}")).alias("ctx"),
        "country",
        F.left("ua", F.lit(fixed.UA_CHARS)).alias("ua"),
        *[_alert_fields(event).alias("raw") for _ in range(int(with_raw))],
    )
    required = reduce(and_, (F.col(c) != "" for c in ("app", "event", "distinct_id")))
    return fields.filter(required).withColumns(
        {c: jsons.guarded_object(F.col(c)) for c in ("props", "ctx")}
    )


def _alert_fields(event: Column) -> Column:
    return F.struct(*[F.try_variant_get(event, f"$.props.{name}", "string").alias(name) for name in ("pkg", "amount", "userId")])


def identity_batch(
    events: DataFrame, order: Sequence[str], identify: str = fixed.IDENTIFY
) -> DataFrame:
    """Last user and first arrival per (app, distinct_id) among the identify events."""
    rows = events.filter((F.col("event") == identify) & F.col("user_id").isNotNull())
    return rows.groupBy("app", "distinct_id").agg(
        F.max_by("user_id", F.struct(*order)).alias("user_id"),
        F.min("received_at").alias("first_seen"),
    )


def upsert_identities(identities: DataFrame, batch: DataFrame) -> DataFrame:
    """The latest user wins; ``first_seen`` of a known identity stays."""
    return keyed.upsert(identities, batch, ["app", "distinct_id"], ["user_id"])


def resolve(events: DataFrame, identities: DataFrame) -> DataFrame:
    """Events with ``person``: their own user, else the mapped one, else NULL."""
    known = identities.select("app", "distinct_id", F.col("user_id").alias("_mapped"))
    person = F.coalesce("user_id", "_mapped")
    return events.join(known, ["app", "distinct_id"], "left").withColumn("person", person).drop("_mapped")


def alerts(events: DataFrame, keep: Sequence[str] = (), purchase: str = fixed.PURCHASE) -> DataFrame:
    """Alert text for every purchase event, from events normalised ``with_raw`` fields."""
    field = lambda name, missing: F.coalesce(F.col(f"raw.{name}"), F.lit(missing))
    text = F.format_string(
        fixed.ALERT_FORMAT, F.col("app"), field("pkg", "?"), field("amount", "?"), field("userId", "anon")
    )
    return events.filter(F.col("event") == purchase).select(*keep, "app", "distinct_id", text.alias("message"))


def counts(events: DataFrame, unit: str = "day") -> DataFrame:
    """Events per app, event and UTC time unit."""
    at = F.date_trunc(unit, times.utc_clock(F.col("ts")))
    return events.groupBy("app", "event", at.alias("at")).agg(
        F.count("*").alias("n")
    )


def funnel(
    events: DataFrame,
    steps: Sequence[str] = fixed.FUNNEL_STEPS,
    person: str | Column = "person",
) -> DataFrame:
    """People per app who reached each step no earlier than the step before.

    One conditional minimum per step and person: partial aggregates shrink
    the events of a busy person before the shuffle, and no sort is needed.
    """
    person = F.col(person) if isinstance(person, str) else person
    firsts = [F.min(F.when(F.col("event") == s, F.col("ts"))).alias(f"t{i}") for i, s in enumerate(steps)]
    people = (
        events.filter(F.col("event").isin(list(steps)))
        .groupBy("app", person.alias("person"))
        .agg(*firsts)
    )
    reached = []
    condition = F.lit(True)
    for i in range(len(steps)):
        at = F.col(f"t{i}")
        condition = condition & (at.isNotNull() if i == 0 else at >= F.col(f"t{i - 1}"))
        reached.append(F.count_if(condition).alias(f"n{i}"))
    wide = people.groupBy("app").agg(*reached)
    entries = F.array(
        *[F.struct(F.lit(i).alias("step"), F.lit(s).alias("event"), F.col(f"n{i}").alias("people")) for i, s in enumerate(steps)]
    )
    return wide.select("app", F.explode(entries).alias("_e")).select("app", "_e.*")
