"""Change-log decoding: text envelopes to typed rows with control columns."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyline.schema import (
    DELETED,
    EVENT_TIME,
    LOG_OFFSET,
    LOG_PARTITION,
    envelope_schema,
)


def parse_envelopes(
    changes: DataFrame, row: T.StructType, keys: Sequence[str], images: bool = False
) -> DataFrame:
    """Adds ``event``: the decoded ``payload`` struct, all NULL for unreadable text.

    With ``images`` the old image is read whole, not only its key.

    The struct leaves through ``inline`` so that filters on its fields stay
    above the parse.  As a plain projection the optimiser would push a copy of
    the parse into each such filter and every document would be read twice.
    """
    payload = F.from_json(F.col("value").cast("string"), envelope_schema(row, keys, images))
    event = F.struct(payload["payload"].alias("event"))
    return changes.select("*", F.inline(F.array(event)))


def _event_key(key: str) -> Column:
    # A delete has only an old image: its key must come from there.
    return F.coalesce(F.col(f"event.after.{key}"), F.col(f"event.before.{key}")).alias(key)


def flatten_events(parsed: DataFrame, row: T.StructType, keys: Sequence[str]) -> DataFrame:
    """Row columns plus ``_ts_ms, _partition, _offset, _deleted``.

    An event is an upsert when the new image has its first key field, a delete
    when only the old image has it; for anything else the keys are NULL.
    """
    lead = keys[0]
    deleted = F.col(f"event.before.{lead}").isNotNull() & F.col(f"event.after.{lead}").isNull()
    columns = [
        _event_key(f.name) if f.name in keys else F.col(f"event.after.{f.name}").alias(f.name)
        for f in row.fields
    ]
    return parsed.select(
        *columns,
        F.col("event.source.ts_ms").alias(EVENT_TIME),
        F.col("partition").cast("int").alias(LOG_PARTITION),
        F.col("offset").cast("bigint").alias(LOG_OFFSET),
        deleted.alias(DELETED),
    )


def keyed_events(parsed: DataFrame, row: T.StructType, keys: Sequence[str]) -> DataFrame:
    """Events of parsed records that name a whole key."""
    return flatten_events(parsed, row, keys).dropna(how="any", subset=list(keys))


def unkeyed_records(parsed: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Parsed records with a text but no whole key, as they came.

    Log tombstones have no text and are no errors.
    """
    complete = reduce(and_, [_event_key(key).isNotNull() for key in keys])
    rest = parsed.filter(F.col("value").isNotNull() & ~complete)
    return rest.select(F.col("value").cast("string").alias("value"), "partition", "offset")


def without_keyed_text(parsed: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Parsed records with their text only where it is a dead letter."""
    complete = reduce(and_, [_event_key(key).isNotNull() for key in keys])
    return parsed.withColumn("value", F.when(~complete, F.col("value")))


def decode_changes(changes: DataFrame, row: T.StructType, keys: Sequence[str]) -> DataFrame:
    """``(value, partition, offset)`` records to keyed events; unkeyed records drop out."""
    return keyed_events(parse_envelopes(changes, row, keys), row, keys)


def dead_letters(changes: DataFrame, row: T.StructType, keys: Sequence[str]) -> DataFrame:
    """Records :func:`decode_changes` drops, tombstones aside."""
    return unkeyed_records(parse_envelopes(changes, row, keys), keys)


def upserts(events: DataFrame) -> DataFrame:
    return events.filter(~F.col(DELETED))


def delete_keys(events: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Distinct keys that any event deletes, whatever came after."""
    return events.filter(F.col(DELETED)).select(*keys).distinct()


def star_after(changes: DataFrame, row: T.StructType, keys: Sequence[str]) -> DataFrame:
    """The new image alone, every field under its own name."""
    return parse_envelopes(changes, row, keys).select("event.after.*")
