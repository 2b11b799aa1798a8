"""Identifier and object-key formats."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from fleetlake.functions import rules


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def make_event_id(device_id: Column | str, session_id: Column | str, counter: Column | str) -> Column:
    """``{device_id}:{session_id}:{counter:012d}``."""
    return F.format_string("%s:%s:%012d", _c(device_id), _c(session_id), _c(counter).cast("long"))


def colon_count(event_id: Column | str) -> Column:
    """Number of ':' characters (``str.count(':')``)."""
    eid = _c(event_id)
    return F.length(eid) - F.length(F.regexp_replace(eid, ":", ""))


def parse_event_id(event_id: Column | str) -> Column:
    """Struct of the three parts; NULL parts when the id is malformed."""
    parts = F.split(_c(event_id), ":")
    ok = colon_count(event_id) == 2
    return F.when(
        ok,
        F.struct(
            F.try_element_at(parts, F.lit(1)).alias("device_id"),
            F.try_element_at(parts, F.lit(2)).alias("session_id"),
            F.try_element_at(parts, F.lit(3)).try_cast("long").alias("counter"),
        ),
    )


def device_number(device_id: Column | str) -> Column:
    """Integer after the first '-' of the id prefix; NULL if not numeric."""
    return F.try_element_at(F.split(_c(device_id), "-"), F.lit(2)).try_cast("int")


def device_shard(device_id: Column | str, shards: int = rules.DEVICE_SHARDS) -> Column:
    """Two-digit shard ``device_number % shards``."""
    return F.format_string("%02d", F.pmod(device_number(device_id), F.lit(shards)))


def blob_key(
    media_type: Column | str,
    ts: Column | str,
    device_id: Column | str,
    event_id: Column | str,
    shard_part: str = rules.BLOB_KEY_SHARD,
    device_part: str = rules.BLOB_KEY_DEVICE,
) -> Column:
    """Partitioned object key of a stored blob:

    ``blob/{media}/event_date=YYYY-MM-DD/event_hour=HH/<shard key>NN/<device key>{device}/{event_id}.bin``
    """
    t = _c(ts)
    return F.concat(
        F.lit("blob/"),
        _c(media_type),
        F.lit("/event_date="),
        F.date_format(t, "yyyy-MM-dd"),
        F.lit("/event_hour="),
        F.date_format(t, "HH"),
        F.lit(f"/{shard_part}"),
        device_shard(device_id),
        F.lit(f"/{device_part}"),
        _c(device_id),
        F.lit("/"),
        _c(event_id),
        F.lit(".bin"),
    )


def blob_uri(key: Column, bucket: str = rules.RAW_BUCKET) -> Column:
    return F.concat(F.lit(f"{rules.BLOB_URI_SCHEME}{bucket}/"), key)
