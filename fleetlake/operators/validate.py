"""Record validation as a Spark stage (schema + domain rules).

The reference validates each record in Python before sending it.  Here
the same rules, in the same order and with the same error text, are one
Catalyst expression per record: an ``array`` of ``when(violated, message)``
filtered for non-NULLs.  Nothing leaves the JVM.

Parsing is lenient: every field is first read as STRING, so a
non-numeric timestamp is reported as ``bad_type`` rather than silently
becoming NULL; typed columns are ``try_cast`` from the text.  Stated
differences from the Python validator: a quoted number (``"123"``) counts
as numeric; NaN readings are rejected (Python's comparisons let NaN pass);
a non-numeric reading is skipped instead of raising.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from fleetlake.functions import rules
from fleetlake.functions.ids import colon_count
from fleetlake.functions.pyfmt import py_number_repr
from fleetlake.schemas import MANIFEST_SCHEMA, TELEMETRY_SCHEMA, wire_name, wire_schema

RAW_PREFIX = "_raw_"
NUMERIC_TYPES = ("long", "double", "integer", "float")


def numeric_text(raw: Column) -> Column:
    """Text of a JSON number as read into a STRING field.  The non-numeric
    number tokens (NaN, Infinity) arrive quoted; unquote them."""
    return F.regexp_replace(raw, r'^"(NaN|[+-]?Infinity)"$', "$1")


def all_string(schema: StructType) -> StructType:
    return StructType([StructField(f.name, StringType(), True) for f in schema.fields])


def decode_lenient(df: DataFrame, schema: StructType, value_col: str = "value", device_field: str = rules.WIRE_DEVICE_ID) -> DataFrame:
    """Parse JSON once with every field as text; add typed columns by ``try_cast``.

    Output: typed columns (names of ``schema``) + ``_raw_<name>`` text columns.
    Broken JSON yields an all-NULL record (PERMISSIVE), like the reference.
    """
    keep = [c for c in df.columns if c != value_col]
    # The parse sits in a generator (inline_outer of a one-element array).
    # Filters on validation results (accepted / rejected split) reference
    # the generator's output and stay above it; pushed through a plain
    # projection they would inline from_json once per field reference.
    parsed = df.select(
        *keep,
        F.inline_outer(F.array(F.from_json(F.col(value_col).cast("string"), all_string(wire_schema(schema, device_field))))),
    )
    parsed = parsed.select(*keep, *[F.col(wire_name(f.name, device_field)).alias(RAW_PREFIX + f.name) for f in schema.fields])
    typed = [
        (numeric_text(_raw(f.name)) if f.dataType.typeName() in NUMERIC_TYPES else _raw(f.name))
        .try_cast(f.dataType)
        .alias(f.name)
        for f in schema.fields
    ]
    return parsed.select(*keep, *typed, *[_raw(f.name) for f in schema.fields])


def _errors(checks: list[tuple[Column, Column]]) -> Column:
    return F.filter(F.array(*[F.when(cond, msg) for cond, msg in checks]), lambda e: e.isNotNull())


def _raw(name: str) -> Column:
    return F.col(RAW_PREFIX + name)


def _staged(required: tuple[str, ...], domain: list[tuple[Column, Column]], device_field: str) -> tuple[Column, Column]:
    """(errors, is_valid).  ``is_valid`` is built from the rule conditions
    alone, so a filter on it (pushed down by Catalyst) stays a small
    boolean and never carries the message formatting."""
    missing_checks = [(_raw(f).isNull(), F.lit(f"missing_field:{wire_name(f, device_field)}")) for f in required]
    missing = _errors(missing_checks)
    errors = F.when(F.size(missing) > 0, missing).otherwise(_errors(domain))
    any_bad = F.lit(False)
    for cond, _ in missing_checks + domain:
        any_bad = any_bad | F.coalesce(cond, F.lit(False))
    return errors, ~any_bad


def _num(name: str) -> Column:
    return numeric_text(_raw(name)).try_cast("double")


def _out_of(name: str, lo: float | None, hi: float | None, absolute: bool = False) -> tuple[Column, Column]:
    v = _num(name)
    probe = F.abs(v) if absolute else v
    bad = F.lit(False)
    if lo is not None:
        bad = bad | (probe < lo)
    if hi is not None:
        bad = bad | (probe > hi)
    bad = v.isNotNull() & (bad | F.isnan(v))
    return bad, F.concat(F.lit(f"{name}_out_of_range:"), py_number_repr(_raw(name), v))


def telemetry_errors(device_field: str = rules.WIRE_DEVICE_ID) -> tuple[Column, Column]:
    """Ordered error list of a telemetry record (rules of ``rules``) and its validity flag."""
    sensor = _raw("sensor_type")
    eid = _raw("event_id")
    domain = [
        (_num("event_ts_edge_ms").isNull(), F.lit("bad_type:event_ts_edge_ms:expected_numeric")),
        (~sensor.isin(*rules.VALID_SENSOR_TYPES), F.concat(F.lit("invalid_sensor_type:"), sensor)),
        _out_of("temperature", rules.TEMP_MIN_C, rules.TEMP_MAX_C),
        _out_of("torque", rules.TORQUE_MIN_NM, rules.TORQUE_MAX_NM),
        _out_of("joint_angle", rules.JOINT_ANGLE_MIN, rules.JOINT_ANGLE_MAX),
        _out_of("force_x", None, rules.FORCE_MAX_N, absolute=True),
        _out_of("force_z", None, rules.FORCE_MAX_N, absolute=True),
        (colon_count(eid) != 2, F.concat(F.lit("malformed_event_id:"), eid)),
    ]
    return _staged(rules.REQUIRED_TELEMETRY_FIELDS, domain, device_field)


def manifest_errors(device_field: str = rules.WIRE_DEVICE_ID) -> tuple[Column, Column]:
    """Ordered error list of a blob manifest record and its validity flag."""
    media = _raw("media_type")
    checksum = _raw("checksum_sha256")
    uri = _raw("blob_uri")
    domain = [
        (~media.isin(*rules.VALID_MEDIA_TYPES), F.concat(F.lit("invalid_media_type:"), media)),
        (_num("blob_ts_edge_ms").isNull(), F.lit("bad_type:blob_ts_edge_ms:expected_numeric")),
        (
            F.length(checksum) != rules.CHECKSUM_HEX_LENGTH,
            F.concat(F.lit("bad_checksum_length:"), F.length(checksum).cast("string")),
        ),
        (~uri.startswith(rules.BLOB_URI_SCHEME), F.concat(F.lit("bad_blob_uri_scheme:"), F.substring(uri, 1, 20))),
    ]
    return _staged(rules.REQUIRED_MANIFEST_FIELDS, domain, device_field)


def _validate(df: DataFrame, schema: StructType, checks: tuple[Column, Column], value_col: str, device_field: str) -> DataFrame:
    errors, is_valid = checks
    dec = decode_lenient(df, schema, value_col, device_field)
    out = dec.withColumn("errors", errors).withColumn("is_valid", is_valid)
    return out.drop(*[RAW_PREFIX + f.name for f in schema.fields])


def validate_telemetry(df: DataFrame, value_col: str = "value", device_field: str = rules.WIRE_DEVICE_ID) -> DataFrame:
    """JSON messages -> typed telemetry columns + ``errors`` + ``is_valid``."""
    return _validate(df, TELEMETRY_SCHEMA, telemetry_errors(device_field), value_col, device_field)


def validate_manifest(df: DataFrame, value_col: str = "value", device_field: str = rules.WIRE_DEVICE_ID) -> DataFrame:
    """JSON messages -> typed manifest columns + ``errors`` + ``is_valid``."""
    return _validate(df, MANIFEST_SCHEMA, manifest_errors(device_field), value_col, device_field)


def split_valid(validated: DataFrame) -> tuple[DataFrame, DataFrame]:
    """K8: (accepted rows without the check columns, rejected rows with errors)."""
    ok = validated.filter(F.col("is_valid")).drop("is_valid", "errors")
    bad = validated.filter(~F.col("is_valid")).drop("is_valid")
    return ok, bad


def error_kind(e: Column) -> Column:
    """``missing_field:x`` / ``bad_type:x`` keep their field, other errors their rule name."""
    head = F.substring_index(e, ":", 1)
    return F.when(head.isin("missing_field", "bad_type"), F.substring_index(e, ":", 2)).otherwise(head)


def reject_counts(validated: DataFrame) -> DataFrame:
    """Per error kind, number of records with that error, plus totals.

    One aggregation: ``explode`` of each record's (bounded) error list,
    partial aggregation per kind.  Also emits ``_sent`` and ``_rejected``.
    """
    kinds = validated.select(
        F.explode(
            F.array_union(
                F.array(F.lit("_sent"), F.when(~F.col("is_valid"), F.lit("_rejected"))),
                F.transform("errors", error_kind),
            )
        ).alias("error_kind")
    ).filter(F.col("error_kind").isNotNull())
    return kinds.groupBy("error_kind").agg(F.count(F.lit(1)).alias("n_records"))
