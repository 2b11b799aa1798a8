"""Validation rules: order, exact text, bounds, NULL/NaN, broken input."""

import json

import pytest

from fleetlake.functions.rules import WIRE_DEVICE_ID
from fleetlake.operators import validate


def _good(**over):
    rec = {
        "event_id": "device-042:s-1:000000000001",
        WIRE_DEVICE_ID: "device-042",
        "session_id": "s-1",
        "event_ts_edge_ms": 1700000000000,
        "sensor_type": "imu",
        "joint_angle": 0.5,
        "force_x": 1.0,
        "force_z": -1.0,
        "torque": 10.0,
        "temperature": 30.0,
    }
    rec.update(over)
    return {k: v for k, v in rec.items() if v is not ...}


def _run(spark, records, fn=validate.validate_telemetry):
    lines = [r if isinstance(r, str) else json.dumps(r) for r in records]
    df = spark.createDataFrame([(x,) for x in lines], "value string")
    return [(r["is_valid"], list(r["errors"])) for r in fn(df).collect()]


def test_valid_record(spark):
    assert _run(spark, [_good()]) == [(True, [])]


@pytest.mark.parametrize(
    "field,value,ok",
    [
        ("temperature", -40.0, True),
        ("temperature", 150.0, True),
        ("temperature", -40.01, False),
        ("temperature", 150.5, False),
        ("torque", 0.0, True),
        ("torque", 300.0, True),
        ("torque", -0.5, False),
        ("torque", 300.25, False),
        ("joint_angle", 6.3, True),
        ("joint_angle", -6.3, True),
        ("joint_angle", 6.31, False),
        ("force_x", 500.0, True),
        ("force_x", -500.0, True),
        ("force_z", -500.5, False),
    ],
)
def test_bounds_inclusive(spark, field, value, ok):
    (valid, errors), = _run(spark, [_good(**{field: value})])
    assert valid is ok
    if not ok:
        assert errors == [f"{field}_out_of_range:{value!r}"]


def test_null_readings_pass(spark):
    rec = _good(temperature=None, torque=None, joint_angle=None, force_x=None)
    assert _run(spark, [rec]) == [(True, [])]


def test_integer_reading_prints_as_int(spark):
    assert _run(spark, [_good(temperature=200)]) == [(False, ["temperature_out_of_range:200"])]


def test_large_float_prints_like_python(spark):
    (_, errors), = _run(spark, [_good(temperature=12345678.5), _good(torque=1e20)])[:1]
    assert errors == ["temperature_out_of_range:12345678.5"]
    (_, errors), = _run(spark, [_good(torque=1e20)])
    assert errors == [f"torque_out_of_range:{1e20!r}"]


def test_missing_fields_stop_early(spark):
    rec = _good(event_id=..., sensor_type="bogus", temperature=999.0)
    assert _run(spark, [rec]) == [(False, ["missing_field:event_id"])]
    rec = _good(**{WIRE_DEVICE_ID: None, "session_id": None})
    assert _run(spark, [rec]) == [(False, [f"missing_field:{WIRE_DEVICE_ID}", "missing_field:session_id"])]


def test_broken_json_reports_all_required(spark):
    (valid, errors), = _run(spark, ['{"event_id": "a:b:c", "device'])
    assert not valid
    assert errors == [f"missing_field:{validate.wire_name(f)}" for f in validate.rules.REQUIRED_TELEMETRY_FIELDS]


def test_bad_type_and_order(spark):
    rec = _good(event_ts_edge_ms="later", sensor_type="sonar", temperature=-50.0, event_id="a:b")
    (valid, errors), = _run(spark, [rec])
    assert not valid
    assert errors == [
        "bad_type:event_ts_edge_ms:expected_numeric",
        "invalid_sensor_type:sonar",
        "temperature_out_of_range:-50.0",
        "malformed_event_id:a:b",
    ]


@pytest.mark.parametrize("eid,ok", [("a:b:c", True), ("a:b", False), ("a:b:c:d", False), ("a:b:", True)])
def test_colon_count(spark, eid, ok):
    (valid, _), = _run(spark, [_good(event_id=eid)])
    assert valid is ok


def test_nan_rejected(spark):
    line = json.dumps(_good()).replace('"temperature": 30.0', '"temperature": NaN')
    (valid, errors), = _run(spark, [line])
    assert not valid and errors == ["temperature_out_of_range:nan"]


def test_extra_field_ignored(spark):
    assert _run(spark, [_good(extra_field=5)]) == [(True, [])]


def _manifest(**over):
    rec = {
        "event_id": "device-001:s-1:000000000001",
        WIRE_DEVICE_ID: "device-001",
        "session_id": "s-1",
        "media_type": "camera_rgb",
        "blob_uri": "s3://raw-blobs/blob/x.bin",
        "blob_ts_edge_ms": 1700000000000,
        "object_size": 10,
        "checksum_sha256": "a" * 64,
        "etag": "e",
        "quality_state": "INGESTED",
    }
    rec.update(over)
    return rec


@pytest.mark.parametrize(
    "over,errors",
    [
        ({}, []),
        ({"checksum_sha256": "a" * 63}, ["bad_checksum_length:63"]),
        ({"checksum_sha256": "a" * 65}, ["bad_checksum_length:65"]),
        ({"blob_uri": "http://raw-blobs/blob/abcdefgh.bin"}, ["bad_blob_uri_scheme:" + "http://raw-blobs/blob/abcdefgh.bin"[:20]]),
        ({"media_type": "thermal"}, ["invalid_media_type:thermal"]),
        ({"blob_ts_edge_ms": "soon"}, ["bad_type:blob_ts_edge_ms:expected_numeric"]),
        ({"checksum_sha256": None}, ["missing_field:checksum_sha256"]),
    ],
)
def test_manifest_rules(spark, over, errors):
    (valid, got), = _run(spark, [_manifest(**over)], validate.validate_manifest)
    assert got == errors and valid is (not errors)


def test_reject_counts_and_split(spark):
    recs = [_good(), _good(temperature=500.0), _good(event_id=...), _good(temperature=500.0, torque=-1.0)]
    df = spark.createDataFrame([(json.dumps(r),) for r in recs], "value string")
    v = validate.validate_telemetry(df)
    counts = {r["error_kind"]: r["n_records"] for r in validate.reject_counts(v).collect()}
    assert counts == {
        "_sent": 4,
        "_rejected": 3,
        "temperature_out_of_range": 2,
        "torque_out_of_range": 1,
        "missing_field:event_id": 1,
    }
    ok, bad = validate.split_valid(v)
    assert ok.count() == 1 and bad.count() == 3
    assert "errors" not in ok.columns and "errors" in bad.columns


def test_a_sites_own_name_of_the_device_field(spark):
    from fleetlake.operators.validate import validate_telemetry
    from fleetlake.schemas import TELEMETRY_SCHEMA
    from fleetlake.sources.topics import decode_payload

    record = _good()
    record["unit"] = record.pop(WIRE_DEVICE_ID)
    df = spark.createDataFrame([(json.dumps(record),), ("{}",)], "value string")
    good, bad = sorted(validate_telemetry(df, device_field="unit").collect(), key=lambda r: not r["is_valid"])
    assert good["device_id"] == "device-042" and good["is_valid"]
    assert "missing_field:unit" in bad["errors"]
    assert decode_payload(df, TELEMETRY_SCHEMA, device_field="unit").first()["device_id"] == "device-042"
