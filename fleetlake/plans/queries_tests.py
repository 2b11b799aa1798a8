"""Registered data-test queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetlake.operators import datatests
from fleetlake.plans import silver
from fleetlake.plans.queries import _D_VALIDATED
from fleetlake.plans.registry import register
from fleetlake.sources.fixtures import Fixture, duckdb_with

_D_BLOB_LINKED = """
blob_linked AS (SELECT b.event_id FROM blob b JOIN telx t ON b.event_id = t.event_id)
"""


def _tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    f = Fixture(spark, sf_dir)
    tel, blobs = f.telemetry, f.blobs
    return {
        "telemetry_events": tel,
        "blob_index": blobs,
        "telemetry_validated": silver.telemetry_validated(tel),
        "blob_linked": silver.blob_linked(blobs, tel),
    }


def _d_test(table: str, column: str, test: str, failing: str) -> str:
    return (
        f"SELECT '{table}' AS table_name, '{column}' AS column_name, '{test}' AS test_name, "
        f"({failing}) AS failures"
    )


_D_RUN = " UNION ALL ".join(
    [
        _d_test("telemetry_events", "event_id", "not_null", "SELECT count(*) FROM telx WHERE event_id IS NULL"),
        _d_test("telemetry_events", "device_id", "not_null", "SELECT count(*) FROM telx WHERE device_id IS NULL"),
        _d_test(
            "telemetry_events",
            "event_ts_corrected",
            "not_null",
            "SELECT count(*) FROM telx WHERE event_ts_corrected IS NULL",
        ),
        _d_test("blob_index", "event_id", "not_null", "SELECT count(*) FROM blob WHERE event_id IS NULL"),
        _d_test("blob_index", "blob_uri", "not_null", "SELECT count(*) FROM blob WHERE blob_uri IS NULL"),
        _d_test(
            "blob_index", "checksum_sha256", "not_null", "SELECT count(*) FROM blob WHERE checksum_sha256 IS NULL"
        ),
        _d_test("telemetry_validated", "event_id", "not_null", "SELECT count(*) FROM validated WHERE event_id IS NULL"),
        _d_test(
            "telemetry_validated",
            "quality_flag",
            "accepted_values",
            "SELECT count(*) FROM validated WHERE quality_flag IS NOT NULL AND quality_flag NOT IN "
            "('VALID', 'TEMP_OUT_OF_RANGE', 'TORQUE_OUT_OF_RANGE', 'ANGLE_OUT_OF_RANGE')",
        ),
        _d_test("blob_linked", "event_id", "not_null", "SELECT count(*) FROM blob_linked WHERE event_id IS NULL"),
        _d_test(
            "blob_linked",
            "event_id",
            "unique",
            "SELECT count(*) FROM (SELECT event_id FROM blob_linked WHERE event_id IS NOT NULL "
            "GROUP BY event_id HAVING count(*) > 1)",
        ),
    ]
)


@register(
    "run_data_tests",
    duckdb_with(
        f"SELECT *, CASE WHEN failures = 0 THEN 'pass' ELSE 'fail' END AS status FROM ({_D_RUN})",
        _D_VALIDATED + "," + _D_BLOB_LINKED,
    ),
)
def q_run_data_tests(spark: SparkSession, sf_dir: str) -> DataFrame:
    return datatests.run_data_tests(_tables(spark, sf_dir))


@register(
    "check_unique_blob_linked",
    duckdb_with(
        "SELECT event_id, count(*) AS n_records FROM blob_linked WHERE event_id IS NOT NULL "
        "GROUP BY event_id HAVING count(*) > 1",
        _D_BLOB_LINKED,
    ),
)
def q_check_unique(spark: SparkSession, sf_dir: str) -> DataFrame:
    return datatests.check_unique(_tables(spark, sf_dir)["blob_linked"], "event_id")


@register(
    "check_accepted_values_sensor",
    duckdb_with(
        "SELECT sensor_type, count(*) AS n_rows FROM telx WHERE sensor_type IS NOT NULL AND sensor_type NOT IN "
        "('joint_state', 'force_torque', 'imu') GROUP BY sensor_type"
    ),
)
def q_check_accepted_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """D2 on a column that does fail: sensor types outside the domain."""
    bad = datatests.check_accepted_values(Fixture(spark, sf_dir).telemetry, "sensor_type", ("joint_state", "force_torque", "imu"))
    return bad.groupBy("sensor_type").agg(F.count(F.lit(1)).alias("n_rows"))


@register(
    "check_not_null_torque",
    duckdb_with("SELECT device_id, count(*) AS n_rows FROM telx WHERE torque IS NULL GROUP BY device_id"),
)
def q_check_not_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    """D1 on a column that does fail: readings without torque, per device."""
    bad = datatests.check_not_null(Fixture(spark, sf_dir).telemetry, "torque")
    return bad.groupBy("device_id").agg(F.count(F.lit(1)).alias("n_rows"))
