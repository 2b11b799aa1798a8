"""Batch table access: scans, catalog listing, readiness probe, as-of reads,
window replay (S5, S6, S8-S11)."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetlake.functions.time import as_timestamp


def read_table(spark: SparkSession, name_or_path: str, fmt: str = "parquet") -> DataFrame:
    """Catalog table by name, or a path in ``fmt`` (column pruning and
    filter pushdown happen in the scan)."""
    if "/" in name_or_path or name_or_path.startswith("file:"):
        return spark.read.format(fmt).load(name_or_path)
    return spark.table(name_or_path)


def read_if_exists(spark: SparkSession, path: str, schema=None) -> DataFrame | None:
    """The Parquet table at ``path``, or None when there is no such path yet.
    Any other failure of the read is raised."""
    reader = spark.read.schema(schema) if schema is not None else spark.read
    try:
        return reader.parquet(path)
    except AnalysisException as exc:
        if exc.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def describe_columns(df: DataFrame) -> DataFrame:
    """``SHOW COLUMNS`` as a DataFrame (column_name, data_type, position)."""
    spark = df.sparkSession
    rows = [(f.name, f.dataType.simpleString(), i) for i, f in enumerate(df.schema.fields)]
    return spark.createDataFrame(rows, "column_name string, data_type string, position int")


def has_column(df: DataFrame, name: str) -> bool:
    return name in df.columns


def list_catalogs(spark: SparkSession) -> DataFrame:
    """``SHOW CATALOGS``."""
    return spark.sql("SHOW CATALOGS")


def list_schemas(spark: SparkSession) -> DataFrame:
    """``SHOW SCHEMAS``."""
    return spark.sql("SHOW SCHEMAS")


def list_tables(spark: SparkSession, schema: str | None = None) -> DataFrame:
    """``SHOW TABLES [IN schema]``."""
    return spark.sql(f"SHOW TABLES IN {schema}" if schema else "SHOW TABLES")


def table_ready(spark: SparkSession, name_or_path: str) -> bool:
    """The table exists and can be scanned (``SELECT 1 ... LIMIT 1``)."""
    try:
        if "/" not in name_or_path and not spark.catalog.tableExists(name_or_path):
            return False
        read_table(spark, name_or_path).limit(1).collect()
        return True
    except Exception:  # noqa: BLE001
        return False


def read_as_of(df: DataFrame, as_of, ts_col: str = "ingest_ts") -> DataFrame:
    """The table as it was at ``as_of``.

    For an append-only bronze table the snapshot at time t is exactly the
    rows with ``ingest_ts <= t``; the predicate is pushed into the scan.
    A table format with snapshots uses ``read_table_as_of`` instead.
    """
    return df.filter(F.col(ts_col) <= as_of_ts(as_of))


def read_table_as_of(spark: SparkSession, table: str, timestamp: str) -> DataFrame:
    """S11 for a table format with snapshots (Iceberg, Delta): time travel."""
    return spark.sql(f"SELECT * FROM {table} TIMESTAMP AS OF '{timestamp}'")


def as_of_ts(value):
    return as_timestamp(value)


def replay_window(
    decoded: DataFrame,
    start=None,
    end=None,
    hours_back: int | None = None,
    now=None,
    ts_ms_col: str = "event_ts_edge_ms",
) -> DataFrame:
    """Records whose edge time lies in the half-open window [start, end).

    ``start``/``end`` as timestamps; ``end`` defaults to ``now``; with
    ``hours_back`` the window is [now - hours, now).  The result goes
    through the same transform as the live stream and is appended.
    """
    now_c = as_timestamp(now) if now is not None else F.current_timestamp()
    end_c = as_timestamp(end) if end is not None else now_c
    if start is not None:
        start_c = as_timestamp(start)
    elif hours_back is not None:
        start_c = end_c - F.expr(f"INTERVAL {int(hours_back)} HOURS")
    else:
        raise ValueError("start or hours_back required")
    ms = F.col(ts_ms_col)
    return decoded.filter((ms >= F.unix_millis(start_c)) & (ms < F.unix_millis(end_c)))
