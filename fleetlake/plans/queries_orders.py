"""Linkage operators on the second parent/child pair of the given tables:
orders (parent, like telemetry) and lineitem (children, like manifests).
257 of 15,000 orders have no lines at sf0.01; an order has up to 13 lines,
so pair counts differ from row counts - the duplicate-manifest case at scale.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetlake.operators import linkage
from fleetlake.plans import reports
from fleetlake.plans.registry import register
from fleetlake.sources.fixtures import spread


def _parent(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = spread(spark.read.parquet(f"{sf_dir.rstrip('/')}/orders.parquet"))
    return o.select(
        F.col("o_orderkey").alias("event_id"),
        F.col("o_orderdate").cast("timestamp").alias("ingest_ts"),
        F.col("o_orderstatus").alias("status"),
    )


def _children(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = spread(spark.read.parquet(f"{sf_dir.rstrip('/')}/lineitem.parquet"))
    return li.select(
        F.col("l_orderkey").alias("event_id"),
        F.col("l_returnflag").alias("media_type"),
        F.col("l_shipdate").cast("timestamp").alias("ingest_ts"),
    )


_D_NOW = "(SELECT max(o_orderdate) FROM orders)"


@register(
    "order_line_linkage",
    f"""
SELECT *, round(cast(linked_count AS double) / greatest(telemetry_total, 1) * 100, 2) AS linkage_pct FROM (
SELECT (SELECT count(*) FROM orders) AS telemetry_total,
  (SELECT count(*) FROM lineitem) AS blob_total,
  (SELECT count(*) FROM orders o JOIN lineitem l ON o.o_orderkey = l.l_orderkey) AS linked_count,
  (SELECT count(*) FROM orders o WHERE NOT EXISTS (SELECT 1 FROM lineitem l WHERE l.l_orderkey = o.o_orderkey))
    AS telemetry_unlinked,
  (SELECT count(*) FROM lineitem l WHERE NOT EXISTS (SELECT 1 FROM orders o WHERE o.o_orderkey = l.l_orderkey))
    AS blob_orphans,
  (SELECT count(*) FROM orders o WHERE EXISTS (SELECT 1 FROM lineitem l WHERE l.l_orderkey = o.o_orderkey))
    AS linked_events,
  (SELECT nullif(round(max((epoch_us({_D_NOW}) - epoch_us(o.o_orderdate)) / 1000000.0), 1), 0)
     FROM orders o WHERE NOT EXISTS (SELECT 1 FROM lineitem l WHERE l.l_orderkey = o.o_orderkey))
    AS oldest_unlinked_sec)
""",
)
def q_order_line_linkage(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = _parent(spark, sf_dir)
    now = p.agg(F.max("ingest_ts")).scalar()
    return linkage.linkage_counts(p, _children(spark, sf_dir), now=now)


@register(
    "order_line_breakdown",
    """
SELECT l.l_returnflag AS media_type, count(*) AS cnt
FROM lineitem l JOIN orders o ON o.o_orderkey = l.l_orderkey GROUP BY l.l_returnflag
""",
)
def q_order_line_breakdown(spark: SparkSession, sf_dir: str) -> DataFrame:
    return linkage.media_breakdown(_parent(spark, sf_dir), _children(spark, sf_dir))


@register(
    "order_line_leftjoin_rate",
    """
SELECT count(*) AS total_telemetry, count(l.l_orderkey) AS linked,
  round(cast(count(l.l_orderkey) AS double) / nullif(count(*), 0) * 100, 2) AS linkage_pct
FROM orders o LEFT JOIN lineitem l ON o.o_orderkey = l.l_orderkey
""",
)
def q_order_line_leftjoin_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return linkage.linkage_rate_leftjoin(_parent(spark, sf_dir), _children(spark, sf_dir))


@register(
    "order_line_unlinked_by_status",
    """
SELECT status AS device_id, count(*) AS unlinked FROM (
  SELECT o.o_orderstatus AS status FROM orders o
  WHERE NOT EXISTS (SELECT 1 FROM lineitem l WHERE l.l_orderkey = o.o_orderkey))
GROUP BY status ORDER BY unlinked DESC, device_id LIMIT 10
""",
)
def q_order_line_unlinked_by_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J10 keyed by order status (the parent's grouping column)."""
    p = _parent(spark, sf_dir).withColumnRenamed("status", "device_id")
    return linkage.unlinked_by_device(p, _children(spark, sf_dir), 10)


@register(
    "order_line_reconcile",
    f"""
SELECT *, CASE WHEN linkage_pct >= 95.0 THEN 'HEALTHY' ELSE 'DEGRADED' END AS status FROM (
SELECT telemetry_total, blob_total, linked_count, telemetry_unlinked, blob_orphans,
  round(cast(linked_count AS double) / greatest(telemetry_total, 1) * 100, 2) AS linkage_pct, media_breakdown
FROM (SELECT (SELECT count(*) FROM orders) AS telemetry_total, (SELECT count(*) FROM lineitem) AS blob_total,
  (SELECT count(*) FROM orders o JOIN lineitem l ON o.o_orderkey = l.l_orderkey) AS linked_count,
  (SELECT count(*) FROM orders o WHERE NOT EXISTS (SELECT 1 FROM lineitem l WHERE l.l_orderkey = o.o_orderkey))
    AS telemetry_unlinked,
  (SELECT count(*) FROM lineitem l WHERE NOT EXISTS (SELECT 1 FROM orders o WHERE o.o_orderkey = l.l_orderkey))
    AS blob_orphans,
  (SELECT cast(to_json(map_from_entries(list(struct_pack(k := media_type, v := cnt) ORDER BY cnt DESC, media_type))) AS varchar)
     FROM (SELECT l.l_returnflag AS media_type, count(*) AS cnt FROM lineitem l
           JOIN orders o ON o.o_orderkey = l.l_orderkey GROUP BY 1)) AS media_breakdown))
""",
)
def q_order_line_reconcile(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = _parent(spark, sf_dir)
    rep = reports.reconcile_report(p, _children(spark, sf_dir), p.agg(F.max("ingest_ts")).scalar())
    return rep.select(
        "telemetry_total",
        "blob_total",
        "linked_count",
        "telemetry_unlinked",
        "blob_orphans",
        "linkage_pct",
        F.to_json("media_breakdown").alias("media_breakdown"),
        "status",
    )
