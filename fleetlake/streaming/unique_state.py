"""Uniqueness of a key kept up to date (D3): fingerprints of keys with their counts, in buckets.

A batch adds 64-bit fingerprints of its own keys to the buckets that they lie in; the tables' earlier
rows are not read again.  The result is read off a summary of a few numbers per bucket.  Two different
keys may share a fingerprint, so what the state tells are suspects; ``failing_keys`` compares those few in
full.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetlake.streaming.bucket_state import BucketState
from fleetlake.streaming.report_state import session_of

KEYS = "fingerprint long, n long"
SUMMARY = "bucket long, keys long, repeated long"


class UniqueState:
    def __init__(self, root: str, column: str, buckets: int = 4096, group: Callable[[Column], Column] = session_of):
        self.state = BucketState(root)
        self.column, self.buckets, self.group = column, buckets, group

    def _fingerprint(self) -> Column:
        return F.xxhash64(self.column)

    def apply(self, spark: SparkSession, rows: DataFrame) -> int:
        """Fold rows in (NULL keys are left out); returns the version."""
        before = (self.state.newest(spark) or {}).get("version")
        version = 0 if before is None else before + 1
        key = F.col(self.column)
        bucket = F.pmod(F.xxhash64(self.group(key.cast("string"))), F.lit(self.buckets)).cast("long").alias("bucket")
        delta = rows.filter(key.isNotNull()).select(bucket, self._fingerprint().alias("fingerprint")).groupBy("bucket", "fingerprint").agg(F.count(F.lit(1)).alias("n"))
        delta = self.state.write_whole(delta, "delta", version)
        touched = delta.select("bucket").distinct()
        both = self.state.read(spark, "keys", KEYS, before, touched).select("bucket", "fingerprint", "n").unionByName(delta)
        keys = self.state.write(both.groupBy("bucket", "fingerprint").agg(F.sum("n").alias("n")), "keys", version, before)
        now = keys.groupBy("bucket").agg(F.count(F.lit(1)).alias("keys"), F.count(F.when(F.col("n") > 1, 1)).alias("repeated"))
        kept = self.state.read_whole(spark, "summary", SUMMARY, before).join(touched, "bucket", "left_anti")
        self.state.write_whole(kept.unionByName(now).coalesce(1), "summary", version)
        self.state.commit(spark, version, {})
        return version

    def summary(self, spark: SparkSession) -> DataFrame:
        """(keys, repeated): distinct fingerprints and those that more than one row has."""
        s = self.state.read_whole(spark, "summary", SUMMARY, (self.state.newest(spark) or {}).get("version"))
        return s.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("keys", "repeated")])

    def suspects(self, spark: SparkSession) -> DataFrame:
        """Fingerprints that more than one row has; only buckets with such are read."""
        version = (self.state.newest(spark) or {}).get("version")
        hit = self.state.read_whole(spark, "summary", SUMMARY, version).filter("repeated > 0").select("bucket")
        return self.state.read(spark, "keys", KEYS, version, hit).filter("n > 1").select("fingerprint")

    def failing_keys(self, spark: SparkSession, table: DataFrame) -> DataFrame:
        """The rows of ``check_unique``: keys that occur more than once, with their count."""
        found = table.filter(F.col(self.column).isNotNull()).select(self.column, self._fingerprint().alias("fingerprint"))
        return found.join(self.suspects(spark), "fingerprint", "left_semi").groupBy(self.column).agg(F.count(F.lit(1)).alias("n_records")).filter("n_records > 1")
