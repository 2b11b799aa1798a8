"""Versioned state in buckets, for results that are kept up to date batch by batch.

A state is a set of Parquet rows dealt to numbered buckets.  A batch reads the buckets that it
touches, writes them anew under its own version, and leaves all others where they are; a manifest
(one row per bucket) says which version holds each bucket.  The commit row is written last: a batch
that fails leaves nothing that is read, and one that is replayed gives the same version again.  One
writer at a time; readers see the newest committed version as a whole.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetlake.sources.tables import read_if_exists

MANIFEST_SCHEMA = "bucket long, at long"


class BucketState:
    """Tables under ``root``: bucketed ones with a manifest, and small ones that are written whole."""

    def __init__(self, root: str):
        self.root = root.rstrip("/")

    # -- versions
    def newest(self, spark: SparkSession) -> dict | None:
        """{version, **marks} of the newest commit; None before the first."""
        commits = read_if_exists(spark, f"{self.root}/commits", "marks map<string,long>, version long")
        row = None if commits is None else commits.orderBy(F.col("version").desc()).first()
        return None if row is None else {"version": row["version"], **(row["marks"] or {})}

    def commit(self, spark: SparkSession, version: int, marks: dict[str, int]) -> None:
        """The version becomes the newest; ``marks`` says how far its sources are applied."""
        row = spark.createDataFrame([(marks,)], "marks map<string,long>")
        row.coalesce(1).write.mode("overwrite").parquet(f"{self.root}/commits/version={version}")

    # -- bucketed tables
    def manifest(self, spark: SparkSession, name: str, version: int | None) -> DataFrame:
        """(bucket, at): the version that holds each bucket, as of ``version``."""
        if version is None:
            return spark.createDataFrame([], MANIFEST_SCHEMA)
        return spark.read.schema(MANIFEST_SCHEMA).parquet(f"{self.root}/{name}/manifest/version={version}")

    def read(self, spark: SparkSession, name: str, schema: str, version: int | None, buckets: DataFrame | None = None) -> DataFrame:
        """Rows of the buckets (all, or those of ``buckets``) as of ``version``.  The list of places is
        metadata: at most one path a bucket; rows of other buckets are not read."""
        held = self.manifest(spark, name, version)
        if buckets is not None:
            held = held.join(buckets.select("bucket").distinct(), "bucket", "left_semi")
        paths = [f"{self.root}/{name}/data/version={r['at']}/bucket={r['bucket']}" for r in held.collect()]
        if not paths:
            return spark.createDataFrame([], f"{schema}, bucket long")
        rows = spark.read.schema(f"{schema}, version long, bucket long").option("basePath", f"{self.root}/{name}/data").parquet(*paths)
        return rows.drop("version")

    def write(self, rows: DataFrame, name: str, version: int, before: int | None) -> DataFrame:
        """``rows`` (with their bucket) become the whole content of their buckets in ``version``;
        returns them as written."""
        spark = rows.sparkSession
        data = f"{self.root}/{name}/data"
        schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields if f.name != "bucket")
        rows.hint("rebalance", "bucket").write.mode("overwrite").partitionBy("bucket").parquet(f"{data}/version={version}")
        # a batch without rows writes no bucket folder
        found = spark.read.schema(f"{schema}, bucket long").parquet(f"{data}/version={version}")
        touched = found.select("bucket").distinct().withColumn("at", F.lit(version).cast("long"))
        kept = self.manifest(spark, name, before).join(touched, "bucket", "left_anti")
        kept.unionByName(touched).coalesce(1).write.mode("overwrite").parquet(f"{self.root}/{name}/manifest/version={version}")
        return found

    # -- small tables, written whole in every version
    def write_whole(self, rows: DataFrame, name: str, version: int) -> DataFrame:
        path = f"{self.root}/{name}/version={version}"
        rows.write.mode("overwrite").parquet(path)
        return rows.sparkSession.read.schema(rows.schema).parquet(path)

    def read_whole(self, spark: SparkSession, name: str, schema: str, version: int | None) -> DataFrame:
        if version is None:
            return spark.createDataFrame([], schema)
        return spark.read.schema(schema).parquet(f"{self.root}/{name}/version={version}")
