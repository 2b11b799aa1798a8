"""Progress of streams as a history (W5): every batch of every query, written where all can read it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

from fleetlake.sources.tables import read_if_exists

HISTORY = "kind string, name string, id string, runId string, batchId long, timestamp string, numInputRows long, inputRowsPerSecond double, processedRowsPerSecond double, batchDuration long, durationMs map<string,long>, stateOperators array<struct<operatorName:string,numRowsTotal:long,numRowsUpdated:long,memoryUsedBytes:long>>, sources array<struct<description:string,numInputRows:long>>, exception string"


class ProgressHistory(StreamingQueryListener):
    """Writes one JSON record per batch (and one per end of a query) below ``root``, a path that pyarrow's
    file systems open.  A record's name is its run and batch, so one that is told twice is written
    once; a trigger without data does not replace the record of the batch before it.  These are
    small records of the driver's own metadata, no rows of data."""

    def __init__(self, root: str):
        from pyarrow import fs

        uri = "file://" + root if root.startswith("/") else root
        self._fs, self._base = fs.FileSystem.from_uri(uri)
        self._fs.create_dir(self._base, recursive=True)

    def _write(self, day: str, name: str, line: str, replace: bool) -> None:
        from pyarrow import fs

        folder = f"{self._base}/day={day}"
        path = f"{folder}/{name}.json"
        if not replace and self._fs.get_file_info(path).type != fs.FileType.NotFound:
            return
        self._fs.create_dir(folder, recursive=True)
        with self._fs.open_output_stream(path) as out:
            out.write((line + "\n").encode("utf-8"))

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        import json

        p = json.loads(event.progress.json)
        record = json.dumps({"kind": "progress", **p})
        self._write(p["timestamp"][:10], f"{p['runId']}-{p['batchId']:012d}", record, replace=p["numInputRows"] > 0)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        import datetime as dt
        import json

        now = dt.datetime.now(dt.timezone.utc).strftime("%Y-%m-%dT%H:%M:%SZ")
        record = {"kind": "terminated", "id": str(event.id), "runId": str(event.runId), "timestamp": now, "exception": event.exception}
        self._write(now[:10], f"{event.runId}-end", json.dumps(record), replace=True)


def start_history(spark: SparkSession, root: str) -> ProgressHistory:
    """Record the progress of all queries of the session; ``spark.streams.removeListener`` ends it."""
    listener = ProgressHistory(root)
    spark.streams.addListener(listener)
    return listener


def progress_history(spark: SparkSession, root: str) -> DataFrame:
    """One row per batch (``kind`` progress) and per end of a run (terminated), with ``day``."""
    exists = read_if_exists(spark, root, "kind string")  # no such path: an empty history
    if exists is None:
        return spark.createDataFrame([], f"{HISTORY}, day date, at timestamp")
    return spark.read.schema(HISTORY + ", day date").json(root).withColumn("at", F.to_timestamp("timestamp"))


def batch_totals(history: DataFrame) -> DataFrame:
    """(name, id, batches, input_rows, seconds, rows_per_sec, first_at, last_at) per query."""
    rows = history.filter(F.col("kind") == "progress")
    seconds = F.sum("batchDuration") / F.lit(1000.0)
    return rows.groupBy("name", "id").agg(
        F.count(F.when(F.col("numInputRows") > 0, 1)).alias("batches"),
        F.sum("numInputRows").alias("input_rows"),
        seconds.alias("seconds"),
        F.try_divide(F.sum("numInputRows").cast("double"), seconds).alias("rows_per_sec"),
        F.min("at").alias("first_at"),
        F.max("at").alias("last_at"),
    )
