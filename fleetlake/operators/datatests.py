"""Column-level data tests (``not_null``, ``accepted_values``, ``unique``).

Each check returns failing rows (or failing keys for ``unique``) as a
DataFrame.  ``run_data_tests`` evaluates a whole suite with one aggregate
pass per table (its first unique key included) plus one aggregation per
further unique key, and returns one result row per test.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetlake.functions import rules


def check_not_null(df: DataFrame, column: str) -> DataFrame:
    """Rows where ``column`` is NULL."""
    return df.filter(F.col(column).isNull())


def check_accepted_values(df: DataFrame, column: str, values) -> DataFrame:
    """Rows whose non-NULL ``column`` is outside ``values``."""
    c = F.col(column)
    return df.filter(c.isNotNull() & ~c.isin(*values))


def check_unique(df: DataFrame, column: str) -> DataFrame:
    """D3: keys occurring more than once (NULLs ignored), with their count.

    64-bit fingerprints are counted first (8 bytes a key are shuffled, hot ones collapse map-side);
    only keys whose fingerprint repeats are compared in full.
    """
    keyed = df.filter(F.col(column).isNotNull()).select(column, F.xxhash64(column).alias("_fingerprint"))
    again = keyed.groupBy("_fingerprint").agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > 1).select("_fingerprint")
    return (
        keyed.join(again, "_fingerprint", "left_semi")
        .groupBy(column)
        .agg(F.count(F.lit(1)).alias("n_records"))
        .filter(F.col("n_records") > 1)
    )


@dataclass
class TableTests:
    name: str
    not_null: list[str] = field(default_factory=list)
    accepted_values: dict[str, tuple] = field(default_factory=dict)
    unique: list[str] = field(default_factory=list)


# The reference's column-test suite (bronze sources and silver models).
DEFAULT_SUITE = [
    TableTests("telemetry_events", not_null=["event_id", "device_id", "event_ts_corrected"]),
    TableTests("blob_index", not_null=["event_id", "blob_uri", "checksum_sha256"]),
    TableTests(
        "telemetry_validated",
        not_null=["event_id"],
        accepted_values={"quality_flag": rules.QUALITY_FLAGS},
    ),
    TableTests("blob_linked", not_null=["event_id"], unique=["event_id"]),
]


def _one_pass(df: DataFrame, t: TableTests) -> DataFrame | None:
    """The row-level tests and the first unique test of a table in one pass: with
    a unique column the failures are first counted per key (map-side combined),
    so a table that is a join is not computed twice."""
    exprs, labels = [], []
    for c in t.not_null:
        exprs.append(F.count(F.when(F.col(c).isNull(), 1)))
        labels.append((c, "not_null"))
    for c, vals in t.accepted_values.items():
        col = F.col(c)
        exprs.append(F.count(F.when(col.isNotNull() & ~col.isin(*vals), 1)))
        labels.append((c, "accepted_values"))
    if t.unique:
        key = t.unique[0]
        per_key = df.groupBy(F.col(key).alias("_key")).agg(F.count(F.lit(1)).alias("_n"), *[e.alias(f"_p{i}") for i, e in enumerate(exprs)])
        exprs = [F.coalesce(F.sum(f"_p{i}"), F.lit(0)) for i in range(len(exprs))]
        exprs.append(F.count(F.when(F.col("_key").isNotNull() & (F.col("_n") > 1), 1)))
        labels.append((key, "unique"))
        df = per_key
    if not exprs:
        return None
    one = df.agg(*[e.alias(f"_t{i}") for i, e in enumerate(exprs)])
    arr = F.array(
        *[
            F.struct(F.lit(c).alias("column_name"), F.lit(k).alias("test_name"), F.col(f"_t{i}").alias("failures"))
            for i, (c, k) in enumerate(labels)
        ]
    )
    return one.select(F.explode(arr).alias("r")).select(
        F.lit(t.name).alias("table_name"), "r.column_name", "r.test_name", "r.failures"
    )


def run_data_tests(tables: dict[str, DataFrame], suite: list[TableTests] | None = None) -> DataFrame:
    """(table_name, column_name, test_name, failures, status) per test."""
    parts: list[DataFrame] = []
    for t in suite or DEFAULT_SUITE:
        df = tables[t.name]
        rl = _one_pass(df, t)
        if rl is not None:
            parts.append(rl)
        for c in t.unique[1:]:
            parts.append(
                check_unique(df, c).agg(F.count(F.lit(1)).alias("failures")).select(
                    F.lit(t.name).alias("table_name"),
                    F.lit(c).alias("column_name"),
                    F.lit("unique").alias("test_name"),
                    "failures",
                )
            )
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.withColumn(
        "status", F.when(F.col("failures") == 0, F.lit("pass")).otherwise(F.lit("fail"))
    )
