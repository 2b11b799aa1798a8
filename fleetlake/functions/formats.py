"""Report formatting and file-health labels."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from fleetlake.functions import rules

KIB = 1024
MIB = 1024 * 1024


def format_size(b: Column) -> Column:
    """``x.y MB`` (>= 1 MiB), ``x.y KB`` (>= 1 KiB), else ``n B``.

    One decimal, rounded half-even on the exact binary value like Python's
    format; ``bround`` reproduces that for these power-of-two quotients.
    """
    mb = F.format_string("%.1f MB", F.bround(b.cast("double") / MIB, 1))
    kb = F.format_string("%.1f KB", F.bround(b.cast("double") / KIB, 1))
    return F.when(b >= MIB, mb).when(b >= KIB, kb).otherwise(F.concat(b.cast("string"), F.lit(" B")))


def file_health_label(files: Column, avg_bytes: Column) -> Column:
    """SMALL_FILES / COMPACTION_RECOMMENDED / OK."""
    return (
        F.when((files > 0) & (avg_bytes < rules.SMALL_FILE_AVG_BYTES), F.lit("SMALL_FILES"))
        .when((files > 0) & (avg_bytes < rules.RECOMMEND_COMPACT_AVG_BYTES), F.lit("COMPACTION_RECOMMENDED"))
        .otherwise(F.lit("OK"))
    )
