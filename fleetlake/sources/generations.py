"""One schema over files of several generations (K7): absent columns, new nested fields, wider types.

The footers are read by tasks; the few distinct schemas among them are merged on the driver, and the table
is then one scan with the merged schema: the Parquet reader widens values and fills absent columns
with NULL, so filters and column pruning work as on any table.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType,
    ByteType,
    DataType,
    DecimalType,
    DoubleType,
    FloatType,
    IntegerType,
    LongType,
    MapType,
    NullType,
    ShortType,
    StructField,
    StructType,
)

#: Types in the order in which they widen without loss in the Parquet reader.
WHOLE = [ByteType(), ShortType(), IntegerType(), LongType()]


def wider(a: DataType, b: DataType, at: str = "") -> DataType:
    """The least type that holds both; a ValueError that names the column where there is none."""
    if a == b:
        return a
    if isinstance(a, NullType) or isinstance(b, NullType):
        return b if isinstance(a, NullType) else a
    if a in WHOLE and b in WHOLE:
        return WHOLE[max(WHOLE.index(a), WHOLE.index(b))]
    floats = (FloatType(), DoubleType())
    if a in floats and b in floats:
        return DoubleType()
    for x, y in ((a, b), (b, a)):
        # every int fits a double; a long does not
        if x in floats and y in WHOLE[:3]:
            return DoubleType()
    if isinstance(a, DecimalType) and isinstance(b, DecimalType):
        scale = max(a.scale, b.scale)
        digits = max(a.precision - a.scale, b.precision - b.scale) + scale
        if digits <= 38:
            return DecimalType(digits, scale)
    if isinstance(a, StructType) and isinstance(b, StructType):
        return merged_schema([a, b], f"{at}.")
    if isinstance(a, ArrayType) and isinstance(b, ArrayType):
        return ArrayType(wider(a.elementType, b.elementType, f"{at}[]"), True)
    if isinstance(a, MapType) and isinstance(b, MapType):
        return MapType(wider(a.keyType, b.keyType, f"{at}.key"), wider(a.valueType, b.valueType, f"{at}.value"), True)
    raise ValueError(f"{at}: {a.simpleString()} and {b.simpleString()} have no common wider type")


def merged_schema(schemas: list[StructType], at: str = "") -> StructType:
    """All fields of all schemas in order of their first appearance, each with the widest of its types."""

    def two(a: StructType, b: StructType) -> StructType:
        others = {f.name: f for f in b.fields}
        fields = [StructField(f.name, wider(f.dataType, others[f.name].dataType, at + f.name) if f.name in others else f.dataType, True) for f in a.fields]
        known = {f.name for f in a.fields}
        return StructType(fields + [StructField(f.name, f.dataType, True) for f in b.fields if f.name not in known])

    return reduce(two, schemas, StructType())


def _footers():
    """Arrow function path -> (path, schema of the file as Spark's JSON); local, so that executors need not
    have this package."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from urllib.parse import unquote

        import pyarrow
        import pyarrow.parquet as pq
        from pyarrow import fs
        from pyspark.sql.pandas.types import from_arrow_schema

        for batch in batches:
            out = []
            for path in batch.column(0).to_pylist():
                if path.startswith("file:"):
                    system, name = fs.LocalFileSystem(), "/" + unquote(path.split(":", 1)[1]).lstrip("/")
                else:
                    system, name = fs.FileSystem.from_uri(path)
                schema = pq.read_schema(system.open_input_file(name))
                own = (schema.metadata or {}).get(b"org.apache.spark.sql.parquet.row.metadata")
                out.append(own.decode() if own else from_arrow_schema(schema).json())
            yield pyarrow.RecordBatch.from_arrays([batch.column(0), pyarrow.array(out, pyarrow.string())], names=["path", "schema"])

    return run


def generations(spark: SparkSession, root: str) -> DataFrame:
    """(schema, files, first_path): the distinct schemas of the Parquet files below ``root``, as Spark's JSON."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet").load(root)
    found = files.select("path").mapInArrow(_footers(), "path string, schema string")
    return found.groupBy("schema").agg(F.count(F.lit(1)).alias("files"), F.min("path").alias("first_path"))


def read_generations(spark: SparkSession, root: str) -> DataFrame:
    """The table below ``root`` with the merged schema of all its files; partition columns are found in
    the folders as usual.  A column whose types have no common wider one is an error that names it."""
    rows = generations(spark, root).orderBy("first_path").collect()  # one per generation, not per file
    schema = merged_schema([StructType.fromJson(json.loads(r["schema"])) for r in rows])
    return spark.read.schema(schema).parquet(root) if rows else spark.createDataFrame([], schema)
