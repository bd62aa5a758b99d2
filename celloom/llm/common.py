"""Small helpers shared by the operators."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from celloom.workspace import new_folder

#: A word is a run of anything but these characters.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def landed(df: DataFrame, label: str) -> DataFrame:
    """The rows as a table in the shared folder: read many times, made once, safe if executors go."""
    spark, path = df.sparkSession, new_folder(df.sparkSession, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def utf8(column: str = "text") -> Column:
    """The bytes of a text; null is empty."""
    return F.coalesce(F.col(column), F.lit("")).cast("binary")


def held_out(column: str = "doc_id") -> Column:
    """Rows never learned from: crc32 of the id as text, modulo 5, is 0 (a null id counts as held out)."""
    return F.coalesce(F.crc32(F.col(column).cast("string").cast("binary")) % 5 == 0, F.lit(True))


_ARROW = {
    "long": pa.int64(),
    "int": pa.int32(),
    "double": pa.float64(),
    "string": pa.string(),
    "binary": pa.binary(),
    "boolean": pa.bool_(),
    "array<long>": pa.list_(pa.int64()),
    "array<int>": pa.list_(pa.int32()),
}


def arrow_schema(ddl: str) -> pa.Schema:
    """The Arrow form of "name type, name type", for use inside tasks."""
    return pa.schema([(name, _ARROW[kind]) for name, kind in (part.split() for part in ddl.split(","))])


def batch(schema: pa.Schema, **columns) -> pa.RecordBatch:
    """A record batch of the named columns in the schema's order."""
    return pa.record_batch([pa.array(columns[f.name], f.type) for f in schema], schema=schema)
