"""File listings as DataFrames, through Spark's own file sources."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

#: How Parquet files are packed: in little time, to about half of what the default leaves. Higher levels cost more than they save.
PACKED = {"compression": "zstd", "parquet.compression.codec.zstd.level": "1"}
#: How many times as much such files took by the default: what their bytes stand for where they tell how much work rows are.
PACKING = 2

LISTING = "file_path string, modified_at timestamp, file_size_in_bytes bigint"


def _in_file_system(spark: SparkSession, path: str):
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), folder


def path_exists(spark: SparkSession, path: str) -> bool:
    """Does a file or folder match? Nothing is read."""
    files, pattern = _in_file_system(spark, path)
    return bool(files.globStatus(pattern))


def remove_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder with all that is in it, wherever it is kept."""
    files, folder = _in_file_system(spark, path)
    files.delete(folder, True)


def list_files(spark: SparkSession, paths: Sequence[str], pattern: str = "*.parquet") -> DataFrame:
    """(file_path, modified_at, file_size_in_bytes) below the paths; contents stay unread."""
    found = [p for p in paths if path_exists(spark, p)]
    if not found:
        return spark.createDataFrame([], LISTING)
    return (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", pattern)
        .load(found)
        .select(
            F.col("path").alias("file_path"),
            F.col("modificationTime").alias("modified_at"),
            F.col("length").alias("file_size_in_bytes"),
        )
    )


def data_files(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """(file_path, content, file_size_in_bytes, record_count) of Parquet data files.

    No column is selected, so only file footers are read. A folder of Parquet
    files has no delete files: content is 0 throughout.
    """
    if not paths:
        return spark.createDataFrame(
            [], "file_path string, content int, file_size_in_bytes bigint, record_count bigint"
        )
    return (
        spark.read.parquet(*paths)
        .groupBy(
            F.col("_metadata.file_path").alias("file_path"),
            F.col("_metadata.file_size").alias("file_size_in_bytes"),
        )
        .agg(F.count(F.lit(1)).alias("record_count"))
        .select("file_path", F.lit(0).alias("content"), "file_size_in_bytes", "record_count")
    )
