"""Counts of a table by business date, kept up with its loads.

Each load leaves what it changed: for every business date the rows that came
less those that went, and a fingerprint of their keys. Fingerprints are the
exclusive or of the keys' hashes, so a key that goes takes itself out again.
Entries of any loads add up, so a check reads a row a date and load, and no table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from celloom.functions.xml import in_window
from celloom.model import Window
from celloom.operators.quality import align_counts
from celloom.sources.files import path_exists

_ENTRY = "business_date string, row_count bigint, keys bigint, whole boolean, version bigint"


def dated_keys(df: DataFrame, date_column: str, key: str) -> DataFrame:
    """(business_date, row_count, keys): rows and the fingerprint of their keys by date; NULL is a date of its own."""
    dated = df.select(F.col(f"`{date_column}`").cast("string").alias("business_date"), F.xxhash64(f"`{key}`").alias("key"))
    return dated.groupBy("business_date").agg(F.count(F.lit(1)).alias("row_count"), F.bit_xor("key").alias("keys"))


class Ledger:
    """Entries of one table's loads, a folder a version of the table."""

    def __init__(self, spark: SparkSession, path: str, date_column: str, key: str = "recid"):
        self.spark = spark
        self.path = path.rstrip("/")
        self.date_column = date_column
        self.key = key

    def record(self, version: int, came: DataFrame, went: DataFrame | None) -> int:
        """Write what a load changed, before the version is published; how many rows more there are then.

        Without ``went`` the rows that came are all there are: earlier entries
        no longer count. An entry of a load that failed is written over by the
        next load, which has the same version.
        """
        came = came if self.date_column in came.columns else came.withColumn(self.date_column, F.lit(None).cast("string"))
        rows = dated_keys(came, self.date_column, self.key)
        if went is not None:
            gone = dated_keys(went, self.date_column, self.key).withColumn("row_count", -F.col("row_count"))
            rows = rows.unionByName(gone).groupBy("business_date").agg(
                F.sum("row_count").alias("row_count"), F.bit_xor("keys").alias("keys")
            )
        folder = f"{self.path}/version={version}"
        rows.withColumn("whole", F.lit(went is None)).coalesce(1).write.mode("overwrite").parquet(folder)
        entry = self.spark.read.schema(_ENTRY.removesuffix(", version bigint")).parquet(folder)
        return entry.agg(F.coalesce(F.sum("row_count"), F.lit(0))).first()[0]

    def totals(self, version: int, window: Window | None = None) -> DataFrame:
        """(business_date, row_count, keys) of the table as of a version."""
        if not path_exists(self.spark, f"{self.path}/version=*"):
            entries = self.spark.createDataFrame([], _ENTRY)
        else:
            entries = self.spark.read.schema(_ENTRY).option("basePath", self.path).parquet(self.path)
        entries = entries.where(F.col("version") <= version)
        start = entries.where("whole").agg(F.max("version")).first()[0]
        if start is not None:
            entries = entries.where(F.col("version") >= start)
        if window is not None:
            entries = entries.where(in_window(F.col("business_date"), window))
        sums = entries.groupBy("business_date").agg(F.sum("row_count").alias("row_count"), F.bit_xor("keys").alias("keys"))
        return sums.where("row_count <> 0 OR keys <> 0")


def compared(source: DataFrame, target: DataFrame) -> DataFrame:
    """(business_date, source_rows, target_rows, missing, same_keys) of dates on which two (business_date, row_count,
    keys) tables differ: too few or too many rows, or as many with other keys."""
    counts = align_counts(source, target)
    signs = source.select("business_date", "keys").unionByName(target.select("business_date", "keys"))
    signs = signs.groupBy(F.col("business_date").alias("day")).agg((F.bit_xor("keys") == 0).alias("same_keys"))
    both = counts.join(signs, F.col("business_date").eqNullSafe(F.col("day"))).drop("day")
    missing = F.col("source_rows") - F.col("target_rows")
    return both.withColumn("missing", missing).where("missing <> 0 OR NOT same_keys").select(
        "business_date", "source_rows", "target_rows", "missing", "same_keys"
    )
