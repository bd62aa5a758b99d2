"""Untouched XML as append-only Parquet, one ``load_id=`` folder per run."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from celloom.functions.xml import business_date, in_window
from celloom.model import Window
from celloom.sources.files import PACKED

#: Bytes of a row group where records are landed by date: what a window reads at least.
DATED_GROUP_BYTES = 8 << 20


def land_raw(
    df: DataFrame,
    path: str,
    mode: str = "errorifexists",
    max_records_per_file: int = 0,
    spread: bool = False,
    date_tag: str | None = None,
) -> None:
    """Write (recid, XMLRECORD, ingested_at); an earlier run's folder is never overwritten.

    ``spread`` deals the records evenly, by their bytes, over as many tasks as
    the session has use for, where few source connections bring many: the parse
    then has as many files to start from. ``max_records_per_file`` bounds files
    without a shuffle.

    With a ``date_tag`` a column business_date is written too. Records of a day
    are brought together and sorted, so that the row groups' statistics tell
    which of them a window needs. The source is still read once: days are dealt
    by hash, for which nothing has to be sampled, and days too large are parted.
    """
    records = df.select("recid", "XMLRECORD", F.current_timestamp().alias("ingested_at"))
    if date_tag is not None:
        records = records.withColumn("business_date", business_date("XMLRECORD", date_tag))
        records = records.hint("rebalance", "business_date").sortWithinPartitions("business_date")
    elif spread:
        records = records.hint("rebalance")
    writer = records.write.mode(mode).options(**PACKED).option("maxRecordsPerFile", max_records_per_file)
    if date_tag is not None:
        writer = writer.option("parquet.block.size", DATED_GROUP_BYTES)
    writer.parquet(path)


def read_landed(spark: SparkSession, path: str) -> DataFrame:
    """One run's records."""
    return spark.read.parquet(path)


def read_landed_window(spark: SparkSession, path: str, window: Window | None, date_tag: str) -> DataFrame:
    """One run's records of a window, with business_date: by the landed column, else by the XML."""
    records = read_landed(spark, path)
    if "business_date" not in records.columns:
        records = records.withColumn("business_date", business_date("XMLRECORD", date_tag))
    return records if window is None else records.where(in_window(F.col("business_date"), window))


def read_all_landed(spark: SparkSession, root: str) -> DataFrame:
    """Every run under one landing folder, with ``load_id`` as partition column."""
    return spark.read.option("basePath", root).parquet(root)
