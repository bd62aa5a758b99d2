"""Keyed XML records from an Oracle table over JDBC.

Projection, window filter and the grouped count run inside the source; Spark
opens one connection per hash bucket.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from celloom.model import Dataset, Window, check_identifier, check_window


@dataclass(frozen=True)
class JdbcSource:
    url: str
    user: str = ""
    password: str = field(default="", repr=False)
    driver: str = "oracle.jdbc.OracleDriver"
    fetch_size: int = 5000

    def options(self) -> dict[str, str]:
        return {
            "url": self.url,
            "user": self.user,
            "password": self.password,
            "driver": self.driver,
            "fetchsize": str(self.fetch_size),
        }


def source_name(dataset: Dataset) -> str:
    check_identifier("source_table", dataset.source_table)
    check_identifier("date_tag", dataset.date_tag)
    if not dataset.source_schema:
        return dataset.source_table
    return f"{check_identifier('source_schema', dataset.source_schema)}.{dataset.source_table}"


def _date_sql(dataset: Dataset) -> str:
    path = f"/row/{dataset.date_tag}/text()"
    return f"XMLCAST(XMLQUERY('{path}' PASSING r.xmlrecord RETURNING CONTENT) AS VARCHAR2(8))"


def _where_sql(dataset: Dataset, window: Window | None) -> str:
    if window is None:
        return ""
    start, end = check_window(*window)
    return f" WHERE {_date_sql(dataset)} BETWEEN '{start}' AND '{end}'"


def records_sql(dataset: Dataset, partitions: int, window: Window | None = None) -> str:
    """The source-side subquery: key, XML as text, and the bucket to split on."""
    table = source_name(dataset)
    return (
        f"(SELECT r.recid, r.xmlrecord.getClobVal() AS xmlrecord, "
        f"MOD(ORA_HASH(r.recid), {int(partitions)}) AS pkey "
        f"FROM {table} r{_where_sql(dataset, window)}) records"
    )


def counts_sql(dataset: Dataset, window: Window | None = None) -> str:
    """Rows per business date, grouped by the source itself.

    The cast gives the count a precision; a bare COUNT(*) has none in Oracle.
    """
    table, day = source_name(dataset), _date_sql(dataset)
    return (
        f"SELECT {day} AS business_date, CAST(COUNT(*) AS NUMBER(19,0)) AS row_count "
        f"FROM {table} r{_where_sql(dataset, window)} GROUP BY {day}"
    )


def record_options(
    source: JdbcSource, dataset: Dataset, partitions: int, window: Window | None = None
) -> dict[str, str]:
    return {
        **source.options(),
        "dbtable": records_sql(dataset, partitions, window),
        "partitionColumn": "pkey",
        "lowerBound": "0",
        "upperBound": str(partitions),
        "numPartitions": str(partitions),
    }


def tidy_records(df: DataFrame) -> DataFrame:
    """(recid, XMLRECORD) whatever case the source reports, without the split key."""
    names = {c.lower(): c for c in df.columns}
    return df.select(
        F.col(names["recid"]).alias("recid"), F.col(names["xmlrecord"]).alias("XMLRECORD")
    )


def read_records(
    spark: SparkSession,
    source: JdbcSource,
    dataset: Dataset,
    partitions: int,
    window: Window | None = None,
) -> DataFrame:
    options = record_options(source, dataset, partitions, window)
    return tidy_records(spark.read.format("jdbc").options(**options).load())


def read_counts(
    spark: SparkSession, source: JdbcSource, dataset: Dataset, window: Window | None = None
) -> DataFrame:
    df = (
        spark.read.format("jdbc")
        .options(**source.options())
        .option("query", counts_sql(dataset, window))
        .load()
    )
    day, rows = df.columns
    return df.select(
        F.col(day).cast("string").alias("business_date"),
        F.col(rows).cast("bigint").alias("row_count"),
    )


def hash_bucket(key: Column | str, buckets: int) -> Column:
    """0..buckets-1, every key in exactly one."""
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")
