"""The mapping table: which tag (and m group) feeds which wide column."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from celloom.model import LookupRow


def read_lookup(spark: SparkSession, path: str, table: str) -> DataFrame:
    """(field_index, m_index, resolved_name_en) of one source table, in file order.

    A blank ``m_index`` is NULL, not 1: it asks for all m groups.
    """
    raw = spark.read.csv(path, header=True, escape='"')

    def text(name: str):
        return F.trim(F.coalesce(F.col(name), F.lit("")))

    return raw.where(F.lower(text("table_name")) == table.strip().lower()).select(
        text("field_index").alias("field_index"),
        F.when(text("m_index") != "", text("m_index").cast("bigint")).alias("m_index"),
        text("resolved_name_en").alias("resolved_name_en"),
    )


def load_lookup(spark: SparkSession, path: str, table: str) -> list[LookupRow]:
    """The rows of ``read_lookup`` as descriptors; a table without rows is an error.

    One row per wide column, so this is as small as a table's column list.
    """
    rows = [LookupRow(*r) for r in read_lookup(spark, path, table).collect()]
    if not rows:
        raise ValueError(f"no lookup rows for {table!r} in {path}")
    return rows
