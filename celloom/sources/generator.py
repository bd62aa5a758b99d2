"""Test volume: copies of one record that differ in key and business date only."""

from __future__ import annotations

from datetime import date
from xml.etree import ElementTree

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

_KEY, _DATE = "\ue000", "\ue001"  # private-use characters, absent from real records


def stamp_record(template: str, date_tag: str, key: Column, day: Column) -> Column:
    """The template with its row id and every <date_tag> text replaced.

    The template is taken apart once, on the driver; per row only strings are
    put together.
    """
    row = ElementTree.fromstring(template)
    row.set("id", _KEY)
    for element in row.iter(date_tag):
        element.text = _DATE
    pieces: list[Column] = []
    text = ElementTree.tostring(row, encoding="unicode")
    for i, around_key in enumerate(text.split(_KEY)):
        if i:
            pieces.append(key)
        for j, literal in enumerate(around_key.split(_DATE)):
            if j:
                pieces.append(day)
            pieces.append(F.lit(literal))
    return F.concat(*pieces)


def stamp_records(
    offsets: DataFrame, offset: str, template: str, first_key: int, date_tag: str, start: date, end: date
) -> DataFrame:
    """(recid, XMLRECORD) per offset: key first + offset, date start + offset mod span."""
    span = (end - start).days + 1
    key = (F.col(offset) + F.lit(first_key)).cast("string")
    day = F.date_format(
        F.date_add(F.lit(start), F.pmod(F.col(offset), F.lit(span)).cast("int")), "yyyyMMdd"
    )
    return offsets.select(
        key.alias("recid"), stamp_record(template, date_tag, key, day).alias("XMLRECORD")
    )


def generate_records(
    spark: SparkSession, template: str, count: int, first_key: int, date_tag: str, start: date, end: date
) -> DataFrame:
    return stamp_records(spark.range(count), "id", template, first_key, date_tag, start, end)


def next_key(df: DataFrame, key: str, floor: int) -> DataFrame:
    """One row ``next_key``: highest numeric key from ``floor`` up, plus one, else ``floor``."""
    number = F.col(key).cast("bigint")
    return df.where(number >= floor).agg(
        F.coalesce(F.max(number) + 1, F.lit(floor)).cast("bigint").alias("next_key")
    )
