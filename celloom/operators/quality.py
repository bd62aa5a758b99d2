"""Row counts per business date, and the dates on which a target has too few."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from celloom.functions.xml import business_date, in_window
from celloom.model import Window

REPORT_LINES = 50


def count_by_date(df: DataFrame, day: Column | str, window: Window | None = None) -> DataFrame:
    """(business_date, row_count). NULL is a date of its own, unless a window is given."""
    dated = df.select((F.col(day) if isinstance(day, str) else day).alias("business_date"))
    if window is not None:
        dated = dated.where(in_window(F.col("business_date"), window))
    return dated.groupBy("business_date").agg(F.count(F.lit(1)).alias("row_count"))


def count_xml_by_date(
    df: DataFrame, date_tag: str, window: Window | None = None, xml_column: str = "XMLRECORD"
) -> DataFrame:
    """``count_by_date`` of raw records."""
    return count_by_date(df, business_date(xml_column, date_tag), window)


def align_counts(source: DataFrame, target: DataFrame) -> DataFrame:
    """(business_date, source_rows, target_rows) of every date on either side; absent is 0.

    A null-safe full outer join of two count tables, written as a union and
    one grouping: a NULL date groups by itself, and counts already grouped by
    date are not shuffled again.
    """
    zero = F.lit(0).cast("bigint")
    both = source.select(
        "business_date", F.col("row_count").alias("s"), zero.alias("t")
    ).unionByName(target.select("business_date", zero.alias("s"), F.col("row_count").alias("t")))
    return both.groupBy("business_date").agg(
        F.sum("s").alias("source_rows"), F.sum("t").alias("target_rows")
    )


def gaps(source: DataFrame, target: DataFrame) -> DataFrame:
    """Dates where the source count is the greater, in no order. A surplus is no gap."""
    return (
        align_counts(source, target)
        .where("source_rows > target_rows")
        .withColumn("missing", F.col("source_rows") - F.col("target_rows"))
    )


def by_date(found: DataFrame) -> DataFrame:
    """Gaps in the order of their dates, the NULL date last."""
    return found.orderBy(F.col("business_date").asc_nulls_last())


def gap_summary(source: DataFrame, target: DataFrame) -> DataFrame:
    """One row: rows and dates per side, and the number of dates with a gap."""
    return align_counts(source, target).agg(
        F.coalesce(F.sum("source_rows"), F.lit(0)).alias("source_rows"),
        F.count_if(F.col("source_rows") > 0).alias("source_dates"),
        F.coalesce(F.sum("target_rows"), F.lit(0)).alias("target_rows"),
        F.count_if(F.col("target_rows") > 0).alias("target_dates"),
        F.count_if(F.col("source_rows") > F.col("target_rows")).alias("gap_dates"),
    )


# The wording of a report line.
_LINE = "%s %s: oracle=%d bronze=%d (missing %d)"
_MORE = "... and %d more (see task log)"


def gap_lines(found: DataFrame, dataset: str, turn: int = 0) -> DataFrame:
    """(turn, dataset, business_date, line): the report text of each gap.

    ``turn`` is the dataset's place in the check.
    """
    shown = F.coalesce(F.nullif(F.col("business_date"), F.lit("")), F.lit("(no date)"))
    return found.select(
        F.lit(turn).alias("turn"),
        F.lit(dataset).alias("dataset"),
        "business_date",
        F.format_string(
            _LINE,
            F.lit(dataset),
            shown,
            F.col("source_rows"),
            F.col("target_rows"),
            F.col("missing"),
        ).alias("line"),
    )


def report(lines: DataFrame, limit: int = REPORT_LINES) -> DataFrame:
    """(position, line): the first lines by dataset and date, and how many more there are."""
    head = lines.orderBy("turn", F.col("business_date").asc_nulls_last()).limit(limit)
    shown = head.select(
        F.struct(
            F.col("turn").alias("t"),
            F.col("business_date").isNull().alias("n"),
            F.col("business_date").alias("b"),
            F.col("line").alias("line"),
        ).alias("r")
    ).agg(F.array_sort(F.collect_list("r")).alias("r"))  # at most ``limit`` items
    numbered = shown.select(F.posexplode("r").alias("i", "r")).select(
        (F.col("i") + 1).cast("bigint").alias("position"), F.col("r.line").alias("line")
    )
    rest = (
        lines.agg(F.count(F.lit(1)).alias("n"))
        .where(F.col("n") > limit)
        .select(
            F.lit(limit + 1).cast("bigint").alias("position"),
            F.format_string(_MORE, F.col("n") - limit).alias("line"),
        )
    )
    return numbered.unionByName(rest)
