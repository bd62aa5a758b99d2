"""The gap check over several datasets as one DataFrame."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, functions as F

from celloom.model import Dataset, Window, select_datasets
from celloom.operators.quality import count_by_date, gap_lines, gap_summary, gaps, report

# (dataset, window) -> DataFrame(business_date, row_count), counted by the source
SourceCounts = Callable[[Dataset, Window | None], DataFrame]
# dataset -> the wide table
TargetRows = Callable[[Dataset], DataFrame]


@dataclass(frozen=True)
class GapCheck:
    summary: DataFrame
    lines: DataFrame

    def report(self) -> DataFrame:
        return report(self.lines)


def check_gaps(
    datasets: Iterable[Dataset] | str,
    source_counts: SourceCounts,
    target_rows: TargetRows,
    window: Window | None = None,
) -> GapCheck:
    """Datasets, given or selected by name: both sides counted per business date, within the window if there is one."""
    if isinstance(datasets, str):
        datasets = select_datasets(datasets)
    summaries, lines = [], []
    for turn, d in enumerate(datasets):
        source = source_counts(d, window)
        target = count_by_date(target_rows(d), d.date_column, window)
        summaries.append(gap_summary(source, target).select(F.lit(d.name).alias("dataset"), "*"))
        lines.append(gap_lines(gaps(source, target), d.name, turn))
    return GapCheck(reduce(DataFrame.unionByName, summaries), reduce(DataFrame.unionByName, lines))
