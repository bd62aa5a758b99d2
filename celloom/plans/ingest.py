"""Source to landed XML to wide table."""

from __future__ import annotations

import logging
from collections.abc import Callable, Iterable, Sequence
from dataclasses import dataclass
from datetime import date
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from celloom.functions.xml import business_date, in_window
from celloom.model import (
    Dataset,
    LookupRow,
    RunMode,
    Window,
    full_name,
    landing_path,
    new_load_id,
    resolve_window,
    resolve_write_mode,
    select_datasets,
)
from celloom.operators.parsing import chosen_rows, parse_wide
from celloom.operators.storage import file_totals
from celloom.plans.ledger import Ledger
from celloom.plans.together import run_together
from celloom.sources.files import data_files, remove_folder
from celloom.sources.jdbc import JdbcSource, read_records
from celloom.sources.landing import land_raw, read_landed
from celloom.sources.shapes import landed_shapes
from celloom.table import BUCKETS, State, WideTable, net_change

log = logging.getLogger(__name__)

# (dataset, mode, window) -> DataFrame(recid, XMLRECORD)
RecordSource = Callable[[Dataset, RunMode, Window | None], DataFrame]


def jdbc_records(spark: SparkSession, source: JdbcSource) -> RecordSource:
    """Records straight from the source table, the window applied there."""
    return lambda dataset, mode, window: read_records(
        spark, source, dataset, mode.source_partitions, window
    )


def dataframe_records(df: DataFrame) -> RecordSource:
    """Records already at hand, the window applied to the date in the XML."""

    def read(dataset: Dataset, mode: RunMode, window: Window | None) -> DataFrame:
        if window is None:
            return df
        return df.where(in_window(business_date("XMLRECORD", dataset.date_tag), window))

    return read


@dataclass(frozen=True)
class IngestResult:
    dataset: str
    source_rows: int
    landed: str | None
    commit: State | None
    target_rows: int | None = None
    error: str | None = None


def target_path(dataset: Dataset, root: str, namespace: str = "bronze") -> str:
    """A folder a part of the table's name; one without a namespace is in the default one."""
    return "/".join([root.rstrip("/"), *filter(None, full_name(dataset.target_table, "", namespace).split("."))])


def target_ledger(spark: SparkSession, dataset: Dataset, table_root: str) -> Ledger:
    """Where a dataset's loads leave their counts by business date."""
    path = f"{target_path(dataset, table_root)}/ledger"
    return Ledger(spark, path, dataset.date_column, dataset.merge_key)


def ingest(
    spark: SparkSession,
    dataset: Dataset,
    mode: RunMode,
    records: RecordSource,
    lookup: Sequence[LookupRow],
    raw_root: str,
    table_root: str,
    window: Window | None = None,
    load_id: str | None = None,
    today: date | None = None,
    columns: int | Iterable[str] | None = None,
    max_records_per_file: int = 0,
    count_target: bool = True,
    spread: bool | None = None,
    land_dates: bool = False,
    buckets: int = BUCKETS,
    ledger: bool = False,
) -> IngestResult:
    """One dataset, once. An empty batch leaves no landing and no change to the table.

    The batch is landed first and only read back from there, so the source is
    asked once: whether there are rows, and how many bytes, is told by the landed
    files. The bytes decide on the table's buckets, at least ``buckets``. Records
    are spread before they are landed unless the mode's source connections are
    as many as the cores, or ``spread`` says otherwise; ``land_dates`` lands them
    by business date. ``count_target`` counts the rows that a merge overwrites,
    for which the table's key column is read once, and so the table's rows;
    ``ledger`` keeps these counts by business date too.
    """
    batch = records(dataset, mode, resolve_window(mode, window, today))
    path = landing_path(dataset, raw_root, load_id or new_load_id())
    if spread is None:
        spread = mode.source_partitions < spark.sparkContext.defaultParallelism
    land_raw(
        batch,
        path,
        max_records_per_file=max_records_per_file,
        spread=spread,
        date_tag=dataset.date_tag if land_dates else None,
    )
    landed = read_landed(spark, path)
    there = file_totals(data_files(spark, [path])).first()  # footers only
    rows = there["stored_records"]
    if not rows:
        remove_folder(spark, path)
        log.warning("%s: the source has nothing for this run", dataset.name)
        return IngestResult(dataset.name, 0, None, None)
    rows_asked = chosen_rows(lookup, columns)
    shapes = landed_shapes(spark, [path], rows_asked)
    wide = parse_wide(landed, rows_asked, keep=(dataset.merge_key,), normalize=dataset.normalize, shapes=shapes)
    table = WideTable(spark, target_path(dataset, table_root), dataset.merge_key, buckets=buckets)
    on_change = net_change if count_target else None
    if ledger:
        on_change = target_ledger(spark, dataset, table_root).record
    commit = table.load(wide, resolve_write_mode(mode, window), there["bytes"], on_change)
    total = commit.live_rows
    if total is None and count_target:
        total = table.read().count()  # an earlier load was not counted
    log.info("%s: %d source rows, %s target rows", dataset.name, rows, total)
    return IngestResult(dataset.name, rows, path, commit, total)


def reparse(
    spark: SparkSession,
    dataset: Dataset,
    load_ids: Sequence[str],
    lookup: Sequence[LookupRow],
    raw_root: str,
    table_root: str,
    columns: int | Iterable[str] | None = None,
    buckets: int = BUCKETS,
) -> State:
    """The table replaced by a fresh parse of some landed runs; of a key in several, the latest run's record stays.

    The runs' records are parsed once: what shapes their columns take is kept
    with each landing and merged, and looked for only where it is not there yet.
    """
    paths = [landing_path(dataset, raw_root, load) for load in load_ids]
    rows = chosen_rows(lookup, columns)
    shapes = landed_shapes(spark, paths, rows)
    turns = [read_landed(spark, p).select("recid", "XMLRECORD", F.lit(k).alias("turn")) for k, p in enumerate(paths)]
    records = reduce(DataFrame.unionByName, turns)
    if len(turns) > 1:
        # which runs' records stay is decided before any XML is looked at; those without a key all do
        last = records.where("recid IS NOT NULL").groupBy(F.col("recid").alias("key")).agg(F.max("turn").alias("last"))
        latest = (F.col("recid") == F.col("key")) & (F.col("turn") == F.col("last"))
        records = records.join(last, latest, "left_semi").unionByName(records.where("recid IS NULL"))
    wide = parse_wide(records, rows, keep=(dataset.merge_key,), normalize=dataset.normalize, shapes=shapes)
    size = file_totals(data_files(spark, paths)).first()["bytes"]
    return WideTable(spark, target_path(dataset, table_root), dataset.merge_key, buckets=buckets).replace(wide, size)


def ingest_all(
    spark: SparkSession,
    datasets: Iterable[Dataset] | str,
    mode: RunMode,
    records: RecordSource,
    lookups: Callable[[Dataset], Sequence[LookupRow]],
    raw_root: str,
    table_root: str,
    at_once: int = 4,
    seconds: float | None = None,
    **options,
) -> list[IngestResult]:
    """Datasets, given or selected by name, at the same time, ``at_once`` of them.

    One that fails, or takes longer than ``seconds``, is reported, its jobs are
    cancelled and the others still run.
    """
    if isinstance(datasets, str):
        datasets = select_datasets(datasets)
    work = {
        d.name: lambda d=d: ingest(spark, d, mode, records, lookups(d), raw_root, table_root, **options)
        for d in datasets
    }
    results = []
    for name, result in run_together(spark, work, at_once, seconds).items():
        if isinstance(result, Exception):
            log.error("%s failed", name, exc_info=result)
            result = IngestResult(name, 0, None, None, error=str(result) or type(result).__name__)
        results.append(result)
    return results


def exit_code(results: Iterable[IngestResult]) -> int:
    return 1 if any(r.error is not None for r in results) else 0
