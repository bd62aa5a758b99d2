"""Work at the same time: no waiting for others, failures reported, jobs cancelled."""

import threading
import time

import pytest
from pyspark.sql import functions as F

from celloom.model import DATASETS, HISTORY, LookupRow
from celloom.plans import maintenance as M
from celloom.plans.ingest import dataframe_records, ingest_all
from celloom.plans.together import TookTooLong, run_together
from celloom.table import WideTable


def _slow_job(spark, seconds):
    def wait(rows):
        time.sleep(seconds)
        yield from rows

    return spark.range(4).repartition(4).mapInArrow(lambda batches: wait(batches), "id long").count()


def test_a_slow_one_does_not_hold_up_others(spark):
    others_done = threading.Event()

    def slow():
        assert others_done.wait(60)
        return spark.range(3).count()

    def quick():
        n = spark.range(5).count()
        others_done.set()
        return n

    assert run_together(spark, {"slow": slow, "quick": quick}, at_once=2) == {"slow": 3, "quick": 5}


def test_more_work_than_threads_keeps_its_order(spark):
    work = {str(k): lambda k=k: spark.range(k).count() for k in range(7)}
    assert list(run_together(spark, work, at_once=2).items()) == [(str(k), k) for k in range(7)]
    assert run_together(spark, {}) == {}


def test_a_failure_is_reported_and_its_jobs_are_cancelled(spark):
    ended = {}

    def failing():
        from pyspark import inheritable_thread_target

        def job():
            try:
                ended["n"] = _slow_job(spark, 40)
            except Exception as e:
                ended["error"] = str(e)

        left = threading.Thread(target=inheritable_thread_target(job))
        left.start()
        ended["thread"] = left
        time.sleep(3)
        raise ValueError("broken source")

    start = time.monotonic()
    results = run_together(spark, {"bad": failing, "good": lambda: spark.range(9).count()})
    ended["thread"].join(30)
    assert isinstance(results["bad"], ValueError) and results["good"] == 9
    assert "cancel" in ended["error"].lower() and time.monotonic() - start < 35


def test_work_that_takes_too_long_is_cancelled(spark):
    start = time.monotonic()
    results = run_together(spark, {"long": lambda: _slow_job(spark, 60), "short": lambda: 1}, seconds=4)
    assert isinstance(results["long"], TookTooLong) and results["short"] == 1
    assert time.monotonic() - start < 40


def test_pools_and_tags_are_those_of_the_work(spark):
    context = spark.sparkContext

    def seen():
        return context.getLocalProperty("spark.scheduler.pool"), len(context.getJobTags())

    assert run_together(spark, {"a": seen, "b": seen, "c": seen}, at_once=1) == {n: (n, 1) for n in "abc"}
    assert context.getLocalProperty("spark.scheduler.pool") is None and not context.getJobTags()


def test_datasets_are_loaded_at_the_same_time(spark, folder):
    """Each waits for the other to have begun: one after the other would never end."""
    begun = threading.Barrier(2, timeout=60)
    df = spark.createDataFrame([("1", "<row><c1>a</c1></row>")], "recid string, XMLRECORD string")
    lookup = [LookupRow("c1", None, "v")]

    def lookups(d):
        begun.wait()
        return lookup

    results = ingest_all(
        spark, [DATASETS["loan"], DATASETS["account"]], HISTORY, dataframe_records(df), lookups,
        f"{folder}/raw", f"{folder}/t",
    )
    assert [(r.dataset, r.source_rows, r.error) for r in results] == [("loan", 1, None), ("account", 1, None)]


def test_tables_are_compacted_though_one_is_broken(spark, folder, monkeypatch):
    tables = [WideTable(spark, f"{folder}/bronze/{n}", buckets=2) for n in "abc"]
    for t in tables:
        t.merge(spark.range(40).select(F.col("id").cast("string").alias("recid"), F.lit("a").alias("v")))
        t.merge(spark.createDataFrame([("3", "b")], "recid string, v string"))
    plain = WideTable.overwritten_buckets

    def broken(self):
        if self.path.endswith("/a"):
            raise RuntimeError("no listing")
        return plain(self)

    monkeypatch.setattr(WideTable, "overwritten_buckets", broken)
    with pytest.raises(RuntimeError, match="no listing"):
        M.compact_all(tables)
    assert [t.current().operation for t in tables] == ["merge", "compact", "compact"]
