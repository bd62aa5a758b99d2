"""The ledger against full counts of the table, after any loads."""

import random
from dataclasses import replace
from datetime import date

import pytest
from pyspark.sql import functions as F

from celloom.model import DAILY, DATASETS, HISTORY, LookupRow
from celloom.plans.ingest import dataframe_records, ingest, target_ledger, target_path
from celloom.plans.ledger import Ledger, compared, dated_keys
from celloom.plans.maintenance import compact
from celloom.table import WideTable, net_change

SCHEMA = "recid string, day string, v string"


def _rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def _full(table):
    return _rows(dated_keys(table.read(), "day", "recid"))


def test_totals_follow_any_loads(spark, folder):
    rng = random.Random(2)
    table, ledger = WideTable(spark, f"{folder}/t", buckets=2), Ledger(spark, f"{folder}/t/ledger", "day")
    for turn in range(7):
        keys = rng.sample(range(40), 12)
        batch = [(str(k), rng.choice(["20260101", "20260102", None]), str(turn)) for k in keys]
        batch += [(None, "20260101", "no key"), (f"new{turn}", None, "twice"), (f"new{turn}", "20260102", "twice")]
        mode = "replace" if turn == 4 else "merge"
        state = table.load(spark.createDataFrame(batch, SCHEMA), mode, on_change=ledger.record)
        assert state.live_rows == table.read().count()
        assert _rows(ledger.totals(state.version)) == _full(table)
        if turn == 2:
            compact(table)
            assert _rows(ledger.totals(table.current().version)) == _full(table)
    window = ("20260102", "20260109")
    assert _rows(ledger.totals(table.current().version, window)) == [r for r in _full(table) if r[0] == "20260102"]


def test_net_change_alone(spark, folder):
    table = WideTable(spark, f"{folder}/t", buckets=2)
    first = table.load(spark.createDataFrame([("1", "d", "a"), ("2", "d", "a"), (None, "d", "a")], SCHEMA), "merge", on_change=net_change)
    assert first.live_rows == 3
    second = table.load(spark.createDataFrame([("2", "d", "b"), ("3", "d", "b"), (None, "d", "b")], SCHEMA), "merge", on_change=net_change)
    assert second.live_rows == 5 == table.read().count()
    # a load that is not counted leaves the number open, and later ones too
    assert table.load(spark.createDataFrame([("3", "d", "c")], SCHEMA), "merge").live_rows is None
    assert table.load(spark.createDataFrame([("4", "d", "c")], SCHEMA), "merge", on_change=net_change).live_rows is None
    assert compact(table).after["live_rows"] == 6
    assert table.load(spark.createDataFrame([("5", "d", "c")], SCHEMA), "merge", on_change=net_change).live_rows == 7


def test_an_entry_of_a_failed_load_does_not_count(spark, folder, monkeypatch):
    table, ledger = WideTable(spark, f"{folder}/t", buckets=2), Ledger(spark, f"{folder}/t/ledger", "day")
    table.load(spark.createDataFrame([("1", "20260101", "a")], SCHEMA), "merge", on_change=ledger.record)
    with monkeypatch.context() as m:
        m.setattr(WideTable, "_publish", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError):
            table.load(spark.createDataFrame([("2", "20260101", "a"), ("3", "20260103", "a")], SCHEMA), "merge", on_change=ledger.record)
    assert _rows(ledger.totals(table.current().version)) == _full(table)
    table.load(spark.createDataFrame([("1", "20260102", "b")], SCHEMA), "merge", on_change=ledger.record)
    assert _rows(ledger.totals(table.current().version)) == _full(table)


def test_other_keys_with_the_same_count_are_told(spark):
    def side(rows):
        return dated_keys(spark.createDataFrame(rows, "recid string, day string"), "day", "recid")

    source = side([("1", "a"), ("2", "a"), ("3", "b"), ("4", None), ("6", "c")])
    target = side([("1", "a"), ("5", "a"), ("3", "b"), ("7", None), ("6", "c"), ("8", "d")])
    assert _rows(compared(source, target)) == sorted(
        [("a", 2, 2, 0, False), (None, 1, 1, 0, False), ("d", 0, 1, -1, False)], key=repr
    )
    assert compared(source, source).count() == 0


def test_a_table_never_loaded(spark, folder):
    assert Ledger(spark, f"{folder}/none", "day").totals(3).count() == 0


def test_an_ingest_needs_no_count_after_its_merge(spark, folder, monkeypatch):
    dataset = replace(DATASETS["account"], normalize=True)
    lookup = [LookupRow("c167", None, "date_last_update"), LookupRow("c1", None, "v")]

    def run(rows, mode, load_id):
        xml = [(str(k), f"<row><c1>{v}</c1><c167>{day}</c167></row>") for k, day, v in rows]
        df = spark.createDataFrame(xml, "recid string, XMLRECORD string")
        return ingest(spark, dataset, mode, dataframe_records(df), lookup, f"{folder}/raw", f"{folder}/t",
                      load_id=load_id, today=date(2026, 1, 3), ledger=True)

    run([(1, "20260101", "a"), (2, "20260102", "b")], HISTORY, "L1")
    with monkeypatch.context() as m:
        m.setattr(WideTable, "read", lambda self: (_ for _ in ()).throw(AssertionError("the table was read")))
        done = run([(2, "20260103", "c"), (3, "20260103", "d")], DAILY, "L2")
    assert (done.source_rows, done.target_rows) == (2, 3)
    table = WideTable(spark, target_path(dataset, f"{folder}/t"))
    kept = target_ledger(spark, dataset, f"{folder}/t").totals(table.current().version)
    assert _rows(kept) == _rows(dated_keys(table.read(), "date_last_update", "recid"))
    assert {r["business_date"]: r["row_count"] for r in kept.collect()} == {"20260101": 1, "20260103": 2}


def test_overwritten_rows_are_found_without_a_shuffle_of_the_table(spark, folder):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    plans = []

    def look(version, came, went):
        if went is not None:
            plans.append(went.groupBy("day").agg(F.count("*"))._jdf.queryExecution().executedPlan().toString())
        return 0

    try:
        table = WideTable(spark, f"{folder}/t", buckets=4)
        table.load(spark.createDataFrame([(str(k), "d", "a") for k in range(50)], SCHEMA), "merge", on_change=look)
        table.load(spark.createDataFrame([("7", "e", "b"), ("x", "e", "b")], SCHEMA), "merge", on_change=look)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.enabled")
    (plan,) = plans
    assert "SortMergeJoin" in plan and plan.count("Exchange") == 1 and "v#" not in plan.split("FileScan", 1)[1].split("]", 1)[0]
