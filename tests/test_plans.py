import random
from dataclasses import replace
from datetime import date

import pytest
from pyspark.sql import functions as F

from celloom.model import DAILY, DATASETS, HISTORY, LookupRow
from celloom.operators import quality as Q
from celloom.operators.shapes import profile_shapes
from celloom.plans.gapcheck import check_gaps
from celloom.plans.ingest import dataframe_records, exit_code, ingest, ingest_all, reparse, target_path
from celloom.sources.files import data_files, path_exists
from celloom.sources.landing import land_raw, read_landed
from celloom.sources.shapes import kept_shapes, landed_shapes
from celloom.table import WideTable

ACCOUNT = DATASETS["account"]
LOOKUP = [LookupRow("c167", None, "date_last_update"), LookupRow("c1", None, "v")]


def _records(spark, rows):
    xml = [
        (str(k), "<row>" + "".join(f'<c1 m="{i}">{v}</c1>' for i, v in enumerate(values, 1))
         + (f"<c167>{day}</c167>" if day else "") + "</row>")
        for k, day, values in rows
    ]
    return spark.createDataFrame(xml, "recid string, XMLRECORD string")


def _run(spark, folder, df, mode, **options):
    return ingest(
        spark, ACCOUNT, mode, dataframe_records(df), LOOKUP, f"{folder}/raw", f"{folder}/t", **options
    )


def _table(spark, folder):
    return WideTable(spark, target_path(ACCOUNT, f"{folder}/t"))


def _rows(df):
    return sorted(map(tuple, df.select("recid", "date_last_update", "v").collect()))


def test_history_then_daily(spark, folder):
    first = _records(spark, [(1, "20260101", "a"), (2, "20260102", "b"), (3, None, "c")])
    done = _run(spark, folder, first, HISTORY, load_id="L1")
    assert (done.source_rows, done.commit.operation) == (3, "create")
    assert path_exists(spark, f"{folder}/raw/account_raw/load_id=L1")
    second = _records(spark, [(2, "20260103", ["x", "y"]), (4, "20260103", "z"), (1, "20260104", "no")])
    done = _run(spark, folder, second, DAILY, load_id="L2", today=date(2026, 1, 3))
    assert (done.source_rows, done.target_rows, done.commit.operation) == (2, 4, "merge")
    assert _rows(_table(spark, folder).read()) == [
        ("1", "20260101", ["a"]),
        ("2", "20260103", ["x", "y"]),
        ("3", None, ["c"]),
        ("4", "20260103", ["z"]),
    ]


def test_empty_batch_leaves_no_trace(spark, folder):
    df = _records(spark, [(1, "20260101", "a")])
    done = _run(spark, folder, df, DAILY, load_id="L1", today=date(2026, 5, 5))
    assert (done.source_rows, done.commit) == (0, None)
    assert not path_exists(spark, f"{folder}/raw/account_raw/load_id=L1")
    assert not _table(spark, folder).exists()


def test_windowed_history_keeps_other_rows(spark, folder):
    _run(spark, folder, _records(spark, [(1, "20260101", "a"), (2, "20260102", "b")]), HISTORY, load_id="L1")
    again = _records(spark, [(2, "20260102", "c")])
    done = _run(spark, folder, again, HISTORY, load_id="L2", window=("20260102", "20260102"))
    assert done.commit.operation == "merge"
    assert _rows(_table(spark, folder).read()) == [("1", "20260101", "a"), ("2", "20260102", "c")]
    _run(spark, folder, again, HISTORY, load_id="L3")
    assert _rows(_table(spark, folder).read()) == [("2", "20260102", "c")]


def test_the_source_is_asked_once(spark, folder):
    """Every row of the source adds one to a counter; a second query would show."""
    asked = spark.sparkContext.accumulator(0)

    def count(rows):
        for row in rows:
            asked.add(1)
            yield row

    df = _records(spark, [(k, "20260101", "a") for k in range(20)])
    counted = spark.createDataFrame(df.rdd.mapPartitions(count), df.schema)
    done = _run(spark, folder, counted, HISTORY, load_id="L1")
    assert (done.source_rows, asked.value) == (20, 20)


def test_a_longer_date_is_cut(spark, folder):
    df = _records(spark, [(1, "202601021530", "a"), (2, "20260103", "b")])
    done = _run(spark, folder, df, HISTORY, load_id="L1", window=("20260102", "20260102"))
    assert done.source_rows == 1
    assert {tuple(r) for r in Q.count_xml_by_date(df, "c167").collect()} == {("20260102", 1), ("20260103", 1)}


def test_one_dataset_failing(spark, folder):
    df = _records(spark, [(1, "20260101", "a")])

    def lookups(d):
        if d.name == "loan":
            raise ValueError("no lookup rows")
        return LOOKUP

    results = ingest_all(
        spark, [DATASETS["loan"], ACCOUNT], HISTORY, dataframe_records(df), lookups,
        f"{folder}/raw", f"{folder}/t",
    )
    assert [(r.dataset, r.error) for r in results] == [("loan", "no lookup rows"), ("account", None)]
    assert exit_code(results) == 1 and exit_code(results[1:]) == 0


# --- gap check ---------------------------------------------------------------


def _counts(spark, rows):
    return spark.createDataFrame(rows, "business_date string, row_count bigint")


def test_gaps(spark):
    source = _counts(spark, [("20260103", 5), ("20260101", 3), ("20260102", 1), ("20260104", 2), (None, 4)])
    target = _counts(spark, [("20260101", 3), ("20260102", 9), ("20260104", 1), ("20260105", 7), (None, 1)])
    found = Q.by_date(Q.gaps(source, target))
    assert [tuple(r) for r in found.collect()] == [
        ("20260103", 5, 0, 5),
        ("20260104", 2, 1, 1),
        (None, 4, 1, 3),
    ]
    lines = [r["line"] for r in Q.report(Q.gap_lines(found, "account")).orderBy("position").collect()]
    assert lines == [
        "account 20260103: oracle=5 bronze=0 (missing 5)",
        "account 20260104: oracle=2 bronze=1 (missing 1)",
        "account (no date): oracle=4 bronze=1 (missing 3)",
    ]
    assert Q.gap_summary(source, target).first().asDict() == {
        "source_rows": 15, "source_dates": 5, "target_rows": 21, "target_dates": 5, "gap_dates": 3,
    }


def test_empty_date_prints_as_none(spark):
    found = Q.gaps(_counts(spark, [("", 2)]), _counts(spark, []))
    assert Q.gap_lines(found, "d").first()["line"] == "d (no date): oracle=2 bronze=0 (missing 2)"


def test_window_drops_undated_rows(spark):
    df = spark.createDataFrame([("20260101",), ("20260102",), (None,)], "d string")
    assert {tuple(r) for r in Q.count_by_date(df, "d").collect()} == {
        ("20260101", 1), ("20260102", 1), (None, 1),
    }
    assert [tuple(r) for r in Q.count_by_date(df, "d", ("20260102", "20260131")).collect()] == [("20260102", 1)]


@pytest.mark.parametrize(("n", "want"), [(50, 50), (53, 51)])
def test_long_report(spark, n, want):
    source = _counts(spark, [(f"{20260000 + i}", 1) for i in range(n)])
    lines = Q.report(Q.gap_lines(Q.gaps(source, _counts(spark, [])), "d")).orderBy("position").collect()
    assert len(lines) == want
    assert [r["position"] for r in lines] == list(range(1, want + 1))
    if n > 50:
        assert lines[-1]["line"] == f"... and {n - 50} more (see task log)"


def test_report_keeps_the_order_of_datasets(spark):
    check = check_gaps(
        [DATASETS["loan"], DATASETS["account"]],
        lambda d, w: _counts(spark, [("20260102", 2), ("20260101", 2)]),
        lambda d: spark.createDataFrame([], "date_last_update string, disbursement_date string"),
    )
    lines = [r["line"] for r in check.report().orderBy("position").collect()]
    assert [line.split(":")[0] for line in lines] == [
        "loan 20260101", "loan 20260102", "account 20260101", "account 20260102",
    ]


def test_check_over_datasets(spark):
    datasets = [DATASETS["account"], DATASETS["loan"]]
    target = spark.createDataFrame([("20260101", "20260101")], "date_last_update string, disbursement_date string")
    check = check_gaps(
        datasets,
        lambda d, w: _counts(spark, [("20260101", 1 if d.name == "loan" else 2)]),
        lambda d: target,
    )
    assert {r["dataset"]: r["gap_dates"] for r in check.summary.collect()} == {"account": 1, "loan": 0}
    assert [r["line"] for r in check.report().collect()] == ["account 20260101: oracle=2 bronze=1 (missing 1)"]
    assert check.lines.where(F.col("dataset") == "loan").isEmpty()


def _shapes_are_not_looked_for(monkeypatch):
    def refuse(*args, **options):
        raise AssertionError("records were searched for shapes")

    monkeypatch.setattr("celloom.sources.shapes.profile_shapes", refuse)


def test_shapes_are_kept_with_a_landing(spark, folder, monkeypatch):
    df = _records(spark, [(1, "20260101", "ab"), (2, "20260102", "c")])
    _run(spark, folder, df, HISTORY, load_id="L1", columns=["v"])
    path = f"{folder}/raw/account_raw/load_id=L1"
    assert kept_shapes(spark, path) == {("c1", None): "list"}
    assert landed_shapes(spark, [path], LOOKUP) == {"v": "list", "date_last_update": "scalar"}
    assert read_landed(spark, path).count() == 2
    _shapes_are_not_looked_for(monkeypatch)
    assert landed_shapes(spark, [path], [LookupRow("c167", None, "other name")]) == {"other name": "scalar"}
    state = reparse(spark, ACCOUNT, ["L1"], LOOKUP, f"{folder}/raw", f"{folder}/again")
    assert state.live_rows == 2


def test_reparse_equals_the_loads(spark, folder, monkeypatch):
    _run(spark, folder, _records(spark, [(1, "20260101", "a"), (2, "20260102", "b"), (3, None, "c")]), HISTORY, load_id="L1")
    second = _records(spark, [(2, "20260103", ["x", "y"]), (4, "20260103", "z")])
    _run(spark, folder, second, DAILY, load_id="L2", today=date(2026, 1, 3))
    _shapes_are_not_looked_for(monkeypatch)
    reparse(spark, ACCOUNT, ["L1", "L2"], LOOKUP, f"{folder}/raw", f"{folder}/again")
    again = WideTable(spark, target_path(ACCOUNT, f"{folder}/again"))
    assert _rows(again.read()) == _rows(_table(spark, folder).read())


def test_merged_shapes_equal_those_of_all_records(spark, folder):
    rng = random.Random(6)
    tags = [f"c{k}" for k in range(1, 8)]
    rows = [LookupRow(t, m, f"{t}_{m}") for t in tags for m in (None, 1, 2)]
    paths, batches = [], []
    for load in range(4):
        xml = []
        for k in range(30):
            cells = "".join(
                f'<{t}{"".join(f" {a}=\"{rng.randint(1, 2)}\"" for a in "ms" if rng.random() < 0.08)}>v</{t}>'
                for t in tags
                if rng.random() < 0.4
            )
            xml.append((f"{load}-{k}", f"<row>{cells}</row>"))
        df = spark.createDataFrame(xml, "recid string, XMLRECORD string")
        paths.append(f"{folder}/load_id={load}")
        land_raw(df, paths[-1])
        batches.append(df)
        landed_shapes(spark, paths[-1:], rows)
    whole = batches[0].union(batches[1]).union(batches[2]).union(batches[3])
    merged = landed_shapes(spark, paths, rows)
    assert merged == profile_shapes(whole, rows)
    assert set(merged.values()) == {"scalar", "list", "nested"}


def test_datasets_are_selected_by_name(spark, folder):
    df = _records(spark, [(1, "20260101", "a")])
    results = ingest_all(spark, "loan account nope", HISTORY, dataframe_records(df), lambda d: LOOKUP, f"{folder}/raw", f"{folder}/t")
    assert [(r.dataset, r.target_rows) for r in results] == [("account", 1), ("loan", 1)]
    with pytest.raises(ValueError):
        ingest_all(spark, "nope", HISTORY, dataframe_records(df), lambda d: LOOKUP, f"{folder}/raw", f"{folder}/t")


def test_the_tables_buckets_follow_the_landed_bytes(spark, folder, monkeypatch):
    seen = []
    monkeypatch.setattr("celloom.table.bucket_count", lambda size, least: seen.append(size) or 2 * least)
    done = _run(spark, folder, _records(spark, [(k, "20260101", "a") for k in range(50)]), HISTORY, load_id="L1", buckets=4)
    assert done.commit.parts[0].buckets == 8 and done.target_rows == 50
    assert seen == [sum(f["file_size_in_bytes"] for f in data_files(spark, [done.landed]).collect())]


def test_a_daily_batch_is_parsed_by_several_tasks(spark, folder):
    """One source connection, but the landing has files for several parse tasks."""
    text = F.concat(*[F.sha2(F.concat("id", F.lit(f"-{k}")), 256) for k in range(8)])
    xml = F.concat(F.lit("<row><c1>"), text, F.lit("</c1><c167>20260103</c167></row>"))
    df = spark.range(20_000, numPartitions=1).select(F.col("id").cast("string").alias("recid"), xml.alias("XMLRECORD"))
    done = _run(spark, folder, df, DAILY, load_id="L1", today=date(2026, 1, 3))
    assert done.source_rows == 20_000
    assert data_files(spark, [done.landed]).count() >= 4


def test_a_table_without_a_namespace():
    assert target_path(ACCOUNT, "/t/") == "/t/bronze/account_wide"
    assert target_path(replace(ACCOUNT, target_table="wide"), "/t") == "/t/bronze/wide"
