import glob
from datetime import date

import pyarrow.parquet as pq
import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from celloom.functions.xml import business_date
from celloom.model import LookupRow
from celloom.sources.files import data_files, list_files, path_exists
from celloom.sources.generator import generate_records, next_key
from celloom.sources import landing as L
from celloom.sources.landing import land_raw, read_all_landed, read_landed, read_landed_window
from celloom.sources.lookup import load_lookup


def test_lookup(spark, folder):
    path = f"{folder}/lookup.csv"
    with open(path, "w", encoding="utf-8-sig") as f:
        f.write('"table_name","field_index","m_index","resolved_name_en","dt"\n')
        f.write("account,c20,18,amount,2026-01-01\n")
        f.write(" ACCOUNT , c3 ,  , title ,2026-01-01\n")
        f.write("loan,c1,,other,2026-01-01\n")
        f.write('account,c4," 2 ","with, comma",2026-01-01\n')
    assert load_lookup(spark, path, "Account") == [
        LookupRow("c20", 18, "amount"),
        LookupRow("c3", None, "title"),
        LookupRow("c4", 2, "with, comma"),
    ]
    with pytest.raises(ValueError):
        load_lookup(spark, path, "nothing")


def test_landing_never_overwrites(spark, folder):
    df = spark.createDataFrame([("1", "<row/>")], "recid string, XMLRECORD string")
    land_raw(df, f"{folder}/load_id=a")
    with pytest.raises(AnalysisException):
        land_raw(df, f"{folder}/load_id=a")
    land_raw(df, f"{folder}/load_id=b")
    land_raw(df, f"{folder}/load_id=b", mode="overwrite")
    assert read_landed(spark, f"{folder}/load_id=a").columns == ["recid", "XMLRECORD", "ingested_at"]
    assert {(r["recid"], r["load_id"]) for r in read_all_landed(spark, folder).collect()} == {
        ("1", "a"),
        ("1", "b"),
    }


def test_landing_bounds_files(spark, folder):
    df = spark.range(100).select(F.col("id").cast("string").alias("recid"), F.lit("<row/>").alias("XMLRECORD"))
    land_raw(df.coalesce(1), f"{folder}/l", max_records_per_file=10)
    assert data_files(spark, [f"{folder}/l"]).count() == 10


def _records(spark, n, days=60):
    """Records of some 600 bytes that do not compress, in one partition as from one source connection."""
    text = F.concat(*[F.sha2(F.concat("id", F.lit(f"-{k}")), 256) for k in range(8)])
    day = F.date_format(F.date_add(F.lit("2026-01-01").cast("date"), (F.col("id") * 7 % days).cast("int")), "yyyyMMdd")
    xml = F.concat(F.lit("<row><c1>"), text, F.lit("</c1><c9>"), day, F.lit("</c9></row>"))
    undated = F.concat(F.lit("<row><c1>"), text, F.lit("</c1></row>"))
    records = spark.range(n, numPartitions=1)
    return records.select(F.col("id").cast("string").alias("recid"), F.when(F.col("id") % 100 > 0, xml).otherwise(undated).alias("XMLRECORD"))


def test_one_connection_is_landed_and_parsed_by_several_tasks(spark, folder):
    records = _records(spark, 20_000)
    assert records.rdd.getNumPartitions() == 1
    land_raw(records, f"{folder}/one")
    land_raw(records, f"{folder}/many", spread=True)
    assert len(glob.glob(f"{folder}/one/*.parquet")) == 1
    sizes = [r["n"] for r in read_landed(spark, f"{folder}/many").groupBy(F.spark_partition_id()).agg(F.count("*").alias("n")).collect()]
    assert len(sizes) >= 4 and max(sizes) < 2 * min(sizes) and sum(sizes) == 20_000


def test_a_window_reads_the_row_groups_of_its_days(spark, folder, monkeypatch, capsys):
    monkeypatch.setattr(L, "DATED_GROUP_BYTES", 200_000)
    records = _records(spark, 20_000)
    land_raw(records, f"{folder}/dated", date_tag="c9")
    window = ("20260110", "20260112")
    found = read_landed_window(spark, f"{folder}/dated", window, "c9")
    want = {r["recid"] for r in records.where(business_date("XMLRECORD", "c9").between(*window)).collect()}
    assert {r["recid"] for r in found.collect()} == want and len(want) > 900
    found.explain("formatted")
    plan = capsys.readouterr().out
    assert "GreaterThanOrEqual(business_date,20260110)" in plan and "LessThanOrEqual(business_date,20260112)" in plan
    groups, needed = 0, 0
    for name in glob.glob(f"{folder}/dated/*.parquet"):
        meta = pq.ParquetFile(name).metadata
        at = meta.schema.names.index("business_date")
        for k in range(meta.num_row_groups):
            stats = meta.row_group(k).column(at).statistics
            groups += 1
            needed += bool(stats.has_min_max and stats.min <= window[1] and stats.max >= window[0])
    assert groups > 30 and needed <= groups / 5
    # records without a date are landed too, and in no window
    landed = read_landed(spark, f"{folder}/dated")
    assert landed.count() == 20_000 and landed.where("business_date IS NULL").count() == 200


def test_a_window_of_records_landed_without_dates(spark, folder):
    land_raw(_records(spark, 500), f"{folder}/plain")
    window = ("20260110", "20260112")
    dated = read_landed_window(spark, f"{folder}/plain", window, "c9")
    assert {r["business_date"] for r in dated.collect()} == {"20260110", "20260111", "20260112"}
    assert read_landed_window(spark, f"{folder}/plain", None, "c9").count() == 500


def test_file_listing(spark, folder):
    assert not path_exists(spark, f"{folder}/x")
    assert list_files(spark, [f"{folder}/x"]).count() == 0
    assert data_files(spark, []).count() == 0
    spark.range(10).repartition(2).write.parquet(f"{folder}/x")
    listed = {r["file_path"].split("/")[-1]: r["file_size_in_bytes"] for r in list_files(spark, [f"{folder}/x"]).collect()}
    data = data_files(spark, [f"{folder}/x"]).collect()
    assert {r["file_path"].split("/")[-1]: r["file_size_in_bytes"] for r in data} == listed
    assert sum(r["record_count"] for r in data) == 10
    assert {r["content"] for r in data} == {0}


def test_generated_rows(spark):
    template = '<row id="x"><c1>k</c1><c9>old</c9><g><c9 m="2">old</c9></g></row>'
    df = generate_records(spark, template, 10_000, 500, "c9", date(2026, 1, 1), date(2026, 12, 31))
    assert df.count() == df.select("recid").distinct().count() == 10_000
    assert df.agg(F.min(F.col("recid").cast("bigint")), F.max(F.col("recid").cast("bigint"))).first() == (500, 10_499)
    days = df.groupBy(business_date("XMLRECORD", "c9").alias("d")).count()
    assert days.count() == 365
    assert {r["count"] for r in days.collect()} == {27, 28}
    one = df.where("recid = '866'").first()["XMLRECORD"]
    assert one == '<row id="866"><c1>k</c1><c9>20260102</c9><g><c9 m="2">20260102</c9></g></row>'


def test_next_key(spark):
    df = spark.createDataFrame([("5",), ("70",), ("9",)], "recid string")
    assert next_key(df, "recid", 6).first()[0] == 71
    assert next_key(df, "recid", 71).first()[0] == 71
    assert next_key(df, "recid", 100).first()[0] == 100


def test_a_landing_is_packed(spark, folder):
    import glob

    import pyarrow.parquet as pq

    records = _records(spark, 3000)
    land_raw(records, f"{folder}/packed")
    land_raw(records, f"{folder}/dated", date_tag="c9")
    for path in glob.glob(f"{folder}/*/*.parquet"):
        group = pq.ParquetFile(path).metadata.row_group(0)
        assert {group.column(k).compression for k in range(group.num_columns)} == {"ZSTD"}


def test_only_an_uneven_scan_is_dealt_out(spark, folder):
    from celloom.queries import _spread_table

    rows = spark.range(4000)
    rows.repartition(8).write.parquet(f"{folder}/even")
    rows.coalesce(1).write.parquet(f"{folder}/one")
    spark.conf.set("spark.sql.files.openCostInBytes", "64m")  # a task a file
    try:
        for name, dealt in (("even", False), ("one", True)):
            spread = _spread_table(spark.read.parquet(f"{folder}/{name}"))
            assert ("REBALANCE" in spread._jdf.queryExecution().executedPlan().toString()) == dealt
            assert spread.count() == 4000
    finally:
        spark.conf.unset("spark.sql.files.openCostInBytes")
