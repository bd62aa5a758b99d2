"""Every operator as a query over the benchmark tables.

Each takes (spark, folder of Parquet tables) and returns a DataFrame. Lists
are shown as joined text, with ``~`` for a NULL item, so that results compare
as plain rows. Queries that need stored data write it below the session's
shared folder.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from celloom import fixtures as X
from celloom.functions.xml import business_date, in_window
from celloom.model import DAILY, HISTORY, Dataset, RunMode
from celloom.operators import parsing as P
from celloom.operators import quality as Q
from celloom.operators import storage as S
from celloom.operators.parsing import PARSED, parse_wide, with_cells
from celloom.operators.reconcile import fit_batch, migrate_table, reconciled_schema
from celloom.operators.shapes import LIST, NESTED, list_sizes, normalize_arrays, sub_value_tags
from celloom.plans.gapcheck import GapCheck, check_gaps
from celloom.plans.ingest import dataframe_records, ingest, ingest_all, reparse, target_ledger, target_path
from celloom.plans.ledger import compared, dated_keys
from celloom.plans.maintenance import compact, maintain
from celloom.sources.generator import next_key, stamp_records
from celloom.sources.jdbc import hash_bucket
from celloom.sources.landing import land_raw, read_all_landed, read_landed, read_landed_window
from celloom.sources.lookup import read_lookup
from celloom.table import WideTable
from celloom.workspace import new_folder

Query = Callable[[SparkSession, str], DataFrame]

ORDERS = Dataset("orders", "orders", "bronze.orders_wide", "c167", "order_date")
LINES = Dataset("lines", "lineitem", "bronze.lines_wide", "c167", "ship_date")
WINDOW = ("19960101", "19961231")
# All records of a source merged into what is there.
MERGED = RunMode("merged", "merge", 16, None)


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def _orders(spark: SparkSession, folder: str) -> DataFrame:
    return _table(spark, folder, "orders")


def _spread(rows: DataFrame) -> DataFrame:
    """Narrow rows of a small file over the cores, before each becomes a record of XML."""
    return rows.hint("rebalance")


def _spread_table(table: DataFrame) -> DataFrame:
    """A table over the cores: as it is where its scan has work for all of them, which footers tell."""
    of_task = table.groupBy(F.spark_partition_id().alias("task")).agg(F.count(F.lit(1)).alias("n"))
    size = of_task.agg(F.max("n").alias("most"), F.sum("n").alias("rows")).first()
    cores = table.sparkSession.sparkContext.defaultParallelism
    even = (size["most"] or 0) * cores <= 2 * (size["rows"] or 0)
    return table if even else _spread(table)


def _order_records(spark: SparkSession, folder: str) -> DataFrame:
    return X.order_records(_spread_table(_orders(spark, folder)))


def _line_records(spark: SparkSession, folder: str) -> DataFrame:
    return X.line_records(_spread_table(_table(spark, folder, "lineitem")))


def _landed(records: DataFrame) -> DataFrame:
    """Records landed first, as an ingest does: finding shapes reads them more than once."""
    path = new_folder(records.sparkSession, "records")
    land_raw(records, path)
    return read_landed(records.sparkSession, path)


def _line_rows(*names: str):
    return [r for r in X.LINE_LOOKUP if r.name in names]


def _lines(spark: SparkSession, folder: str, *names: str, normalize: bool = False) -> DataFrame:
    records = _landed(_line_records(spark, folder))
    return parse_wide(records, X.LINE_LOOKUP, columns=list(names), normalize=normalize)


def joined(column: Column | str) -> Column:
    return F.array_join(column, ",", "~")


def joined_nested(column: str) -> Column:
    return F.array_join(F.transform(column, lambda inner: joined(inner)), ";", "~")


# --- parsing -------------------------------------------------------------


def xml_parse(spark: SparkSession, folder: str) -> DataFrame:
    parsed = with_cells(_line_records(spark, folder), _line_rows("part", "never_there", "absent_group"))

    def shown(tag: str) -> Column:
        none = F.lit("~")
        return F.array_join(
            F.transform(
                F.col(PARSED)[tag],
                lambda c: F.concat_ws(
                    ":",
                    F.coalesce(c["_m"].cast("string"), none),
                    F.coalesce(c["_s"].cast("string"), none),
                    F.coalesce(c["_VALUE"], none),
                ),
            ),
            ",",
        )

    return parsed.select(
        "recid", shown("c20").alias("c20"), shown("c0").alias("c0"), shown("c50").alias("c50")
    )


def wide_parse(spark: SparkSession, folder: str) -> DataFrame:
    wide = parse_wide(_landed(_order_records(spark, folder)), X.ORDER_LOOKUP)
    return wide.withColumn("priority", joined("priority"))


def column_subset(spark: SparkSession, folder: str) -> DataFrame:
    """Two wide columns by name."""
    records = _landed(_order_records(spark, folder))
    return parse_wide(records, X.ORDER_LOOKUP, columns=["order_date", "status"])


def first_columns(spark: SparkSession, folder: str) -> DataFrame:
    """The first wide columns of the lookup."""
    return parse_wide(_landed(_order_records(spark, folder)), X.ORDER_LOOKUP, columns=3)


def mv_fixed_group(spark: SparkSession, folder: str) -> DataFrame:
    names = ("part", "supplier", "group_values", "returned_part", "absent_group")
    return _lines(spark, folder, *names).select("recid", *[joined(n).alias(n) for n in names])


def mv_list(spark: SparkSession, folder: str) -> DataFrame:
    names = ("dense_list", "sparse_list", "repeated_list", "never_there")
    return _lines(spark, folder, *names).select("recid", *[joined(n).alias(n) for n in names])


def mv_two_level(spark: SparkSession, folder: str) -> DataFrame:
    wide = _lines(spark, folder, "nested_values")
    return wide.select("recid", joined_nested("nested_values").alias("nested_values"))


def subvalue_detect(spark: SparkSession, folder: str) -> DataFrame:
    parsed = with_cells(_line_records(spark, folder), X.LINE_LOOKUP)
    tags = sub_value_tags(parsed, X.LINE_LOOKUP, PARSED)
    return spark.createDataFrame([(t,) for t in sorted(tags)], "tag string")


def max_list_size(spark: SparkSession, folder: str) -> DataFrame:
    names = ("part", "group_values", "dense_list", "sparse_list", "nested_values", "never_there")
    return list_sizes(_lines(spark, folder, *names))


def normalize(spark: SparkSession, folder: str) -> DataFrame:
    names = ("return_flag", "part", "returned_part", "absent_group", "explicit_first", "never_there")
    lists = ("group_values", "dense_list")
    wide = normalize_arrays(_lines(spark, folder, *names, *lists))
    return wide.select("recid", *names, *[joined(n).alias(n) for n in lists])


def pinned_shapes(spark: SparkSession, folder: str) -> DataFrame:
    """Shapes given instead of profiled: the same batch, forced to greater depth."""
    shapes = {"explicit_first": LIST, "dense_list": NESTED}
    wide = parse_wide(
        _line_records(spark, folder), X.LINE_LOOKUP, columns=list(shapes), shapes=shapes
    )
    return wide.select(
        "recid",
        joined("explicit_first").alias("explicit_first"),
        joined_nested("dense_list").alias("dense_list"),
    )


def tag_census(spark: SparkSession, folder: str) -> DataFrame:
    """Which tags the records of all lines hold, and which of them a short lookup leaves out."""
    return P.tag_census(_line_records(spark, folder), _line_rows("return_flag", "part", "dense_list", "never_there"))


def corrupt_records(spark: SparkSession, folder: str) -> DataFrame:
    """Orders of which those of status O are cut before their end: told by the parse that makes the columns."""
    xml = F.col("XMLRECORD")
    cut = F.when(xml.contains("<c8>O</c8>"), F.left(xml, F.length(xml) - F.lit(4))).otherwise(xml)
    records = _landed(_order_records(spark, folder).withColumn("XMLRECORD", cut))
    wide = parse_wide(records, X.ORDER_LOOKUP, columns=["customer", "order_date"], corrupt="corrupt")
    return wide.withColumn("corrupt", F.length("corrupt") > 0)


def lookup_load(spark: SparkSession, folder: str) -> DataFrame:
    """A mapping file made of the part table, read for one of its table names."""
    path = new_folder(spark, "lookup")
    part = _table(spark, folder, "part")
    part.select(
        F.concat(F.lit("  "), F.upper("p_brand"), F.lit(" ")).alias("table_name"),
        F.concat(F.lit("c"), "p_partkey").alias("field_index"),
        F.when(F.col("p_size") % 2 == 0, F.col("p_size").cast("string"))
        .otherwise("")
        .alias("m_index"),
        F.concat(F.lit(" "), "p_name", F.lit(", "), "p_type").alias("resolved_name_en"),
        F.lit("2026-01-01").alias("dt"),
    ).write.csv(path, header=True, escape='"')
    return read_lookup(spark, path, "brand#11")


# --- dates, counts, gaps -------------------------------------------------


def date_extract(spark: SparkSession, folder: str) -> DataFrame:
    return _order_records(spark, folder).select(
        "recid", business_date("XMLRECORD", "c167").alias("business_date")
    )


def window_filter(spark: SparkSession, folder: str) -> DataFrame:
    return date_extract(spark, folder).where(in_window(F.col("business_date"), WINDOW))


def count_by_date(spark: SparkSession, folder: str) -> DataFrame:
    return Q.count_xml_by_date(_order_records(spark, folder), "c167")


def _with_lines(spark: SparkSession, folder: str) -> DataFrame:
    """Orders that have lines: what a target short of some rows might hold."""
    keys = _table(spark, folder, "lineitem").select("l_orderkey").distinct()
    orders = _orders(spark, folder)
    return orders.join(keys, orders.o_orderkey == keys.l_orderkey, "left_semi")


def _gap_check(spark: SparkSession, folder: str, window=None) -> GapCheck:
    records = _landed(_order_records(spark, folder))
    target = parse_wide(_landed(X.order_records(_spread(_with_lines(spark, folder)))), X.ORDER_LOOKUP)
    return check_gaps(
        [ORDERS],
        lambda d, w: Q.count_xml_by_date(records, d.date_tag, w),
        lambda d: target,
        window,
    )


def _both_counts(spark: SparkSession, folder: str, window=None) -> tuple[DataFrame, DataFrame]:
    """Records counted by the date in their XML, a table by its date column."""
    source = Q.count_xml_by_date(_order_records(spark, folder), "c167", window)
    landed = _landed(X.order_records(_spread(_with_lines(spark, folder))))
    wide = parse_wide(landed, X.ORDER_LOOKUP, columns=["order_date"])
    return source, Q.count_by_date(wide, "order_date", window)


def count_outer_join(spark: SparkSession, folder: str) -> DataFrame:
    by_order = Q.count_by_date(_orders(spark, folder), X.day_text("o_orderdate"))
    by_ship = Q.count_by_date(_table(spark, folder, "lineitem"), X.day_text("l_shipdate"))
    return Q.align_counts(by_order, by_ship)


def gap_check(spark: SparkSession, folder: str) -> DataFrame:
    return Q.by_date(Q.gaps(*_both_counts(spark, folder)))


def gap_check_window(spark: SparkSession, folder: str) -> DataFrame:
    return Q.by_date(Q.gaps(*_both_counts(spark, folder, WINDOW)))


def gap_summary(spark: SparkSession, folder: str) -> DataFrame:
    return _gap_check(spark, folder).summary


def gap_report(spark: SparkSession, folder: str) -> DataFrame:
    return _gap_check(spark, folder).report()


def gap_report_datasets(spark: SparkSession, folder: str) -> DataFrame:
    """Two datasets in one check: lines against those returned, orders against those with lines."""
    day = X.day_text("l_shipdate")
    lines = _table(spark, folder, "lineitem").select(day.alias("ship_date"), "l_returnflag")
    orders, target = _orders(spark, folder), _with_lines(spark, folder)
    sources = {"lines": lines, "orders": orders.select(X.day_text("o_orderdate").alias("order_date"))}
    targets = {"lines": lines.where("l_returnflag <> 'R'"), "orders": target.select(X.day_text("o_orderdate").alias("order_date"))}
    return check_gaps(
        [LINES, ORDERS],
        lambda d, w: Q.count_by_date(sources[d.name], d.date_column, w),
        lambda d: targets[d.name],
        ("19960101", "19960115"),
    ).report()


def gap_ledger(spark: SparkSession, folder: str) -> DataFrame:
    """Orders loaded, then those of status F a day later than before: a check that reads only what the loads left.

    The source lacks customer 1's orders and has the O orders of one month
    under other keys, so that on those days counts agree and keys do not.
    """
    root = new_folder(spark, "ledger")
    orders = _orders(spark, folder)
    later = orders.where("o_orderstatus = 'F'").withColumn("o_orderdate", F.date_add(F.to_date("o_orderdate"), 1))
    for df, mode, load_id in ((orders, HISTORY, "20260101T000000"), (later, MERGED, "20260102T000000")):
        ingest(
            spark,
            ORDERS,
            mode,
            dataframe_records(X.order_records(_spread(df))),
            X.ORDER_LOOKUP,
            f"{root}/raw",
            f"{root}/tables",
            load_id=load_id,
            ledger=True,
        )
    day = F.when(F.col("o_orderstatus") != "P", F.date_format("o_orderdate", "yyyyMMdd"))
    moved = F.when(F.col("o_orderstatus") == "F", F.date_add(F.to_date("o_orderdate"), 1)).otherwise(F.to_date("o_orderdate"))
    renamed = (F.col("o_orderstatus") == "O") & F.col("day").startswith("199603")
    source = (
        orders.where("o_custkey <> 1")
        .withColumn("o_orderdate", moved)
        .select(day.alias("day"), "o_orderstatus", F.col("o_orderkey").cast("string").alias("recid"))
        .withColumn("recid", F.when(renamed, F.concat(F.lit("X"), "recid")).otherwise(F.col("recid")))
    )
    version = WideTable(spark, target_path(ORDERS, f"{root}/tables")).current().version
    kept = target_ledger(spark, ORDERS, f"{root}/tables").totals(version)
    return compared(dated_keys(source, "day", "recid"), kept)


# --- landing -------------------------------------------------------------


def raw_landing(spark: SparkSession, folder: str) -> DataFrame:
    """Two runs landed side by side, read as one with their load ids."""
    root = new_folder(spark, "landing")
    records = _order_records(spark, folder)
    land_raw(records, f"{root}/load_id=20260101T000000")
    land_raw(read_landed(spark, f"{root}/load_id=20260101T000000"), f"{root}/load_id=20260102T000000")
    return read_all_landed(spark, root).select(
        "recid",
        F.col("load_id").cast("string").alias("load_id"),
        business_date("XMLRECORD", "c167").alias("business_date"),
    )


def reland_overwrite(spark: SparkSession, folder: str) -> DataFrame:
    """A run landed again under its own load id, on purpose: the later records replace the earlier."""
    root = new_folder(spark, "reland")
    orders = _orders(spark, folder)
    for rows in (orders, orders.where("o_orderstatus = 'F'")):
        land_raw(X.order_records(_spread(rows)), f"{root}/load_id=20260101T000000", mode="overwrite")
    return read_all_landed(spark, root).select("recid", F.col("load_id").cast("string").alias("load_id"))


def landed_window(spark: SparkSession, folder: str) -> DataFrame:
    """Records landed by business date, a year of them read: the filter is the scan's."""
    path = new_folder(spark, "dated")
    land_raw(_order_records(spark, folder), path, date_tag="c167")
    return read_landed_window(spark, path, WINDOW, "c167").select("recid", "business_date")


def hash_split(spark: SparkSession, folder: str) -> DataFrame:
    """Records read bucket by bucket: how often each is read, and how many buckets have any."""
    records = _order_records(spark, folder).select("recid", hash_bucket("recid", 16).alias("pkey"))
    read = reduce(DataFrame.unionByName, [records.where(F.col("pkey") == k) for k in range(16)])
    filled = read.agg(F.countDistinct("pkey").alias("filled_buckets"))
    return read.groupBy("recid").agg(F.count(F.lit(1)).alias("row_count")).crossJoin(filled)  # one row


# --- tables --------------------------------------------------------------


def _order_rows(df: DataFrame) -> DataFrame:
    return df.select(
        F.col("o_orderkey").cast("string").alias("recid"),
        F.col("o_orderstatus").alias("status"),
        X.amount_text("o_totalprice").alias("price"),
    )


def merge_upsert(spark: SparkSession, folder: str) -> DataFrame:
    """Orders, then their last ship dates and all customers, then the P orders once more."""
    orders = _orders(spark, folder)
    table = WideTable(spark, new_folder(spark, "merge"))
    table.load(_order_rows(orders), "merge")
    shipped = (
        _table(spark, folder, "lineitem")
        .groupBy(F.col("l_orderkey").cast("string").alias("recid"))
        .agg(F.date_format(F.max(F.to_date("l_shipdate")), "yyyyMMdd").alias("ship_date"))
        .withColumn("status", F.lit("L"))
    )
    customers = _table(spark, folder, "customer").select(
        F.concat(F.lit("C"), "c_custkey").alias("recid"),
        F.lit(None).cast("string").alias("ship_date"),
        F.col("c_mktsegment").alias("status"),
    )
    table.load(shipped.unionByName(customers), "merge")
    table.load(_order_rows(orders.where("o_orderstatus = 'P'")), "merge")
    return table.read()


def replace_load(spark: SparkSession, folder: str) -> DataFrame:
    """A wide load replaced by a narrower one: depth and columns stay."""
    orders = _orders(spark, folder)
    table = WideTable(spark, new_folder(spark, "replace"))
    wide = orders.select(
        F.col("o_orderkey").cast("string").alias("recid"),
        F.split("o_orderpriority", "-").alias("priority"),
        F.split("o_orderpriority", "-").alias("words"),
        F.col("o_orderstatus").alias("status"),
    )
    table.load(wide, "replace")
    table.load(
        orders.select(
            F.col("o_orderkey").cast("string").alias("recid"),
            F.when(F.col("o_orderstatus") != "P", F.col("o_orderpriority")).alias("priority"),
            X.day_text("o_orderdate").alias("order_date"),
        ),
        "replace",
    )
    return table.read().select(
        "recid",
        F.size("priority").alias("priority_size"),
        joined("priority").alias("priority"),
        F.size("words").alias("words_size"),
        "status",
        "order_date",
    )


def ingest_history(spark: SparkSession, folder: str) -> DataFrame:
    """Orders landed, parsed and loaded: the whole way once."""
    root = new_folder(spark, "ingest")
    ingest(
        spark,
        ORDERS,
        HISTORY,
        dataframe_records(_order_records(spark, folder)),
        X.ORDER_LOOKUP,
        f"{root}/raw",
        f"{root}/tables",
    )
    wide = WideTable(spark, f"{root}/tables/bronze/orders_wide").read()
    return wide.withColumn("priority", joined("priority"))


def _two_runs(spark: SparkSession, folder: str, root: str) -> list[str]:
    """All orders loaded, then one year of changed orders; the load ids."""
    orders = _orders(spark, folder)
    status = F.col("o_orderstatus")
    changed = orders.withColumn("o_orderstatus", F.when(status != "P", F.lower(status)).otherwise(status))
    loads = ["20260101T000000", "20260102T000000"]
    for df, window, load_id in ((orders, None, loads[0]), (changed, WINDOW, loads[1])):
        ingest(
            spark,
            ORDERS,
            HISTORY,
            dataframe_records(X.order_records(_spread(df))),
            X.ORDER_LOOKUP,
            f"{root}/raw",
            f"{root}/tables",
            window=window,
            load_id=load_id,
        )
    return loads


def windowed_history_merge(spark: SparkSession, folder: str) -> DataFrame:
    """All orders loaded, then one year of changed orders: the other years stay."""
    root = new_folder(spark, "window")
    _two_runs(spark, folder, root)
    table = WideTable(spark, f"{root}/tables/bronze/orders_wide")
    return table.read().select("recid", "status", "order_date", "customer")


def reparse_landed(spark: SparkSession, folder: str) -> DataFrame:
    """Two landed runs parsed once more into another table, by the shapes that are kept with them."""
    root = new_folder(spark, "reparse")
    loads = _two_runs(spark, folder, root)
    reparse(spark, ORDERS, loads, X.ORDER_LOOKUP, f"{root}/raw", f"{root}/again")
    wide = WideTable(spark, f"{root}/again/bronze/orders_wide").read()
    return wide.select("recid", "status", "order_date", joined("priority").alias("priority"))


def daily_merge(spark: SparkSession, folder: str) -> DataFrame:
    """All orders loaded, then one day's run over changed orders: only that day's change."""
    root = new_folder(spark, "daily")
    orders = _orders(spark, folder)
    status = F.col("o_orderstatus")
    changed = orders.withColumn("o_orderstatus", F.when(status != "P", F.lower(status)).otherwise(status))
    for df, mode, load_id in ((orders, HISTORY, "20260101T000000"), (changed, DAILY, "20260102T000000")):
        ingest(
            spark,
            ORDERS,
            mode,
            dataframe_records(X.order_records(_spread(df))),
            X.ORDER_LOOKUP,
            f"{root}/raw",
            f"{root}/tables",
            load_id=load_id,
            today=date(1996, 3, 5),
        )
    table = WideTable(spark, f"{root}/tables/bronze/orders_wide")
    return table.read().select("recid", "status", "order_date", "customer")


def empty_batch(spark: SparkSession, folder: str) -> DataFrame:
    """Orders loaded, then a run over a window without any: nothing is landed, the table stays."""
    root = new_folder(spark, "empty")
    results = [
        ingest(
            spark,
            ORDERS,
            HISTORY,
            dataframe_records(_order_records(spark, folder)),
            X.ORDER_LOOKUP,
            f"{root}/raw",
            f"{root}/tables",
            window=window,
            load_id=load_id,
        )
        for window, load_id in ((None, "20260101T000000"), (("18000101", "18001231"), "20260102T000000"))
    ]
    loads = read_all_landed(spark, f"{root}/raw/orders_raw").select("load_id").distinct().count()
    table = WideTable(spark, f"{root}/tables/bronze/orders_wide").read()
    return table.select(
        "recid", F.lit(results[1].source_rows).cast("bigint").alias("second_rows"), F.lit(loads).cast("bigint").alias("loads")
    )


BROKEN = Dataset("broken", "nowhere", "bronze.broken_wide", "c167", "order_date")


def ingest_datasets(spark: SparkSession, folder: str) -> DataFrame:
    """Orders, lines and a dataset without a source in one run, at the same time: what each reports."""
    root = new_folder(spark, "datasets")
    sources = {"orders": _order_records(spark, folder), "lines": _line_records(spark, folder)}
    lookups = {"orders": X.ORDER_LOOKUP, "lines": _line_rows("return_flag", "ship_date", "dense_list")}
    results = ingest_all(
        spark,
        [ORDERS, BROKEN, LINES],
        HISTORY,
        lambda d, mode, window: sources[d.name],
        lambda d: lookups.get(d.name, ()),
        f"{root}/raw",
        f"{root}/tables",
    )
    rows = [(r.dataset, r.source_rows, r.target_rows, r.error is not None) for r in results]
    return spark.createDataFrame(rows, "dataset string, source_rows bigint, target_rows bigint, failed boolean")


def _depths(orders: DataFrame, *depths: int) -> DataFrame:
    """recid and one column per depth asked for; status P has no values."""
    text = F.when(F.col("o_orderstatus") != "P", F.col("o_orderpriority"))
    words = F.split(text, "-")
    built = {0: text, 1: words, 2: F.transform(words, lambda w: F.array(w))}
    return orders.select(
        F.col("o_orderkey").cast("string").alias("recid"),
        *[built[d].alias(f"c{i}") for i, d in enumerate(depths)],
    )


def _flat_text(df: DataFrame, *columns: str) -> DataFrame:
    """Lists of lists as text, NULL and [] kept apart."""
    return df.select(
        "recid",
        *[
            F.coalesce(
                F.concat(
                    F.lit("["),
                    F.array_join(
                        F.transform(c, lambda i: F.concat(F.lit("["), joined(i), F.lit("]"))), ",", "~"
                    ),
                    F.lit("]"),
                ),
                F.lit("null"),
            ).alias(c)
            for c in columns
        ],
    )


def reconcile_add_missing(spark: SparkSession, folder: str) -> DataFrame:
    """Columns only one side has: [] or NULL in the batch, NULL in stored rows."""
    orders = _orders(spark, folder)
    table = WideTable(spark, new_folder(spark, "missing"))
    stored, batch = orders.where("o_orderstatus = 'F'"), orders.where("o_orderstatus <> 'F'")
    table.load(
        _depths(stored, 0, 1).withColumnsRenamed({"c0": "old_text", "c1": "old_list"}), "merge"
    )
    table.load(
        _depths(batch, 0, 1).withColumnsRenamed({"c0": "new_text", "c1": "new_list"}), "merge"
    )
    return table.read().select(
        "recid",
        "old_text",
        "new_text",
        F.coalesce(F.size("old_list"), F.lit(-1)).alias("old_size"),
        F.coalesce(F.size("new_list"), F.lit(-1)).alias("new_size"),
    )


def reconcile_widen_table(spark: SparkSession, folder: str) -> DataFrame:
    """Stored text and lists taken to the depth of a deeper batch."""
    orders = _orders(spark, folder)
    stored = _depths(orders, 0, 1, 0)
    batch = _depths(orders, 2, 2, 1)
    target = reconciled_schema(batch.schema, stored.schema)
    moved = migrate_table(stored, target)
    return _flat_text(moved.withColumn("c2", F.array("c2")), "c0", "c1", "c2")


def reconcile_wrap_batch(spark: SparkSession, folder: str) -> DataFrame:
    """Batch text and lists wrapped to the depth of a deeper table."""
    orders = _orders(spark, folder)
    fitted = fit_batch(_depths(orders, 0, 1, 0), _depths(orders, 2, 2, 1).schema)
    return _flat_text(fitted.withColumn("c2", F.array("c2")), "c0", "c1", "c2")


# --- maintenance ---------------------------------------------------------


def file_stats(spark: SparkSession, folder: str) -> DataFrame:
    """Orders, some merged once more: counts of the files, checked against the files that rows come from."""
    orders = _orders(spark, folder)
    table = WideTable(spark, new_folder(spark, "stats"))
    table.load(_order_rows(orders), "merge")
    table.load(_order_rows(orders.where("o_orderstatus = 'F'")), "merge")
    state = table.current()
    stored = spark.read.parquet(*[table.part_path(p) for p in (*state.parts, state.delta)])
    seen = stored.select("_metadata.file_path").distinct().agg(F.count("*").alias("seen"))
    return S.file_stats(table.files(), table.read()).crossJoin(seen).select(
        (F.col("data_files") - F.col("seen")).alias("files_missed"),
        "delete_files",
        "stored_records",
        "live_rows",
        (F.col("bytes") > 0).alias("has_bytes"),
    )


def conditional_aggs(spark: SparkSession, folder: str) -> DataFrame:
    """A conditional count and a filtered sum over lines."""
    lines = _table(spark, folder, "lineitem")
    return S.file_totals(
        lines.select(
            F.when(F.col("l_returnflag") == "R", F.col("l_linenumber"))
            .otherwise(0)
            .alias("content"),
            F.col("l_partkey").alias("file_size_in_bytes"),
            F.col("l_quantity").cast("bigint").alias("record_count"),
        )
    )


def compact_preserves_rows(spark: SparkSession, folder: str) -> DataFrame:
    """Orders with some merged once more, rewritten as fewer files."""
    orders = _orders(spark, folder)
    table = WideTable(spark, new_folder(spark, "compact"))
    table.load(_order_rows(orders), "merge")
    merged = _order_rows(orders.where("o_orderstatus = 'F'")).withColumn("status", F.lit("merged"))
    table.load(merged, "merge")
    done = compact(table)
    fewer = done.after["data_files"] < done.before["data_files"]
    return table.read().withColumn("fewer_files", F.lit(fewer))


def compact_to_size(spark: SparkSession, folder: str) -> DataFrame:
    """Lines merged order year by order year into a table, then written to files of a target size.

    No file is above the target, and none small, which a bucket's only file may be.
    """
    lines = _table(spark, folder, "lineitem").select(
        F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey").alias("recid"),
        F.col("l_returnflag").alias("flag"),
        F.sha2(F.concat_ws("-", "l_orderkey", "l_linenumber"), 256).alias("digest"),
        F.year(F.to_date("l_shipdate")).alias("year"),
    )
    table = WideTable(spark, new_folder(spark, "sized"))
    for first, last in ((0, 1994), (1995, 1996), (1997, 9999)):
        table.load(lines.where(F.col("year").between(first, last)).drop("year"), "merge")
    target, small = 96 << 10, 16 << 10
    compact(table, target_bytes=target, small_bytes=small)
    again = compact(table, target_bytes=target, small_bytes=small)
    files = table.files()
    of_bucket = files.groupBy("bucket").agg(
        F.max("file_size_in_bytes").alias("largest"), F.min("file_size_in_bytes").alias("least"), F.count("*").alias("n")
    )
    kept = of_bucket.agg(
        (F.max("largest") <= target).alias("none_above"),
        (F.count_if((F.col("least") < small) & (F.col("n") > 1)) == 0).alias("none_small"),
    )
    return table.read().crossJoin(kept).withColumn("settled", F.lit(not again.published))  # one row


def merge_keyless(spark: SparkSession, folder: str) -> DataFrame:
    """Orders of which a half has no key, merged twice: rows without a key are never overwritten."""
    orders = _order_rows(_orders(spark, folder))
    key = F.when(F.col("status") == "F", F.col("recid"))
    table = WideTable(spark, new_folder(spark, "keyless"))
    for _ in range(2):
        table.load(orders.withColumn("recid", key), "merge")
    compact(table)
    rows, n = table.read(), F.count(F.lit(1)).alias("row_count")
    # rows without a key lie in one bucket: grouped by the key, they would all be one task's
    keyed = rows.where("recid IS NOT NULL").groupBy("recid", "status", "price").agg(n)
    keyless = rows.where("recid IS NULL").groupBy("status", "price").agg(n)
    return keyed.unionByName(keyless.withColumn("recid", F.lit(None).cast("string")))


def maintenance_run(spark: SparkSession, folder: str) -> DataFrame:
    """Tables below two schemas found, looked at by a dry run, then compacted: counts of each."""
    root = new_folder(spark, "maintained")
    orders = _order_rows(_orders(spark, folder))
    customers = _table(spark, folder, "customer").select(
        F.col("c_custkey").cast("string").alias("recid"), F.col("c_mktsegment").alias("segment")
    )
    for name, first, second in (
        ("bronze/orders_wide", orders, orders.where("status = 'F'")),
        ("silver/customer_wide", customers, customers.where("segment = 'BUILDING'")),
    ):
        table = WideTable(spark, f"{root}/{name}")
        table.load(first, "merge")
        table.load(second, "merge")
    schemas = ["bronze", "silver", "gold"]
    dry = {d.table: d.published for d in maintain(spark, root, schemas, check_only=True)}
    rows = [
        (
            d.table.removeprefix(f"{root}/"),
            dry[d.table],
            d.published,
            d.before["stored_records"],
            d.after["stored_records"],
            d.after["live_rows"],
        )
        for d in maintain(spark, root, schemas)
    ]
    return spark.createDataFrame(
        rows, "name string, dry boolean, published boolean, stored_before bigint, stored_after bigint, live_rows bigint"
    )


# --- keys and generated volume -------------------------------------------


def next_free_key(spark: SparkSession, folder: str) -> DataFrame:
    records = _order_records(spark, folder)
    return next_key(records, "recid", 100)


TEMPLATE = """<row id="0">
  <c1>first</c1>
  <c167>20200101</c167>
  <c20 m="2"></c20>
  <c167 m="2">20200102</c167>
</row>"""


def generate_rows(spark: SparkSession, folder: str) -> DataFrame:
    """A copy of one record per order, keys counted up and dates cycling through 30 days."""
    made = stamp_records(
        _orders(spark, folder), "o_orderkey", TEMPLATE, 9_000_000_001, "c167",
        date(2026, 1, 15), date(2026, 2, 13),
    )
    return made.select(
        "recid",
        F.regexp_extract("XMLRECORD", '<row id="([0-9]+)">', 1).alias("xml_id"),
        business_date("XMLRECORD", "c167").alias("business_date"),
        F.size(F.regexp_extract_all("XMLRECORD", F.lit("<c167[^>]*>([0-9]{8})</c167>"), F.lit(1))).alias(
            "dates"
        ),
    )


QUERIES: dict[str, Query] = {
    "xml_parse": xml_parse,
    "wide_parse": wide_parse,
    "column_subset": column_subset,
    "first_columns": first_columns,
    "mv_fixed_group": mv_fixed_group,
    "mv_list": mv_list,
    "mv_two_level": mv_two_level,
    "subvalue_detect": subvalue_detect,
    "max_list_size": max_list_size,
    "normalize_arrays": normalize,
    "pinned_shapes": pinned_shapes,
    "tag_census": tag_census,
    "corrupt_records": corrupt_records,
    "lookup_load": lookup_load,
    "date_extract": date_extract,
    "window_filter": window_filter,
    "count_by_date": count_by_date,
    "count_outer_join": count_outer_join,
    "gap_check": gap_check,
    "gap_check_window": gap_check_window,
    "gap_summary": gap_summary,
    "gap_report": gap_report,
    "gap_report_datasets": gap_report_datasets,
    "gap_ledger": gap_ledger,
    "raw_landing": raw_landing,
    "reland_overwrite": reland_overwrite,
    "landed_window": landed_window,
    "hash_split": hash_split,
    "merge_upsert": merge_upsert,
    "replace_load": replace_load,
    "ingest_history": ingest_history,
    "windowed_history_merge": windowed_history_merge,
    "reparse_landed": reparse_landed,
    "daily_merge": daily_merge,
    "empty_batch": empty_batch,
    "ingest_datasets": ingest_datasets,
    "reconcile_add_missing": reconcile_add_missing,
    "reconcile_widen_table": reconcile_widen_table,
    "reconcile_wrap_df": reconcile_wrap_batch,
    "file_stats": file_stats,
    "conditional_aggs": conditional_aggs,
    "compact_preserves_rows": compact_preserves_rows,
    "compact_to_size": compact_to_size,
    "merge_keyless": merge_keyless,
    "maintenance_run": maintenance_run,
    "next_key": next_free_key,
    "generate_rows": generate_rows,
}
