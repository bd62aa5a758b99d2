"""Headline timings as one JSON line.

``parse_250/150/50`` is the parse of wide records (about 165 elements each, as
many records as customers): landed Parquet in, shapes found, wide Parquet out.
``elements`` says how many of a record's elements the first 250, 150 or 50
columns take; the long lists stand where the account mapping has them.
The others are whole jobs over orders and lines.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from celloom import fixtures as X
from celloom.operators.parsing import parse_wide
from celloom.queries import QUERIES
from celloom.sources.landing import land_raw, read_landed
from celloom.workspace import new_folder

FOLDER = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
REPEATS = int(os.environ.get("BENCH_REPEATS", "3"))
JOBS = (
    "wide_parse",
    "mv_two_level",
    "gap_check",
    "merge_upsert",
    "ingest_history",
    "windowed_history_merge",
    "daily_merge",
    "compact_preserves_rows",
)


def session() -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("bench")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def timed(work) -> float:
    start = time.perf_counter()
    work()
    return time.perf_counter() - start


def main() -> None:
    spark = session()
    raw = new_folder(spark, "bench-raw")
    customers = spark.read.parquet(f"{FOLDER}/customer.parquet").repartition(int(CPUS) * 2)
    land_raw(X.wide_records(customers, "c_custkey", "c_name"), raw)

    def parse(columns: int) -> None:
        wide = parse_wide(read_landed(spark, raw), X.WIDE_LOOKUP, columns=columns)
        wide.write.parquet(new_folder(spark, f"bench-{columns}"))

    def run(name: str) -> None:
        QUERIES[name](spark, FOLDER).write.format("noop").mode("overwrite").save()

    parses = {f"parse_{n}": (lambda n=n: parse(n)) for n in (250, 150, 50)}
    parse(250)  # warm-up
    times = {name: [] for name in (*parses, *JOBS)}
    for _ in range(REPEATS):
        for name, work in parses.items():
            times[name].append(timed(work))
    for name in JOBS:
        times[name].append(timed(lambda: run(name)))
    medians = {name: round(statistics.median(t), 3) for name, t in times.items()}
    print(
        json.dumps(
            {
                "metric": "sum of median query seconds",
                "value": round(sum(medians.values()), 3),
                "unit": "sec",
                "queries": medians,
                "sf": FOLDER.rstrip("/").rsplit("sf", 1)[-1],
                "records": customers.count(),
                "elements": {n: X.populated(X.WIDE_LOOKUP[:n]) for n in (250, 150, 50)},
                "ratio_150_to_250": round(medians["parse_150"] / medians["parse_250"], 2),
                "ratio_50_to_250": round(medians["parse_50"] / medians["parse_250"], 2),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
