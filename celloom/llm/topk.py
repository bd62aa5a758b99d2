"""Exact top-k by inner product: exhaustive accumulation, term at a time.

Vectors are sparse rows of integers. A task holds a block of candidates as
postings: for every dimension the candidates that are not 0 there, with their
weights. A query adds, dimension by dimension, its weight times the postings
into a dense array with a score for each candidate of the block; a partition
selection takes the block's best and the blocks' best are merged. Queries come
in blocks of about QUERIES: a block is a bounded broadcast against all rows, and
its best are written out before the next one is read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from celloom.llm.common import arrow_schema, batch, landed
from celloom.workspace import new_folder

K = 10
SCALE = 1024
#: Queries in a block and candidates in a block.
QUERIES, CANDIDATES = 4096, 8192
#: Scores in memory at once.
_SCORES = 1 << 21

_BEST = "query long, query_id long, vec_id long, score long"


def quantized(column: str, scale: int = SCALE) -> Column:
    """floor(scale * x) of every component; null if the vector or a component is null or not finite."""
    whole = F.transform(column, lambda x: F.floor(x.cast("double") * scale))
    fine = F.forall(column, lambda x: F.coalesce(F.abs(x.cast("double")) < F.lit(float("inf")), F.lit(False)) & ~F.isnan(x.cast("double")))
    return F.when(F.col(column).isNotNull() & fine, whole)


def _matrix(rows: list[list[int]]) -> np.ndarray:
    out = np.zeros((len(rows), max(map(len, rows), default=0)), np.int64)
    for line, row in zip(out, rows):
        line[: len(row)] = row
    return out


def block_scores(queries: np.ndarray, candidates: np.ndarray) -> np.ndarray:
    """Scores of every query with every candidate, from postings by dimension."""
    scores = np.zeros((len(queries), len(candidates)), np.int64)
    for d in range(min(queries.shape[1], candidates.shape[1])):
        holders = np.flatnonzero(candidates[:, d])
        asking = np.flatnonzero(queries[:, d])
        if not len(holders) or not len(asking):
            continue
        weights = candidates[holders, d]
        if len(holders) == len(candidates) and len(asking) == len(queries):
            scores += queries[:, d, None] * weights
        else:
            scores[np.ix_(asking, holders)] += queries[asking, d, None] * weights
    return scores


def best_of(scores: np.ndarray, ids: np.ndarray, own: np.ndarray, k: int) -> Iterator[tuple[int, np.ndarray]]:
    """Of each row of scores the places of the k highest, ties to smaller ids; candidates of the row's own id left out."""
    for i, row in enumerate(scores):
        places = np.flatnonzero(ids != own[i])
        if len(places) > k:
            values = row[places]
            least = np.partition(values, len(values) - k)[len(values) - k]
            places = places[values >= least]
        yield i, places[np.lexsort((ids[places], -row[places]))][:k]


def _search(shared, k: int):
    schema = arrow_schema(_BEST)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers, own, queries = shared.value
        for b in batches:
            for at in range(0, b.num_rows, CANDIDATES):
                part = b.slice(at, CANDIDATES)
                ids = np.array(part.column("vec_id").to_pylist(), np.int64)
                candidates = _matrix(part.column("v").to_pylist())
                step = max(1, _SCORES // max(1, len(ids)))
                for q in range(0, len(queries), step):
                    chunk = slice(q, q + step)
                    scores = block_scores(queries[chunk], candidates)
                    found = [(i + q, places, scores[i, places]) for i, places in best_of(scores, ids, own[chunk], k)]
                    asked = np.concatenate([np.full(len(p), i) for i, p, _ in found])
                    yield batch(
                        schema,
                        query=numbers[asked],
                        query_id=own[asked],
                        vec_id=ids[np.concatenate([p for _, p, _ in found])],
                        score=np.concatenate([s for _, _, s in found]),
                    )

    return run


def _merged(best: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query").orderBy(F.desc("score"), "vec_id")
    return best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def top_k(vectors: DataFrame, asking: Column, k: int = K, scale: int = SCALE) -> DataFrame:
    """query_id, rank, vec_id and score of the k best rows of `vectors` (vec_id, embedding) for each query.

    Queries are the rows where `asking` holds. Candidates are all rows but
    those of the query's own vec_id; all of them, if fewer than k. Vectors that
    are null or have a null or non-finite component take no part, neither do
    rows without vec_id. Components that a shorter vector lacks are 0.
    Repeated candidates are ranked each; repeated query rows are answered each.
    Other columns are ignored.
    """
    spark = vectors.sparkSession
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), quantized("embedding", scale).alias("v"), asking.alias("asked"))
    rows = rows.where("vec_id is not null and v is not null")
    queries = landed(rows.where("asked").select("vec_id", "v").withColumn("query", F.monotonically_increasing_id()), "queries")
    blocks = -(-queries.count() // QUERIES)
    found = new_folder(spark, "found")
    spark.createDataFrame([], _BEST).write.parquet(found)
    for number in range(blocks):
        block = queries.where(F.pmod(F.xxhash64("query"), F.lit(blocks)) == number)
        shared = spark.sparkContext.broadcast(_block(block.collect()))  # about QUERIES rows
        best = rows.select("vec_id", "v").mapInArrow(_search(shared, k), _BEST)
        _merged(best, k).drop("rank").write.mode("append").parquet(found)
        shared.unpersist()
    return _merged(spark.read.schema(_BEST).parquet(found), k).select("query_id", "rank", "vec_id", "score")


def _block(rows: list) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    return np.array([r.query for r in rows]), np.array([r.vec_id for r in rows]), _matrix([r.v for r in rows])
