import math
import random

import numpy as np
from pyspark.sql import functions as F

from celloom.llm import topk
from celloom.llm.topk import best_of, block_scores, top_k
from tests.llm.helpers import collected


def plain(rows, k):
    fit = []
    for i, v in rows:
        if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v):
            fit.append((i, [math.floor(1024 * x) for x in v]))
    out = []
    for i, q in fit:
        if i % 5 == 0:
            scored = sorted((-sum(a * b for a, b in zip(q, v)), j) for j, v in fit if j != i)[:k]
            out += [(i, n, j, -s) for n, (s, j) in enumerate(scored, 1)]
    return sorted(out)


def _frame(spark, rows):
    return spark.createDataFrame([(*r, 1, "x") for r in rows], "vec_id long, embedding array<float>, score int, rank string").repartition(3)


def test_equals_all_pairs(spark):
    rng = random.Random(8)
    value = lambda: float(np.float32(rng.choice([0.0, 0.0, rng.uniform(-1, 1)])))
    rows = [(i, [value() for _ in range(12)]) for i in range(150)]
    rows += [(200 + i, list(rows[10][1])) for i in range(30)]  # ties
    rows += [(300, None), (301, [None] * 12), (302, [float("nan")] * 12), (305, [float("inf")] * 12), (None, rows[3][1])]
    rows += [(310, []), (311, [0.5]), rows[17], (315, [0.0] * 12)]
    got = top_k(_frame(spark, rows), F.col("vec_id") % 5 == 0)
    assert collected(got, "query_id", "rank", "vec_id", "score") == sorted(plain(rows, 10), key=repr)


def test_few_rows(spark):
    rows = [(0, [1.0, 2.0]), (5, [0.25, -0.25]), (6, [0.1, 0.1])]
    got = top_k(_frame(spark, rows), F.col("vec_id") % 5 == 0)
    assert collected(got, "query_id", "rank", "vec_id", "score") == sorted(plain(rows, 10), key=repr)
    assert top_k(_frame(spark, []), F.col("vec_id") % 5 == 0).collect() == []


def test_queries_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(topk, "QUERIES", 3)
    rng = random.Random(1)
    rows = [(i, [rng.uniform(-1, 1) for _ in range(4)]) for i in range(40)]
    rows = [(i, [float(np.float32(x)) for x in v]) for i, v in rows]
    got = top_k(_frame(spark, rows), F.col("vec_id") % 5 == 0)
    assert collected(got, "query_id", "rank", "vec_id", "score") == sorted(plain(rows, 10), key=repr)


def test_accumulation_and_selection():
    rng = np.random.default_rng(0)
    queries, candidates = (rng.integers(-3, 3, (n, 6)) * rng.integers(0, 2, (n, 6)) for n in (5, 40))
    scores = block_scores(queries, candidates)
    assert np.array_equal(scores, queries @ candidates.T)
    ids = rng.permutation(40)
    for i, places in best_of(scores, ids, np.full(5, 3), 7):
        want = sorted((-scores[i, p], ids[p]) for p in range(40) if ids[p] != 3)[:7]
        assert [(-scores[i, p], ids[p]) for p in places] == want
