import random

import pytest

from celloom.llm.mixing import apportion, mixed, mixing
from tests.llm.helpers import collected, documents, words


def plain_targets(sizes):
    """Targets by sharing the excess again until no target is above three times its size."""
    order = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None] * (None in sizes)
    weight = {s: (5, 2, 1)[k % 3] for k, s in enumerate(order)}
    full, total = set(), sum(sizes.values())
    while True:
        left = total - sum(3 * sizes[s] for s in full)
        open_weight = sum(weight[s] for s in order if s not in full)
        target = {s: 3.0 * sizes[s] if s in full else left * weight[s] / open_weight for s in order}
        over = {s for s in order if s not in full and target[s] > 3 * sizes[s]}
        if not over:
            return target
        full |= over


@pytest.fixture(scope="module")
def docs(spark):
    rng = random.Random(9)
    rows = [(i, " ".join("w" * rng.randint(1, 5) for _ in range(rng.choice([0, 3, 40, 700])))) for i in range(400)]
    rows += [(1000, None), (1001, "a\n\tb  c"), (1002, "long " * 30000), (None, "no id here"), rows[5], rows[5], rows[5]]
    frame = documents(spark, rows).drop("source")
    return frame.selectExpr(
        "*", "CASE WHEN doc_id = 1001 THEN 'tiny' WHEN doc_id % 7 = 0 THEN null WHEN doc_id % 7 < 4 THEN 'hot' ELSE 'é' || doc_id % 2 END AS source"
    ).persist()


def test_shares(docs):
    rows = [(r.doc_id, len(words(r.text)), r.source) for r in docs.collect()]
    sizes = {}
    for _, n, s in rows:
        sizes[s] = sizes.get(s, 0) + n
    want = plain_targets(sizes)
    got = mixing(docs).collect()
    assert sorted(((r.doc_id, r.size) for r in got), key=repr) == sorted(((i, n) for i, n, _ in rows), key=repr)
    assert all(0 <= r.taken <= 3 * r.size for r in got)
    by_target = {}
    for r in got:
        by_target.setdefault((r.target, r.source_size), []).append(r.taken)
    assert len(by_target) == len(sizes)
    for s, target in want.items():
        (key,) = [k for k in by_target if k[1] == sizes[s] and abs(k[0] - target) < 1e-6]
        assert abs(sum(by_target[key]) - target) <= 16
    assert collected(mixing(docs.repartition(5)), "doc_id", "size", "taken") == sorted(((r.doc_id, r.size, r.taken) for r in got), key=repr)


def test_the_mix_has_what_was_taken(docs):
    taken = {}
    for r in mixing(docs).collect():
        taken[r.doc_id] = taken.get(r.doc_id, 0) + r.taken
    out = mixed(docs)
    assert out.columns == docs.columns
    whole = {r.doc_id: r.text for r in docs.collect()}
    found = {}
    for r in out.collect():
        assert r.text in whole[r.doc_id] and r.n_chars == len(r.text) and words(r.text)
        found[r.doc_id] = found.get(r.doc_id, 0) + len(words(r.text))
    assert found == {i: n for i, n in taken.items() if n}


def test_highest_quotients(spark):
    rng = random.Random(3)
    for seats in (0, 1, 7, 50, 333):
        weights = [rng.choice([0, 1, 3, 10, 10, 250]) for _ in range(9)]
        total = sum(weights) or 1
        rows = [(0, k, float(w), seats, max(1, 2 * seats * w // total)) for k, w in enumerate(weights)]
        frame = spark.createDataFrame(rows, "g int, k int, weight double, seats long, most long")
        got = {r.k: r.quota for r in apportion(frame, "g", "seats", "weight", "most", "k").collect()}
        quotients = sorted((-w / (2 * s - 1), k) for k, w in enumerate(weights) if w for s in range(1, rows[k][4] + 1))[:seats]
        assert got == {k: sum(j == k for _, j in quotients) for k in range(9)}


def test_empty_and_wordless_tables(spark):
    assert mixing(documents(spark, [])).collect() == []
    got = mixing(documents(spark, [(1, None), (2, " ")])).collect()
    assert {(r.size, r.taken, r.target) for r in got} == {(0, 0, 0.0)}
    assert mixed(documents(spark, [(1, None), (2, " ")])).collect() == []


def test_no_python_in_the_plan(docs):
    for frame in (mixing(docs), mixed(docs)):
        plan = frame._jdf.queryExecution().executedPlan().toString()
        assert "Python" not in plan and "ArrowEval" not in plan
