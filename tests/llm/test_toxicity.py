import random
import zlib

import numpy as np

from celloom.llm import toxicity as toxicity_module
from celloom.llm.toxicity import fit, learn, not_toxic, scores, toxicity
from tests.llm.helpers import collected, documents


def _labels(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


def _prose(rng, toxic):
    said = [rng.choice(["bar", "lund", "keto", "mirn", "sofal", "tamber"]) + str(rng.randrange(40)) for _ in range(40)]
    if toxic:
        said[rng.randrange(40)] = rng.choice(["Idiot", "moron!", "scum"])
    return " ".join(said)


def test_learns_words_and_returns_every_row(spark):
    rng = random.Random(2)
    rows = [(i, _prose(rng, i % 5 == 0)) for i in range(500)]
    docs = documents(spark, [*rows, (1000, None), (1001, ""), (None, "idiot idiot"), rows[5]])
    labels = _labels(spark, [(i, 1, int(i % 5 == 0)) for i in range(500)] + [(3, 1, None), (None, 0, 1), (9999, 1, 1)])
    found = toxicity(docs, labels).collect()
    assert len(found) == 504
    by_id = {r.doc_id: r for r in found}
    for i, r in by_id.items():
        assert r.held_out == (i is None or zlib.crc32(str(i).encode()) % 5 == 0)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5)
    out = [i for i, _ in rows if by_id[i].held_out]
    assert np.mean([by_id[i].predicted == (i % 5 == 0) for i in out]) == 1
    assert by_id[1000].score == by_id[1001].score
    kept = not_toxic(docs, labels)
    assert kept.columns == docs.columns
    assert collected(kept, "doc_id") == sorted(((r.doc_id,) for r in found if not r.predicted), key=repr)


def test_learns_pairs():
    """Toxic only where two terms meet: a weight for each cannot tell."""
    sets = [np.array(s) for s in ([1, 9], [2, 9], [1, 2, 9], [9])] * 200
    toxic = np.array([0, 0, 1, 0] * 200)
    machine = fit(sets, toxic)
    lone = machine.place[[1, 2]]
    y = [machine.bias + machine.weights[lone[:k]].sum() for k in (1, 2)]
    assert y[0] < 0
    pair = machine.factors[lone[0]] @ machine.factors[lone[1]]
    assert y[1] + pair > 0 and pair > 0.5


def test_without_labels(spark):
    docs = documents(spark, [(1, "a b"), (2, None)])
    found = toxicity(docs, _labels(spark, [])).collect()
    assert [(r.score, r.predicted) for r in found] == [(0.25, 0), (0.25, 0)]
    assert toxicity(documents(spark, []), _labels(spark, [(1, 1, 1)])).collect() == []


def test_long_text_scores_as_its_terms():
    sets = [np.array([k % 7, 20 + k % 3]) for k in range(50)]
    machine = fit(sets, np.array([k % 7 == 0 for k in range(50)], int))
    assert scores(machine, [b"", b" "]).tolist() == scores(machine, [b"."] * 2).tolist()
    text = b"some words " * 200_000
    assert scores(machine, [text])[0] == scores(machine, [b"some words"])[0]


def test_same_machine_from_any_partitions(spark):
    rng = random.Random(4)
    docs = documents(spark, [(i, _prose(rng, i % 4 == 0)) for i in range(200)])
    labels = _labels(spark, [(i, 1, int(i % 4 == 0)) for i in range(200)])
    a, b = learn(docs, labels), learn(docs.repartition(7), labels)
    assert a.bias == b.bias and np.array_equal(a.factors, b.factors)


def test_learns_a_name_that_is_neutral_alone():
    """Toxic where an insult meets a name; the name is as frequent among toxic documents as among others."""
    insult, name, other = 11, 12, 13
    groups = [([insult, name], 1, 100), ([insult], 0, 100), ([name], 0, 400), ([other], 1, 100), ([14], 0, 300)]
    sets = [np.array(s, np.int32) for s, _, n in groups for _ in range(n)]
    label = np.array([y for _, y, n in groups for _ in range(n)], float)
    seen, hits = (np.bincount(np.concatenate(sets), weights=w, minlength=20) for w in (None, np.repeat(label, [len(s) for s in sets])))
    assert toxicity_module._telling(seen.astype(float), hits, len(sets), label.sum())[name] == 0
    machine = fit(sets, label)

    def y(*terms):
        at = machine.place[list(terms)]
        pairs = sum(machine.factors[a] @ machine.factors[b] for i, a in enumerate(at) for b in at[:i])
        return machine.bias + machine.weights[at].sum() + pairs

    assert machine.place[name] > 0
    assert y(insult, name) > 0 > max(y(insult), y(name), y(14)) and y(other) > 0


def plain_fit(sets, toxic, terms, start, rounds, rate=0.05, decay=1e-4):
    """The same machine over a matrix of documents and terms."""
    x = np.array([[float(t in s) for t in terms] for s in sets])
    n, positive = len(sets), toxic.sum()
    values = {"b": np.log((positive + 0.5) / (n - positive + 1.5)), "w": np.zeros(len(terms)), "v": start.copy()}
    m, s = ({k: 0.0 for k in values} for _ in range(2))
    for t in range(1, rounds + 1):
        pairs = np.array([sum(values["v"][i] @ values["v"][j] for i in np.flatnonzero(r) for j in np.flatnonzero(r) if i < j) for r in x])
        error = (1 / (1 + np.exp(-(values["b"] + x @ values["w"] + pairs))) - toxic) / n
        slope = {"b": error.sum(), "w": x.T @ error + decay * values["w"], "v": decay * values["v"]}
        for r, e in zip(x, error):
            for i in np.flatnonzero(r):
                slope["v"][i] = slope["v"][i] + e * sum((values["v"][j] for j in np.flatnonzero(r) if j != i), np.zeros(start.shape[1]))
        for k, g in slope.items():
            m[k], s[k] = 0.9 * m[k] + 0.1 * g, 0.999 * s[k] + 0.001 * g**2
            values[k] = values[k] - rate * (m[k] / (1 - 0.9**t)) / (np.sqrt(s[k] / (1 - 0.999**t)) + 1e-8)
    return values


def test_fit_equals_the_plain_machine():
    rng = random.Random(7)
    sets, toxic = [], []
    for _ in range(60):
        s = sorted(rng.sample(range(3, 9), rng.randint(0, 4)))
        sets.append(np.array(s, np.int32))
        toxic.append(float({3, 4} <= set(s) or 5 in s))
    toxic = np.array(toxic)
    machine = fit(sets, toxic, rounds=12)
    terms = [t for t in range(3, 9) if machine.place[t] > 0]
    assert len(terms) >= 2
    start = np.random.default_rng(11).normal(0, 0.05, (len(terms) + 1, machine.factors.shape[1]))[1:]
    kept = [np.array([t for t in s if t in terms]) for s in sets]
    want = plain_fit(kept, toxic, terms, start, 12)
    at = machine.place[terms]
    assert np.allclose(machine.bias, want["b"]) and np.allclose(machine.weights[at], want["w"])
    assert np.allclose(machine.factors[at], want["v"])


def test_scores_equal_the_plain_sum(spark):
    rng = random.Random(9)
    docs = documents(spark, [(i, _prose(rng, i % 4 == 0)) for i in range(200)])
    machine = learn(docs, _labels(spark, [(i, 1, int(i % 4 == 0)) for i in range(200)]))
    texts = [r.text.lower().encode() for r in docs.limit(30).collect()] + [b"", b"idiot scum moron idiot"]
    for text, score in zip(texts, scores(machine, texts)):
        terms = {int(t) for _, found in toxicity_module._terms([text]) for t in found}
        at = [machine.place[t] for t in terms if machine.place[t] > 0]
        pairs = sum(machine.factors[a] @ machine.factors[b] for i, a in enumerate(at) for b in at[:i])
        y = machine.bias + sum(machine.weights[a] for a in at) + pairs
        assert abs(score - 1 / (1 + np.exp(-y))) < 1e-9


def test_rows_of_one_id_are_one_example(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(toxicity_module, "fit", lambda sets, toxic: seen.append((len(sets), toxic.tolist())))
    docs = documents(spark, [(1, f"text {k}") for k in range(3000)] + [(2, "b"), (3, "c"), (4, "d"), (6, "e")])
    learn(docs, _labels(spark, [(i, 1, i % 2) for i in (1, 2, 3, 4, 6)] * 3 + [(1, 1, 0)]), rows=4)
    (n, _), = seen
    assert n <= 4
