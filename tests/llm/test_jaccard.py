import random

import numpy as np
import pytest

from celloom.llm.common import landed
from celloom.llm.components import components
from celloom.llm.hashing import LOWERED, SPACES, shingle_set, word_hashes
from celloom.llm.jaccard import kept_of_each, near_duplicates, prefix_length
from tests.llm.helpers import collected, documents, lowered, words


def shingles(text):
    w = words(lowered(text))
    return {tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if w else set()


def groups(rows):
    """Each row's set and the place that stands for its component, all pairs compared."""
    sets = [shingles(t) for _, t in rows]
    root = list(range(len(rows)))

    def top(k):
        while root[k] != k:
            k = root[k]
        return k

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]):
                root[top(i)] = top(j)
    return sets, [top(k) for k in range(len(rows))]


def plain(rows):
    """(doc_id, size, smallest id reachable)."""
    sets, top = groups(rows)
    least = {}
    for k, (i, _) in enumerate(rows):
        if i is not None:
            least[top[k]] = min(i, least.get(top[k], i))
    return [(i, len(sets[k]), i if not sets[k] else least.get(top[k])) for k, (i, _) in enumerate(rows)]


def test_equals_all_pairs(spark):
    docs = documents(spark)
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    assert collected(near_duplicates(docs), "doc_id", "n_shingles", "component_id") == sorted(plain(rows), key=repr)
    kept = kept_of_each(docs)
    assert kept.columns == docs.columns
    got = collected(kept, "doc_id", "text")
    sets, top = groups(rows)
    assert sum(bool(words(t)) for _, t in got) == len({r for r, s in zip(top, sets) if s})
    assert sum(not words(t) for _, t in got) == sum(not words(t) for _, t in rows)


def test_a_group_of_near_copies(spark):
    """Copies that differ from one text in up to four places: linked through others where not themselves."""
    rng = random.Random(5)
    base = [f"w{k}" for k in range(120)]
    rows = []
    for i in range(150):
        text = list(base)
        for _ in range(rng.choice([1, 1, 2, 3, 4])):
            text[rng.randrange(len(text))] = f"x{rng.randrange(10**6)}"
        rows.append((i, " ".join(text)))
    docs = documents(spark, rows)
    assert collected(near_duplicates(docs), "doc_id", "n_shingles", "component_id") == sorted(plain(rows), key=repr)


def test_empty_table(spark):
    assert near_duplicates(documents(spark, [])).collect() == []


def test_components(spark):
    rng = random.Random(1)
    links = [(rng.randrange(80), rng.randrange(80)) for _ in range(60)] + [(k, k + 1) for k in range(100, 130)]
    root = {}

    def top(k):
        while root.get(k, k) != k:
            k = root[k]
        return k

    for a, b in links:
        x, y = sorted((top(a), top(b)))
        root[y] = x
    nodes = {n for link in links for n in link}
    want = sorted(((n, top(n)) for n in nodes if top(n) != n), key=repr)
    assert collected(components(spark.createDataFrame(links, "a long, b long")), "a", "b") == want


def test_shingles_ignore_how_texts_are_grouped():
    data = [b"a b c d e f", b"A b C d e f", b"", b"a b", b"x" * (1 << 20) + b" a b c d e f"]
    sets = [shingle_set(h, 5) for h in word_hashes(data, SPACES, LOWERED)]
    assert [len(s) for s in sets] == [2, 2, 0, 1, 3]
    assert np.array_equal(sets[0], sets[1]) and set(sets[0]) < set(sets[4])
    assert [prefix_length(n) for n in (1, 5, 10, 11)] == [1, 2, 3, 3]


def test_landed_rows_are_in_the_shared_folder(spark):
    assert landed(spark.range(3), "rows").count() == 3


@pytest.mark.parametrize("name", ["op5_ngram_jaccard_join"])
def test_query(spark, data, name):
    from celloom.llm.queries import QUERIES

    docs = spark.read.parquet(f"{data}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    assert collected(QUERIES[name](spark, data), "doc_id", "n_shingles", "component_id") == sorted(plain(rows), key=repr)
