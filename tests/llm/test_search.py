"""Ranked search against scores of every document."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from celloom.llm import search
from celloom.llm.search import accumulate, inverted_index, lexical_search
from tests.llm.helpers import collected, documents, lowered, texts

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return TERM.findall(lowered(text))


def plain(docs, items, k=10):
    """(item_id, rank, score) and, for scores that no tie leaves open, doc_id."""
    bags = [(i, Counter(terms(t))) for i, t in docs]
    bags = [(i, b, sum(b.values())) for i, b in bags if b]
    n, total = len(bags), sum(size for _, _, size in bags)
    df = Counter(t for _, b, _ in bags for t in b)
    asked = {}
    for item, text in items:
        asked.setdefault(item, Counter()).update(terms(text))
    out = []
    for item, bag in asked.items():
        scored = []
        for i, b, size in bags:
            m = 100 - 75 + 75 * size * n // total
            score = sum(
                times * math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * (1000000000 * b[t] // (1000 * b[t] + 8 * m))
                for t, times in bag.items()
                if t in b
            )
            if score > 0:
                scored.append((-score, i is None, i or 0, i))
        scored.sort(key=lambda s: s[:3])
        out += [(item, rank, s[3], -s[0]) for rank, s in enumerate(scored[:k], 1)]
    return sorted(out, key=repr)


ROW = ("item_id", "rank", "doc_id", "score")


def items(spark, rows):
    return spark.createDataFrame([(i, t, "x", 1, 2) for i, t in rows], "item_id long, text string, doc_id string, score int, term int")


@pytest.fixture(scope="module")
def rows():
    made = list(enumerate(texts(9, 150), 1))
    return made + [made[4], (None, made[6][1]), (None, made[6][1]), (9, "Word-word2 wORD\x00word ÉCOLE école"), (3, "_" * 50)]


@pytest.fixture(scope="module")
def asked(rows):
    rng = random.Random(4)
    stock = [t for _, r in rows for t in terms(r)[:300]]
    made = [(i, " ".join(rng.choice(stock) for _ in range(rng.randint(1, 30)))) for i in range(40)]
    return made + [(1, "one two words"), (7, None), (8, ""), (None, made[3][1]), (50, "unheard-of"), (51, made[2][1] + " " + made[2][1]), (51, "WORD école École")]


@pytest.mark.parametrize("segment, block", [(1 << 22, 1 << 18), (2000, 60)])
def test_equals_scores_of_all_documents(spark, monkeypatch, rows, asked, segment, block):
    monkeypatch.setattr(search, "SEGMENT_BYTES", segment)
    got = collected(lexical_search(documents(spark, rows), items(spark, asked), block_terms=block), *ROW)
    assert got == plain(rows, asked)


def test_frequent_terms_and_equal_scores(spark):
    rows = [(i, "the " * (i % 3 + 1) + ("rare" if i % 40 == 0 else "plain")) for i in range(400)]
    asked = [(0, "the rare"), (1, "the plain"), (2, "rare"), (3, "the the the plain rare")]
    assert collected(lexical_search(documents(spark, rows), items(spark, asked)), *ROW) == plain(rows, asked)


def test_accumulators_stop_and_survivors_stay_exact():
    rng = np.random.default_rng(1)
    stopped = 0
    for _ in range(300):
        n, k = 200, 5
        lists = []
        for size in sorted(rng.integers(1, 150, 8)):
            docs = np.sort(rng.choice(n, size, replace=False))
            lists.append((docs, rng.integers(1, 1 + 40000 // size, size)))
        whole = np.zeros(n, np.int64)
        for docs, adds in lists:
            whole[docs] += adds
        bounds = np.array([int(adds.max()) for _, adds in lists])
        found, score = accumulate(lists, bounds, n, k, 0)
        assert (whole[found] == score).all()
        best = np.sort(whole)[::-1][:k]
        assert (np.sort(score)[::-1][:k] == best).all()
        least = best[-1]
        assert set(np.flatnonzero(whole >= max(least, 1))) <= set(found.tolist())
        stopped += len(found) < len(np.flatnonzero(whole))
    assert stopped > 100


def test_index_holds_every_document(spark, rows):
    index = inverted_index(documents(spark, rows)).collect()
    ids = [i for r in index for i in r["doc_ids"]]
    assert sorted(ids, key=repr) == sorted((i for i, _ in rows), key=repr)
    assert sum(r["all_terms"] for r in index) == sum(len(terms(t)) for _, t in rows)
    assert sum(sum(r["counts"]) for r in index) == sum(len(set(terms(t))) for _, t in rows)


def test_long_text_without_separators(spark):
    rows = [(1, "ab" * 1_200_000 + " tail"), (2, "tail " * 400_000), (3, "other")]
    asked = [(1, "tail other"), (2, "ab" * 1_200_000)]
    assert collected(lexical_search(documents(spark, rows), items(spark, asked)), *ROW) == plain(rows, asked)


def test_empty_tables(spark, rows):
    some, none = documents(spark, rows[:5]), items(spark, [(1, "one")])
    assert lexical_search(some.limit(0), none).collect() == []
    assert lexical_search(some, none.limit(0)).collect() == []
    assert lexical_search(some, items(spark, [(1, None), (2, "-")])).collect() == []
