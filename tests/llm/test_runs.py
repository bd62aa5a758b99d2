"""Periodic runs against a plain search of every period."""

import hashlib
import random
import zlib
from fractions import Fraction

import pytest

from celloom.llm.queries import QUERIES
from celloom.llm.runs import kept_words, periodic_runs, repeated_roots, run_digest, with_planted_runs, word_runs
from tests.llm.helpers import collected, documents, words


def plain_runs(w, least_words=24, least_periods=3):
    n, out = len(w), []
    for q in range(1, n // least_periods + 1):
        i = 0
        while i < n - q:
            j = i
            while j < n - q and w[j] == w[j + q]:
                j += 1
            length = j - i + q
            if j > i and length >= max(least_words, least_periods * q):
                run = w[i : i + length]
                if not any(run[d:] == run[:-d] for d in range(1, q)):
                    out.append((i, length, q))
            i = max(j, i + 1)
    return sorted(out, key=lambda r: (r[0], r[2]))


def plain_row(doc, text):
    w = words(text)
    h = zlib.crc32(str(doc).encode()) if doc is not None else 1
    if h % 10 == 0 and w:
        n, g = len(w), h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
    runs = plain_runs(w)
    dropped = {i for s, length, q in runs for i in range(s + q, s + length)}
    best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2])) if runs else (None,) * 3
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    return (
        doc,
        len(runs),
        *best,
        1000 * best[1] // best[2] if runs else None,
        sha("".join(f"{s},{length},{q}\n" for s, length, q in runs)),
        sha(" ".join(x for i, x in enumerate(w) if i not in dropped)),
    )


COLUMNS = ("doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256")


def test_equals_plain_search_on_random_words():
    rng = random.Random(5)
    for _ in range(1500):
        k, n = rng.choice([1, 2, 2, 3, 4]), rng.randint(0, 70)
        w = [rng.randrange(k) for _ in range(n)]
        if rng.random() < 0.6 and n > 5:
            a = rng.randrange(n)
            p = rng.randint(1, max(1, (n - a) // 3))
            w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
        least, periods = rng.choice([2, 6, 24]), rng.choice([3, 4])
        assert word_runs(w, least, periods) == plain_runs(w, least, periods)


def test_roots_are_repeated_longest_lyndon_words():
    rng = random.Random(2)
    for _ in range(300):
        w = [rng.randrange(2) for _ in range(rng.randint(1, 24))]
        for reverse in (False, True):
            key = lambda v: [-x for x in v] if reverse else list(v)  # noqa: B023, E731
            suffixes = [key(w[i:]) for i in range(len(w))] + [[]]

            def longest(i):
                return next(j for j in range(i + 1, len(w) + 1) if suffixes[j] < suffixes[i]) - i  # noqa: B023

            wanted, k = set(), 0
            for i in range(len(w)):
                p = longest(i)
                times = 1
                while w[i + times * p : i + times * p + p] == w[i : i + p] and longest(i + times * p) == p:
                    times += 1
                ahead = i - p >= 0 and w[i - p : i] == w[i : i + p] and longest(i - p) == p
                if times > 1 and not ahead:
                    wanted.add((i, p, times))
            assert set(repeated_roots(w, 2, reverse)) == wanted


def test_long_texts_take_linear_time():
    assert word_runs(["a"] * 300_000) == [(0, 300_000, 1)]
    assert word_runs(["a", "b"] * 150_000) == [(0, 300_000, 2)]
    assert word_runs([str(i) for i in range(300_000)] * 3) == [(0, 900_000, 300_000)]
    rising = [f"{i:06}" for i in range(100_000)]
    assert word_runs(rising + rising[:5]) == []


def test_overlapping_runs_drop_each_word_once():
    w = list("ab" * 15) + list("b" * 30)
    runs = word_runs(w)
    assert runs == plain_runs(w) and len(runs) == 2
    dropped = {i for s, n, q in runs for i in range(s + q, s + n)}
    assert kept_words(w, runs) == [x for i, x in enumerate(w) if i not in dropped]


def test_fewer_than_three_periods_are_refused():
    with pytest.raises(ValueError):
        word_runs(["a"] * 30, least_periods=2)


def test_digest_equals_plain_rows(spark):
    rng = random.Random(8)
    rows = [(i, " ".join(rng.choice("abcd") for _ in range(rng.randint(0, 200)))) for i in range(300)]
    rows += [(None, "x " * 40), (5, "x\ty\n" * 40), (5, "x\ty\n" * 40), (7, None), (8, ""), (9, " \x0b "), (40, "é 漢\xa0字 " * 30)]
    got = run_digest(periodic_runs(with_planted_runs(documents(spark, rows))))
    assert collected(got, *COLUMNS) == sorted((plain_row(*r) for r in rows), key=repr)
    assert sum(r["n_runs"] for r in got.collect()) > 10


def test_odd_texts_and_empty_table(spark):
    docs = documents(spark)
    got = collected(run_digest(periodic_runs(docs)), "doc_id", "n_runs", "runs_sha256")
    assert len(got) == docs.count()
    assert periodic_runs(docs.limit(0)).collect() == []
    one = periodic_runs(documents(spark, [(1, "go " * 30 + "on")])).first()
    assert one["collapsed"] == "go on" and one["n_words"] == 31
    assert [tuple(r) for r in one["runs"]] == [(0, 30, 1)]


def test_query_equals_plain_rows(spark, data):
    got = QUERIES["op11_periodic_runs"](spark, data)
    rows = spark.read.parquet(f"{data}/documents.parquet").select("doc_id", "text").collect()
    short = [r for r in rows if len(words(r["text"])) < 1500]
    wanted = {r["doc_id"]: plain_row(r["doc_id"], r["text"]) for r in short}
    found = {r["doc_id"]: tuple(r[c] for c in COLUMNS) for r in got.collect()}
    assert len(found) == len(rows)
    assert {i: found[i] for i in wanted} == wanted
    assert sum(r[1] for r in wanted.values()) > 5
