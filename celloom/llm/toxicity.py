"""Toxicity by a factorization machine over hashed terms.

A document is the set of its terms, hashed to 2**18 places: lower-cased words,
and the first five bytes of longer words, which words of one stem share. The
machine scores it by a bias, a weight for each term and an inner product of
factors for each pair of terms, so that an insult counts differently beside a
group's name than alone:

    w0 + sum w_i + sum_(i<j) <v_i, v_j>

It is fitted on at most TRAIN_ROWS labelled documents, the first in the order
of a hash of their ids; of their terms those go into the machine that differ
between the two labels by a chi-squared test. All else is every document.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from celloom.llm.common import arrow_schema, batch, held_out
from celloom.llm.hashing import grouped_words, range_hashes

BITS = 18
STEM = 5
#: Most labelled documents that the machine is fitted on.
TRAIN_ROWS = 20_000
FACTORS = 8
#: Least documents of a term and least chi-squared value; how many of the terms that tell alone are looked beside, and least value there.
LEAST_DOCS, LEAST_CHI, LEADING, LEAST_BESIDE = 5, 15.0, 256, 40.0
#: Rows that are summed at once.
_SUMMED = 1 << 17

#: Bytes between terms: ASCII but letters and digits.
_BETWEEN = np.ones(256, bool)
_BETWEEN[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = False
_STEM_SALT = np.uint64(0x5BD1E9955BD1E995)


class Machine(NamedTuple):
    """Bias, and by term (0 is no term) the weight and the factors; place is the term of a hash."""

    bias: float
    place: np.ndarray
    weights: np.ndarray
    factors: np.ndarray


def _terms(texts: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Text indices and hashed terms, by groups of texts."""
    shift = np.uint64(64 - BITS)
    for first, words, at in grouped_words(texts, _BETWEEN):
        owner = first + np.repeat(np.arange(len(at) - 1), np.diff(at))
        long = words.ends - words.starts > STEM
        starts = words.starts[long]
        stems = range_hashes(words.sums, starts, starts + STEM) ^ _STEM_SALT
        yield np.concatenate([owner, owner[long]]), (np.concatenate([words.hashes, stems]) >> shift).astype(np.int64)


def _lowered(texts) -> list[bytes]:
    return [b"" if t is None else t.lower().encode("utf-8", "replace") for t in texts]


def _term_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = arrow_schema("toxic int, terms binary")
    for b in batches:
        texts = _lowered(b.column("text").to_pylist())
        sets = [np.zeros(0, np.int64)] * len(texts)
        for owner, terms in _terms(texts):
            both = np.unique(owner << BITS | terms)
            cuts = np.searchsorted(both >> BITS, np.arange(owner.min(), owner.max() + 2)) if len(owner) else []
            for k in range(len(cuts) - 1):
                i = int(owner.min()) + k
                sets[i] = np.union1d(sets[i], both[cuts[k] : cuts[k + 1]] & ((1 << BITS) - 1))
        yield batch(schema, toxic=b.column("toxic"), terms=[s.astype(np.int32).tobytes() for s in sets])


def _telling(seen: np.ndarray, hits: np.ndarray, n: float, positive: float) -> np.ndarray:
    """Chi-squared values of terms in `seen` of n documents, of which `hits` of the positive ones; 0 for too rare ones."""
    with np.errstate(divide="ignore", invalid="ignore"):
        chi = n * (hits * n - seen * positive) ** 2 / (seen * (n - seen) * positive * (n - positive))
    return np.where(seen >= LEAST_DOCS, np.nan_to_num(chi, posinf=0.0), 0.0)


def _chosen(sets: list[np.ndarray], toxic: np.ndarray) -> np.ndarray:
    """Terms that tell a document's label, alone or beside another term.

    A term tells alone if the labels of the documents with it differ from the
    others' by the chi-squared test. The strongest of these are looked at in turn:
    among the documents with one, a term that is neutral alone may go with the toxic ones.
    """
    size = 1 << BITS
    flat = np.concatenate(sets)
    seen = np.bincount(flat, minlength=size)
    hits = np.bincount(np.concatenate([s for s, t in zip(sets, toxic) if t]), minlength=size)
    chi = _telling(seen.astype(float), hits, len(sets), toxic.sum())
    chosen = chi >= LEAST_CHI
    leading = np.argsort(-chi, kind="stable")[:LEADING]
    leading = leading[chosen[leading]]
    lead = np.zeros(size, bool)
    lead[leading] = True
    places = np.flatnonzero(lead[flat])
    term = flat[places]
    owner = np.searchsorted(np.cumsum([len(s) for s in sets]), places, side="right")
    del flat, places
    for one in leading:
        holders = owner[term == one]
        beside = np.concatenate([sets[k] for k in holders])
        labels = np.repeat(toxic[holders], [len(sets[k]) for k in holders])
        positive = toxic[holders].sum()
        if 0 < positive < len(holders):
            seen, hits = np.bincount(beside, minlength=size), np.bincount(beside, weights=labels, minlength=size)
            more = hits * len(holders) > seen * positive
            chosen |= more & (_telling(seen.astype(float), hits, len(holders), positive) >= LEAST_BESIDE)
    return np.flatnonzero(chosen)


def _summed(values: np.ndarray, rows: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Sums of the rows of an array that are named from each start to the next, some of them in memory at a time."""
    ends = np.append(starts[1:], len(rows))
    out = np.empty((len(starts), values.shape[1]))
    at = 0
    while at < len(starts):
        to = max(at + 1, int(np.searchsorted(ends, starts[at] + _SUMMED, side="right")))
        out[at:to] = np.add.reduceat(values[rows[starts[at] : ends[to - 1]]], starts[at:to] - starts[at], axis=0)
        at = to
    return out


def fit(sets: list[np.ndarray], toxic: np.ndarray, rounds: int = 300, rate: float = 0.05, decay: float = 1e-4) -> Machine:
    """The machine of the least logistic loss over sets of terms, by Adam from a fixed start.

    With no rows, or rows of one label only, it is the bias alone: every score
    is then the share of toxic rows, smoothed to a quarter of none.
    """
    toxic = np.asarray(toxic, float)
    positive = toxic.sum()
    bias = float(np.log((positive + 0.5) / (len(toxic) - positive + 1.5)))
    chosen = _chosen(sets, toxic) if 0 < positive < len(toxic) else np.zeros(0, np.int64)
    place = np.zeros(1 << BITS, np.int32)
    place[chosen] = np.arange(1, len(chosen) + 1)
    weights = np.zeros(len(chosen) + 1)
    factors = np.random.default_rng(11).normal(0, 0.05, (len(chosen) + 1, FACTORS))
    factors[0] = 0
    if not len(chosen):
        return Machine(bias, place, weights, factors)
    known = [place[s] for s in sets]
    known = [k[k > 0] for k in known]
    term = np.concatenate(known).astype(np.int32)
    owner = np.repeat(np.arange(len(known), dtype=np.int32), [len(k) for k in known])
    del known
    # documents that have terms, with where theirs begin; and the same by term
    some, of_doc = np.unique(owner, return_index=True)
    owner = owner[np.argsort(term, kind="stable")]
    of_term = np.searchsorted(np.sort(term), np.arange(1, len(chosen) + 1))
    state = {}

    def step(name: str, value, gradient, t: int):
        m, v = state.get(name, (0.0, 0.0))
        m, v = 0.9 * m + 0.1 * gradient, 0.999 * v + 0.001 * gradient**2
        state[name] = (m, v)
        return value - rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)

    by_doc = np.zeros((len(sets), FACTORS + 2))
    for t in range(1, rounds + 1):
        by_doc[some] = _summed(np.column_stack([factors, weights, (factors**2).sum(1)]), term, of_doc)
        total = by_doc[:, :FACTORS]
        y = bias + by_doc[:, FACTORS] + 0.5 * ((total**2).sum(1) - by_doc[:, -1])
        error = (1 / (1 + np.exp(-np.clip(y, -60, 60))) - toxic) / len(sets)
        slope = _summed(np.column_stack([error[:, None] * total, error]), owner, of_term)
        g_weights, g_factors = decay * weights, decay * factors
        g_weights[1:] += slope[:, -1]
        g_factors[1:] += slope[:, :-1] - factors[1:] * slope[:, -1:]
        bias = step("bias", bias, error.sum(), t)
        weights = step("weights", weights, g_weights, t)
        factors = step("factors", factors, g_factors, t)
        weights[0], factors[0] = 0, 0
    return Machine(float(bias), place, weights, factors)


def scores(machine: Machine, texts: list[bytes]) -> np.ndarray:
    """The score of each lower-cased text."""
    pairs = []
    for owner, terms in _terms(texts):
        term = machine.place[terms]
        pairs.append(np.unique(owner[term > 0] * len(machine.weights) + term[term > 0]))
    both = np.unique(np.concatenate(pairs)) if pairs else np.zeros(0, np.int64)
    owner, term = both // len(machine.weights), both % len(machine.weights)
    y = machine.bias + np.bincount(owner, weights=machine.weights[term], minlength=len(texts))
    for column in machine.factors.T:
        v = column[term]
        y += 0.5 * (np.bincount(owner, weights=v, minlength=len(texts)) ** 2 - np.bincount(owner, weights=v * v, minlength=len(texts)))
    return 1 / (1 + np.exp(-np.clip(y, -60, 60)))


def learn(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS) -> Machine:
    """The machine fitted on labelled documents that are not held out, `rows` of them at most.

    Labels other than 0 and 1 and null ids are no labels; a document with two
    labels counts with both.
    """
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic"))
    known = known.where(F.col("toxic").isin(0, 1) & ~held_out()).orderBy(F.xxhash64("doc_id"), "doc_id", "toxic").limit(rows)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    # at most `rows` ids and labels, and of each one text, the first in order: an id may have any number of rows
    sample = texts.join(F.broadcast(known.distinct()), "doc_id").groupBy("doc_id", "toxic").agg(F.min("text").alias("text"))
    got = sample.select("toxic", "text").mapInArrow(_term_sets, "toxic int, terms binary").toArrow()
    terms, toxic = got["terms"].to_pylist(), got["toxic"].to_numpy()
    del got
    # rows in one order, so that sums come out the same in every run
    order = sorted(range(len(terms)), key=lambda i: (toxic[i], terms[i]))
    sets = [np.frombuffer(terms[i], np.int32) for i in order]
    return fit(sets, toxic[order].astype(float) if len(sets) else np.zeros(0))


def scored(docs: DataFrame, machine: Machine, into: str = "score") -> DataFrame:
    """`docs` with every text's score in one more column; null and empty texts are scored by the bias."""
    model = docs.sparkSession.sparkContext.broadcast(machine)

    @F.pandas_udf("double")
    def score(texts: pd.Series) -> pd.Series:
        return pd.Series(scores(model.value, _lowered(texts)))

    return docs.withColumn(into, score(F.col("text")))


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score and predicted of every row of `docs` (doc_id, text).

    `labels` has doc_id and toxic. Repeated rows are returned each; other
    columns of both are ignored. A null doc_id counts as held out.
    """
    machine = learn(docs, labels)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out().alias("held_out"), "text")
    return scored(rows, machine).select("doc_id", "held_out", "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def not_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of `docs`, with their columns, that are not predicted toxic."""
    columns = docs.columns
    name = "_toxicity"
    while name in columns:
        name += "_"
    return scored(docs, learn(docs, labels), name).where(F.col(name) < 0.5).select(*[F.col(f"`{c}`") for c in columns])
