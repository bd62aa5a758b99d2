"""Ranked lexical search: term at a time with a limited set of accumulators.

An index of all documents is written once: segments of some MB of text, each
with the postings of its documents by term. Document frequencies of the terms
that queries ask for are summed from the segments. Then each segment answers
each query by itself, term by term, the rarest first. A term's postings add to
the accumulators of their documents. As soon as the bounds of the terms still to
come cannot reach the k-th best partial score, no accumulator is created any
more: a document without one can no longer enter the best k. The accumulators
there are keep being updated to their exact scores. Scores found in a task's
earlier segments count as partial scores too. The best of all tasks are merged.

Queries come in blocks of a bounded number of terms. A block passes the driver,
is broadcast, read against the index, written out and let go.

Terms are named by 64-bit hashes of their lower-cased bytes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from celloom.llm.common import arrow_schema, batch, landed, utf8
from celloom.llm.hashing import LOWERED, grouped_words
from celloom.workspace import new_folder

K = 10
#: Bytes of text, and documents, in a segment of the index.
SEGMENT_BYTES, SEGMENT_DOCS = 1 << 22, 1 << 16
#: Terms in a block of queries, counted for every query; one query is never cut.
BLOCK_TERMS = 1 << 18
#: Lists that the best of all tasks are merged in, before the last merge.
MERGES = 64

#: Terms are what ASCII bytes other than letters and digits leave between them.
SEPARATORS = np.ones(256, bool)
SEPARATORS[128:] = False
for _first, _last in ("09", "AZ", "az"):
    SEPARATORS[ord(_first) : ord(_last) + 1] = False

_SEGMENT = (
    "doc_ids array<long>, sizes array<long>, with_terms long, all_terms long, "
    "terms array<long>, counts array<long>, docs binary, tfs binary, tf_type string"
)
_FOUND = "item_id long, doc_id long, score long"


# --- the index -----------------------------------------------------------


def _segment(ids: list, terms: list[np.ndarray]) -> dict:
    """Postings of some documents: their terms in order, each with its documents and occurrences."""
    sizes = np.array([len(t) for t in terms], np.int64)
    hashes = np.concatenate(terms) if terms else np.zeros(0, np.uint64)
    doc = np.repeat(np.arange(len(ids), dtype=np.uint16), sizes)
    order = np.argsort(hashes, kind="stable")
    hashes, doc = hashes[order], doc[order]
    new_term = np.ones(len(hashes), bool)
    new_term[1:] = hashes[1:] != hashes[:-1]
    new_pair = new_term.copy()
    new_pair[1:] |= doc[1:] != doc[:-1]
    at = np.flatnonzero(new_pair)
    tfs = np.diff(at, append=len(hashes))
    heads = np.flatnonzero(new_term[at])
    tf_type = np.min_scalar_type(int(tfs.max(initial=1))).str
    return {
        "doc_ids": ids,
        "sizes": sizes.tolist(),
        "with_terms": int((sizes > 0).sum()),
        "all_terms": int(sizes.sum()),
        "terms": hashes[at[heads]].view(np.int64),
        "counts": np.diff(heads, append=len(at)),
        "docs": doc[at].tobytes(),
        "tfs": tfs.astype(tf_type).tobytes(),
        "tf_type": tf_type,
    }


def _terms_of(texts: list[bytes]) -> Iterator[tuple[int, np.ndarray]]:
    """(text's number, hashes of its terms); a long text comes in several pieces."""
    for first, words, at in grouped_words(texts, SEPARATORS, LOWERED):
        for k in range(len(at) - 1):
            yield first + k, words.hashes[at[k] : at[k + 1]]


def inverted_index(docs: DataFrame) -> DataFrame:
    """Segments of the whole table: one row for some MB of text, made where the rows are read."""
    schema = arrow_schema(_SEGMENT)

    def build(batches):
        ids, terms, size = [], [], 0
        for b in batches:
            for lo in range(0, b.num_rows, 256):
                part = b.slice(lo, 256)
                texts = part.column(1).to_pylist()
                known = part.column(0).to_pylist()
                number = -1
                for k, hashes in _terms_of(texts):
                    if k == number:
                        terms[-1] = np.concatenate([terms[-1], hashes])
                        continue
                    if size >= SEGMENT_BYTES or len(ids) == SEGMENT_DOCS:
                        yield batch(schema, **{c: [v] for c, v in _segment(ids, terms).items()})
                        ids, terms, size = [], [], 0
                    number = k
                    ids.append(known[k])
                    terms.append(hashes)
                    size += len(texts[k])
        if ids:
            yield batch(schema, **{c: [v] for c, v in _segment(ids, terms).items()})

    return docs.select(F.col("doc_id").cast("long"), utf8().alias("text")).mapInArrow(build, _SEGMENT)


# --- the queries -----------------------------------------------------------


def _item_terms(items: DataFrame) -> DataFrame:
    """(item_id, term, times): rows of one id are one query of all their terms."""
    schema = arrow_schema("item_id long, term long, times long")

    def count(batches):
        for b in batches:
            ids = b.column(0).to_pylist()
            for k, hashes in _terms_of(b.column(1).to_pylist()):
                terms, times = np.unique(hashes, return_counts=True)
                yield batch(schema, item_id=[ids[k]] * len(terms), term=terms.view(np.int64), times=times)

    found = items.select(F.col("item_id").cast("long"), utf8().alias("text")).mapInArrow(count, "item_id long, term long, times long")
    return found.groupBy("item_id", "term").agg(F.sum("times").alias("times"))


def weighted_terms(items: DataFrame, index: DataFrame) -> tuple[DataFrame, int, int]:
    """(item_id, term, times, df, weight) of terms that documents hold, N and L."""
    asked = landed(_item_terms(items), "asked")
    n, total = index.agg(F.sum("with_terms"), F.sum("all_terms")).first()
    n, total = n or 0, total or 0
    held = index.select(F.explode(F.arrays_zip("terms", "counts")).alias("t")).select("t.terms", "t.counts")
    wanted = asked.select("term").distinct()
    df = held.join(wanted, F.col("terms") == F.col("term")).groupBy("term").agg(F.sum("counts").alias("df"))
    weight = F.floor(F.lit(1000.0) * F.log((F.lit(2 * n + 2).cast("double")) / (2 * F.col("df") + 1).cast("double")))
    return asked.join(df, "term").withColumn("weight", weight.cast("long")), n, total


class Block:
    """Some queries: their terms, the rarest first, and the distinct terms of all."""

    def __init__(self, rows: pa.Table):
        column = {c: rows[c].to_numpy() for c in ("term", "times", "df", "weight")}
        items = rows["item_id"].to_pylist()
        self.terms = np.unique(column["term"].view(np.uint64))
        place = np.searchsorted(self.terms, column["term"].view(np.uint64))
        order = np.lexsort((column["term"], column["df"]))
        by_item: dict = {}
        for i in order.tolist():
            by_item.setdefault(items[i], []).append(i)
        self.queries = [(item, place[at], (column["times"] * column["weight"])[at]) for item, at in by_item.items()]


# --- answering -------------------------------------------------------------


def accumulate(
    lists: list[tuple[np.ndarray, np.ndarray]], bounds: np.ndarray, n_docs: int, k: int, reached: int
) -> tuple[np.ndarray, np.ndarray]:
    """Documents that may be among the best k, and their exact scores.

    ``lists`` are the terms' documents and what each adds, the rarest term
    first, and ``bounds`` the most that a term adds. ``reached`` is a score that
    k documents from elsewhere have, or 0.
    """
    score, there = np.zeros(n_docs, np.int64), np.zeros(n_docs, bool)
    to_come = np.cumsum(bounds[::-1])[::-1]
    open_, held = True, 0
    for (docs, adds), rest in zip(lists, to_come.tolist()):
        if open_:
            # rest bounds what a document not met yet can still get
            if held >= k and rest >= reached:
                partial = score[there]
                reached = max(reached, int(np.partition(partial, len(partial) - k)[len(partial) - k]))
            open_ = rest >= reached
        if open_:
            score[docs] += adds
            there[docs] = True
            held = int(there.sum())
        elif held:
            met = there[docs]
            score[docs[met]] += adds[met]
    found = np.flatnonzero(there)
    return found, score[found]


def _ranked(scores: np.ndarray, ids: np.ndarray, unnamed: np.ndarray, k: int) -> np.ndarray:
    """Places of the best k: by score, then id, rows without an id last."""
    if len(scores) > k:
        least = np.partition(scores, len(scores) - k)[len(scores) - k]
        near = np.flatnonzero(scores >= least)
    else:
        near = np.arange(len(scores))
    return near[np.lexsort((ids[near], unnamed[near], -scores[near]))][:k]


def _answers(batches, block: Block, n: int, total: int, k: int):
    best: dict = {}
    for b in batches:
        for row in b.to_pylist():
            sizes = np.array(row["sizes"], object)
            norm = np.array(100 - 75 + 75 * sizes * n // total, np.int64)
            terms, counts = np.array(row["terms"], np.int64).view(np.uint64), np.array(row["counts"], np.int64)
            ends = np.cumsum(counts)
            at = np.minimum(np.searchsorted(terms, block.terms), len(terms) - 1)
            known = np.flatnonzero(terms[at] == block.terms)
            if not len(known):
                continue
            # documents and parts of scores of every term of the block that the segment holds
            at = at[known]
            length = counts[at]
            cut = np.concatenate([[0], np.cumsum(length)])
            posting = np.repeat(ends[at] - length - cut[:-1], length) + np.arange(cut[-1])
            docs = np.frombuffer(row["docs"], np.uint16)[posting].astype(np.int64)
            tf = np.frombuffer(row["tfs"], row["tf_type"])[posting].astype(np.int64)
            part = 1000000000 * tf // (1000 * tf + 8 * norm[docs])
            most = np.maximum.reduceat(part, cut[:-1])
            slot = np.full(len(block.terms), -1)
            slot[known] = np.arange(len(known))
            named = np.array([i if i is not None else 0 for i in row["doc_ids"]], np.int64)
            unnamed = np.array([i is None for i in row["doc_ids"]])
            for item, place, weight in block.queries:
                s = slot[place]
                here = s >= 0
                if not here.any():
                    continue
                s, w = s[here], weight[here]
                before = best.get(item)
                reached = int(before[0][-1]) if before is not None and len(before[0]) == k else 0
                bounds = w * most[s]
                if int(bounds.sum()) < reached:
                    continue
                lists = [(docs[cut[j] : cut[j + 1]], v * part[cut[j] : cut[j + 1]]) for j, v in zip(s.tolist(), w.tolist())]
                found, score = accumulate(lists, bounds, len(named), k, reached)
                good = score > 0
                found, score = found[good], score[good]
                new = (score, named[found], unnamed[found])
                if before is not None:
                    new = tuple(map(np.concatenate, zip(before, new)))
                keep = _ranked(*new, k)
                best[item] = tuple(c[keep] for c in new)
    schema = arrow_schema(_FOUND)
    for item, (scores, ids, unnamed) in best.items():
        yield batch(
            schema,
            item_id=[item] * len(scores),
            doc_id=pa.array(ids, pa.int64(), mask=unnamed),
            score=scores,
        )


def _best(found: DataFrame, k: int, *by) -> DataFrame:
    order = Window.partitionBy("item_id", *by).orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def lexical_search(docs: DataFrame, items: DataFrame, k: int = K, block_terms: int = BLOCK_TERMS) -> DataFrame:
    """(item_id, rank, doc_id, score): each item's best k documents with a score above 0.

    Null and empty texts have no terms: such documents are not found and do not
    count, such items have no rows. Rows with a null or repeated doc_id are
    documents of their own; with equal scores the smaller id comes first, a
    null id last, equal ids in either order. Rows of one item_id (or of none)
    are one query of all their terms. Where either table is empty, nothing is
    found. Other columns are not read. A segment of the index holds 4 MB of text,
    a longer text alone, so a task holds some segments; a block of queries holds
    ``block_terms`` terms, or one longer query.
    """
    spark = docs.sparkSession
    index = landed(inverted_index(docs), "index")
    asked, n, total = weighted_terms(items, index)
    asked = landed(asked, "weighted")
    blocks = -(-asked.count() // block_terms)
    found = new_folder(spark, "found")
    spark.createDataFrame([], _FOUND).write.parquet(found)
    for number in range(blocks):
        mine = F.pmod(F.xxhash64("item_id"), F.lit(blocks)) == number
        queries = spark.sparkContext.broadcast(Block(asked.where(mine).toArrow()))

        def answer(batches, queries=queries):
            return _answers(batches, queries.value, n, total, k)

        index.mapInArrow(answer, _FOUND).write.mode("append").parquet(found)
        queries.unpersist()
    parts = _best(spark.read.schema(_FOUND).parquet(found), k, F.pmod(F.xxhash64("doc_id", "score"), F.lit(MERGES)))
    return _best(parts.select("item_id", "doc_id", "score"), k).select(
        "item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score"
    )
