"""Periodic runs of words: Lyndon grouping under both orders, roots extended into runs.

A run is a stretch of words with smallest period p (words p apart are equal)
that cannot be made longer without losing the period. Every run holds a Lyndon
root: a word sequence of length p that is the longest Lyndon word at its place
under some order of the words or under the reverse of that order.

The first phase of Baier's suffix sorter finds the longest Lyndon word at every
place. Suffixes are grouped by the Lyndon word known so far, at first their
first word. Groups are taken from the highest down. Each member of a group is
final: its Lyndon word ends where the next place starts that was not taken yet.
It extends the Lyndon word of the nearest place before it that was not taken,
which moves to a group of its own, just above the one it was in. A place that is
extended k times by one group has k equal Lyndon words after it: k of them in a
row, from two on, are a root that repeats. Such roots are extended to both sides
by comparing the text with itself p words on, block by block, which gives runs.

Any order of the words will do, so words are numbered as they first occur.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

#: Bytes of text that are answered in one batch.
BATCH_BYTES = 1 << 22
_RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
_SCHEMA = "doc_id long, n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed string"
_ARROW = pa.schema(
    [("doc_id", pa.int64()), ("n_words", pa.int64()), ("runs", pa.list_(_RUN)), ("collapsed", pa.string())]
)

Run = tuple[int, int, int]


def repeated_roots(words: list[int], symbols: int, reverse: bool) -> Iterator[Run]:
    """(place, period, times in a row) of Lyndon roots that repeat, under one order of the symbols.

    Each place is taken once and extends one other place, so all is linear in the words.
    """
    n = len(words)
    members: list[list[int]] = [[] for _ in range(symbols)]
    for i, w in enumerate(words):
        members[w].append(i)
    group, live = list(words), [len(m) for m in members]
    # the groups as a list from the highest down; the last slot of each list stands for "none"
    if reverse:
        first, below, above = 0, [*range(1, symbols), -1], [*range(-1, symbols - 1)]
    else:
        first, below, above = symbols - 1, [*range(-1, symbols - 1)], [*range(1, symbols), -1]
    # the places not taken yet; slot n is the end of the text, slot -1 its beginning
    left, right = [*range(-1, n), -1], [*range(1, n + 1), -1, 0]
    now = first
    while now >= 0:
        if live[now] == 1:
            for i in members[now]:
                if group[i] == now:
                    break
            before, after = left[i], right[i]
            right[before], left[after] = after, before
            extended = [(before, 1)] if before >= 0 else ()
        else:
            extended, last, times, start, period = [], -2, 0, 0, 0
            for i in members[now]:
                if group[i] != now:
                    continue
                before, after = left[i], right[i]
                right[before], left[after] = after, before
                if before == last:
                    times += 1
                    continue
                if times > 1:
                    yield start, period, times
                if last >= 0:
                    extended.append((last, times))
                last, times, start, period = before, 1, i, after - i
            if times > 1:
                yield start, period, times
            if last >= 0:
                extended.append((last, times))
        members[now] = ()
        # of one group's places, those extended more often stand above the others
        for k in (1,) if len(extended) == 1 == extended[0][1] else sorted({k for _, k in extended}, reverse=True):
            made: dict[int, int] = {}
            for j, times in extended:
                if times != k:
                    continue
                own = group[j]
                new = made.get(own)
                if new is None:
                    if live[own] == 1:
                        continue  # alone in its group: the group itself is extended
                    new = made[own] = len(members)
                    members.append([j])
                    live.append(1)
                    over = above[own]
                    below.append(own)
                    above.append(over)
                    below[over] = above[own] = new
                else:
                    members[new].append(j)
                    live[new] += 1
                live[own] -= 1
                group[j] = new
        now = below[now]
        while now >= 0 and not live[now]:
            now = below[now]


def _agreeing(words: np.ndarray, at: int, period: int, step: int) -> int:
    """How many words in a row from a place on (or back) equal the word a period later."""
    done, block = 0, 16
    while True:
        if step > 0:
            piece = words[at + done : at + done + block]
            other = words[at + done + period : at + done + period + block]
            piece = piece[: len(other)]
        else:
            low = max(0, at - done - block + 1)
            piece = words[low : max(0, at - done + 1)][::-1]
            other = words[low + period : at - done + 1 + period][::-1]
        differ = np.flatnonzero(piece != other)
        if len(differ):
            return done + int(differ[0])
        done += len(piece)
        if len(piece) < block:
            return done
        block = min(2 * block, 1 << 20)


def word_runs(words: list, least_words: int = 24, least_periods: int = 3) -> list[Run]:
    """(start, length, period) of every run of at least so many words and periods, by start, then period.

    From three periods on a run holds two whole roots in a row, as is looked for here.
    """
    if least_periods < 3:
        raise ValueError("runs of less than three periods may hold one whole root only")
    number: dict = {}
    ids = [number.setdefault(w, len(number)) for w in words]
    if len(ids) < least_words or len(number) == len(ids):
        return []
    numbers, found = None, set()
    for reverse in (False, True):
        for place, period, times in repeated_roots(ids, len(number), reverse):
            # under the order that suits a run, all its whole roots but for parts at both ends are in a row
            if (times + 2) * period - 2 < max(least_words, least_periods * period):
                continue
            if numbers is None:
                numbers = np.array(ids)
            start = place - _agreeing(numbers, place - 1, period, -1) if place else 0
            end = place + period + _agreeing(numbers, place, period, 1)
            if end - start >= max(least_words, least_periods * period):
                found.add((start, end - start, period))
    return sorted(found, key=lambda r: (r[0], r[2]))


def kept_words(words: list, runs: list[Run]) -> list:
    """The words, without those that some run holds after its first period."""
    kept, at = [], 0
    for start, end in sorted((s + p, s + length) for s, length, p in runs):
        if start > at:
            kept += words[at:start]
        at = max(at, end)
    return kept + words[at:] if at else words


def periodic_runs(docs: DataFrame, least_words: int = 24, least_periods: int = 3) -> DataFrame:
    """(doc_id, n_words, runs, collapsed): each row's runs and its text with runs cut to one period.

    Words are what bytes 0x20 and 0x09-0x0D leave between them; ``collapsed``
    joins the kept ones by one space. Each row is worked on by itself, nothing
    is shuffled; a task holds one text and some 300 bytes for each of its words.
    Null and empty texts have no words, no runs and collapse to an empty text;
    a null or repeated id is carried along, a row stays a row; an empty table
    gives none; other columns are not read. Runs come by start, then period.
    """

    def answer(batches):
        rows, size = [], 0

        def flush():
            ids, counts, runs, texts = zip(*rows)
            runs = [[{"start": s, "length": n, "period": p} for s, n, p in r] for r in runs]
            columns = zip((ids, counts, runs, texts), _ARROW)
            return pa.record_batch([pa.array(list(c), f.type) for c, f in columns], schema=_ARROW)

        for batch in batches:
            for doc, text in zip(batch.column(0), batch.column(1)):
                words = (text.as_py() or b"").split()
                runs = word_runs(words, least_words, least_periods)
                collapsed = b" ".join(kept_words(words, runs)).decode()
                rows.append((doc.as_py(), len(words), runs, collapsed))
                size += len(collapsed) + 64
                if size > BATCH_BYTES:
                    yield flush()
                    rows, size = [], 0
        if rows:
            yield flush()

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("binary").alias("text")).mapInArrow(answer, _SCHEMA)


def run_digest(runs: DataFrame) -> DataFrame:
    """(doc_id, n_runs, the run of most periods, runs_sha256, collapsed_sha256) of ``periodic_runs``.

    Lengths over periods are compared as whole numbers crosswise; of equal
    ones the first stands, which has the smallest start, then period.
    """
    more = lambda a, b: b["length"] * a["period"] > a["length"] * b["period"]
    best = F.aggregate("runs", F.get("runs", F.lit(0)), lambda a, b: F.when(more(a, b), b).otherwise(a))
    line = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    return runs.withColumn("_best", best).select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        F.col("_best.start").alias("start"),
        F.col("_best.length").alias("length"),
        F.col("_best.period").alias("period"),
        F.floor(F.expr("1000 * _best.length div _best.period")).cast("long").alias("exponent_milli"),
        F.sha2(F.array_join(line, "").cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )


def with_planted_runs(docs: DataFrame) -> DataFrame:
    """Documents of which one in ten, by the checksum of its id, repeats some of its words to its end.

    With h the checksum, g = h div 10 and n words, words from a = g mod n on
    become the first 1 + (n - a) div (3 + g mod 8) of them, over and over.
    A null id plants nothing.
    """
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    planted = docs.select("doc_id", "text", h.alias("_h")).withColumn(
        "_words", F.when(F.col("_h") % 10 == 0, F.regexp_extract_all("text", F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0)))
    )
    planted = planted.withColumn("_n", F.size("_words")).withColumn("_g", F.expr("_h div 10"))
    planted = planted.withColumn("_a", F.when(F.col("_n") > 0, F.col("_g") % F.col("_n")).cast("int"))
    planted = planted.withColumn("_p", F.expr("cast(1 + (_n - _a) div (3 + _g % 8) as int)"))
    repeated = F.expr(
        "array_join(slice(concat(slice(_words, 1, _a), flatten(array_repeat(slice(_words, _a + 1, _p),"
        " cast(ceil((_n - _a) / _p) as int)))), 1, _n), ' ')"
    )
    return planted.select("doc_id", F.when(F.col("_n") > 0, repeated).otherwise(F.col("text")).alias("text"))
