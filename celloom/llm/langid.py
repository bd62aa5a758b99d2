"""Language of a text by unigrams over pieces, summed over all segmentations.

Each language has a probability for every piece of a fixed public vocabulary.
A word's probability is the sum over all its segmentations into pieces, by the
forward algorithm; a text's is the product over its words. Any single byte is a
piece too, with one small probability in all languages, so every word has a
segmentation. The probabilities are fitted by expectation-maximisation on at
most TRAIN_DOCS documents of each language.

Texts are lower-cased; words are runs of ASCII letters and all other non-ASCII
characters. A word is scored with a space before it. Long words, as in scripts
without spaces, go through the forward algorithm block by block, many at a time:
what is carried on is the probability of reaching each of the last places that a
piece can begin at. Only beyond PART bytes a word is scored in parts, cut between
characters.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from celloom.llm.common import arrow_schema, batch, held_out
from celloom.llm.hashing import PLAIN, _power_tables, grouped_words

VOCABULARY = "/opt/tokenizers/piece_bpe_32k.model"
#: Most documents of a language that are learned from, first in the order of a hash of their ids.
TRAIN_DOCS = 300
ROUNDS = 4
#: Bytes from which a word is long, of a block, and of a part of a very long word; the fit cuts words where they are long.
LONGEST, BLOCK, PART = 40, 128, 4096
#: Places after which probabilities are scaled, and long words at a time.
_SCALED, _ROWS = 16, 2048
#: Probability of a single byte, and what each piece is given beside its expected count.
BYTE, SMOOTH = 1e-5, 0.05
#: Scored words that a task keeps.
KEPT_WORDS = 1 << 18
UNDETERMINED = "und"

_BETWEEN = np.ones(256, bool)
_BETWEEN[[*range(65, 91), *range(97, 123), *range(128, 256)]] = False
_LETTERS = re.compile(r"[^\W\d_]")
_COUNTS = "lang string, pieces binary, logs binary"


class Model(NamedTuple):
    """Languages, the pieces' sorted hashes, the probability of each piece in each language, and the longest piece's bytes."""

    langs: list[str]
    hashes: np.ndarray
    probabilities: np.ndarray
    longest: int


def vocabulary(path: str) -> tuple[np.ndarray, int]:
    """Sorted hashes of the pieces of a SentencePiece model that words can have, and the bytes of the longest.

    These are all its pieces of lower-case letters; a space may stand first.
    """
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    pieces = (model.id_to_piece(i) for i in range(model.get_piece_size()) if not (model.is_control(i) or model.is_byte(i) or model.is_unknown(i)))
    found = set()
    for piece in pieces:
        space, letters = piece[:1] == "▁", piece[piece[:1] == "▁" :]
        raw = b" " * space + letters.encode()
        if letters.isalpha() and letters == letters.lower():
            found.add(raw)
    return np.unique([_raw_hash(np.frombuffer(p, np.uint8)) for p in found]), max(map(len, found))


def _raw_hash(raw: np.ndarray) -> np.uint64:
    power, _ = _power_tables(len(raw))
    return np.sum(PLAIN[raw] * power[: len(raw)], dtype=np.uint64)


def _edges(words: np.ndarray, hashes: np.ndarray, longest: int, after: int = 0) -> Iterator[tuple[int, int, np.ndarray]]:
    """Of words of one length, as rows of bytes: each end beyond `after`, start, and the piece between, -1 for none."""
    length = words.shape[1]
    power, inverse = _power_tables(length + 1)
    sums = np.zeros((length + 1, len(words)), np.uint64)
    for k in range(length):
        sums[k + 1] = sums[k] + PLAIN[words[:, k]] * power[k]
    for end in range(after + 1, length + 1):
        for start in range(max(0, end - longest), end):
            wanted = (sums[end] - sums[start]) * inverse[start]
            at = np.minimum(np.searchsorted(hashes, wanted), len(hashes) - 1)
            yield end, start, np.where(hashes[at] == wanted, at, -1)


def _advance(total: np.ndarray, words: np.ndarray, model: Model, after: int, stop=None) -> np.ndarray:
    """Fill in the probabilities of reaching each place beyond `after`; the logs of what they were scaled by.

    `total` is by place, word and language. `stop` is told of each place once it is reached, with the logs so far.
    """
    table = np.vstack([model.probabilities, np.zeros(len(model.langs))])
    logs = np.zeros(total.shape[1:])
    for end, start, piece in _edges(words, model.hashes, model.longest, after):
        if start == end - 1:
            total[end] += total[start] * (table[piece] + BYTE)
            # the last start of an end: the place is reached
            if stop is not None:
                stop(end, total, logs)
            if end % _SCALED == 0:
                scale = total[end].copy()
                total[max(0, end - model.longest) : end + 1] /= scale
                logs += np.log(scale)
        else:
            hit = np.flatnonzero(piece >= 0)
            total[end, hit] += total[start, hit] * table[piece[hit]]
    return logs


def forward(words: np.ndarray, model: Model) -> np.ndarray:
    """Log probabilities of words of one length (rows of bytes), by language."""
    total = np.zeros((words.shape[1] + 1, len(words), len(model.langs)))
    total[0] = 1
    logs = _advance(total, words, model, 0)
    return np.log(total[-1]) + logs


def forward_long(words: list[bytes], model: Model) -> np.ndarray:
    """The same of words of any lengths, all of them a block further at a time."""
    order = sorted(range(len(words)), key=lambda i: -len(words[i]))
    lengths = np.array([len(words[i]) for i in order])
    kept = model.longest - 1
    out, logs = np.zeros((len(words), len(model.langs))), np.zeros((len(words), len(model.langs)))
    # the probabilities of reaching the last places: before the first block, its beginning only
    carried = np.zeros((kept + 1, len(words), len(model.langs)))
    carried[-1] = 1
    for done in range(0, int(lengths[0]), BLOCK):
        n = int((lengths > done).sum())
        rows = np.zeros((n, kept + BLOCK), np.uint8)
        for k in range(n):
            part = words[order[k]][max(0, done - kept) : done + BLOCK]
            at = kept - min(done, kept)
            rows[k, at : at + len(part)] = np.frombuffer(part, np.uint8)
        total = np.concatenate([carried[:, :n], np.zeros((BLOCK, n, len(model.langs)))])
        ends = lengths[:n] - done + kept

        def reached(end: int, total: np.ndarray, scaled: np.ndarray, ends=ends) -> None:
            here = np.flatnonzero(ends == end)
            if len(here):
                out[here] = np.log(total[end, here]) + logs[here] + scaled[here]

        scaled = _advance(total, rows, model, kept, reached)
        logs[:n] += scaled
        carried = total[-kept - 1 :]
    result = np.empty_like(out)
    result[order] = out
    return result


def fit(words: list[np.ndarray], counts: list[np.ndarray], hashes: np.ndarray, longest: int) -> np.ndarray:
    """Piece probabilities by expectation-maximisation over words, grouped by length, with counts."""
    edges = [list(_edges(w, hashes, longest)) for w in words]
    expected = np.zeros(len(hashes) + 1)
    for group, count in zip(edges, counts):
        for _, _, piece in group:
            expected += np.bincount(piece + 1, weights=count, minlength=len(hashes) + 1)
    for _ in range(ROUNDS):
        p = expected[1:] + SMOOTH
        p = np.concatenate([[0.0], p / p.sum()])
        expected = np.zeros(len(hashes) + 1)
        for w, group, count in zip(words, edges, counts):
            length = w.shape[1]
            ahead, behind = np.zeros((length + 1, len(w))), np.zeros((length + 1, len(w)))
            ahead[0], behind[length] = 1, 1
            value = [p[piece + 1] + (BYTE if start == end - 1 else 0) for end, start, piece in group]
            for (end, start, _), v in zip(group, value):
                ahead[end] += ahead[start] * v
            for (end, start, _), v in zip(reversed(group), reversed(value)):
                behind[start] += behind[end] * v
            for end, start, piece in group:
                share = ahead[start] * p[piece + 1] * behind[end] / ahead[length]
                expected += np.bincount(piece + 1, weights=share * count, minlength=len(hashes) + 1)
    p = expected[1:] + SMOOTH
    return p / p.sum()


def _between(data: np.ndarray, cut: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Cuts moved back to where a character begins, as long as something stays before them."""
    for _ in range(3):
        inside = (cut < len(data)) & (cut > starts + 1)
        inside &= (data[np.minimum(cut, len(data) - 1)] & 0xC0) == 0x80
        cut = cut - inside
    return cut


def _by_length(data: np.ndarray, starts: np.ndarray, ends: np.ndarray):
    """Words as rows of bytes, by length, with the words' indices; a space stands before each, longer words are cut."""
    index, space = np.arange(len(starts)), 1
    while len(starts):
        cut = np.minimum(ends, starts + LONGEST - 1)
        cut = np.where(cut < ends, _between(data, cut, starts), cut)
        lengths = cut - starts
        order = np.argsort(lengths, kind="stable")
        for part in np.split(order, np.flatnonzero(np.diff(lengths[order])) + 1):
            n = int(lengths[part[0]])
            rows = np.full((len(part), n + space), 32, np.uint8)
            rows[:, space:] = data[starts[part][:, None] + np.arange(n)]
            yield rows, index[part]
        more = cut < ends
        starts, ends, index, space = cut[more], ends[more], index[more], 0


def _long_words(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> Iterator[tuple[int, bytes]]:
    """Words with a space before them, those beyond PART bytes in parts, with the words' indices."""
    for i, (start, end) in enumerate(zip(starts.tolist(), ends.tolist())):
        at, space = start, b" "
        while at < end:
            cut = end if end - at <= PART else int(_between(data, np.array([at + PART]), np.array([at]))[0])
            yield i, space + data[at:cut].tobytes()
            at, space = cut, b""


def _lowered(texts) -> list[bytes]:
    return [b"" if t is None else t.lower().encode("utf-8", "replace") for t in texts]


def _fit_language(shared):
    def run(key: tuple, table: pa.Table) -> pa.Table:
        seen: dict[bytes, int] = {}
        for _, words, _ in grouped_words(_lowered(table.column("text").to_pylist()), _BETWEEN):
            _, first, counts = np.unique(words.hashes, return_index=True, return_counts=True)
            for rows, index in _by_length(words.data, words.starts[first], words.ends[first]):
                for raw, count in zip(rows, counts[index]):
                    raw = raw.tobytes()
                    seen[raw] = seen.get(raw, 0) + int(count)
        groups: dict[int, list[bytes]] = {}
        for raw in sorted(seen):
            groups.setdefault(len(raw), []).append(raw)
        words = [np.frombuffer(b"".join(g), np.uint8).reshape(len(g), -1) for g in groups.values()]
        counts = [np.array([seen[raw] for raw in g], float) for g in groups.values()]
        p = fit(words, counts, *shared.value)
        return pa.Table.from_batches([batch(arrow_schema("lang string, p binary"), lang=[key[0].as_py()], p=[p.tobytes()])])

    return run


def training_texts(docs: DataFrame, per_language: int = TRAIN_DOCS) -> DataFrame:
    """(doc_id, lang, text) of so many ids of each language, without held out rows: of each id one text, the first in
    order, as an id may have any number of rows."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.col("lang").cast("string").alias("lang"))
    rows = rows.where(~held_out() & F.col("lang").isNotNull() & F.col("text").isNotNull())
    order = Window.partitionBy("lang").orderBy(F.xxhash64("doc_id"), "doc_id")
    known = rows.select("doc_id", "lang").distinct()
    chosen = known.withColumn("nth", F.row_number().over(order)).where(F.col("nth") <= per_language).drop("nth")
    # at most `per_language` ids for each language
    return rows.join(F.broadcast(chosen), ["doc_id", "lang"]).groupBy("doc_id", "lang").agg(F.min("text").alias("text"))


def learn(docs: DataFrame, path: str = VOCABULARY, per_language: int = TRAIN_DOCS) -> Model:
    """The model of the languages of `docs` (doc_id, text, lang), without held out rows."""
    hashes, longest = vocabulary(path)
    shared = docs.sparkSession.sparkContext.broadcast((hashes, longest))
    sample = training_texts(docs, per_language)
    found = sample.groupBy("lang").applyInArrow(_fit_language(shared), "lang string, p binary").collect()
    found.sort(key=lambda r: r["lang"])
    columns = [np.frombuffer(r["p"]) for r in found]
    return Model([r["lang"] for r in found], hashes, np.stack(columns, axis=1) if columns else np.zeros((len(hashes), 0)), longest)


def has_letter(text: str | None) -> bool:
    return text is not None and any(m.group().isalpha() for m in _LETTERS.finditer(text))


class _Scorer:
    """Log probabilities of texts, with the words already scored by this task."""

    def __init__(self, model: Model):
        self.model = model
        self.clear()

    def clear(self) -> None:
        self.known = np.zeros(0, np.uint64)
        self.logs = np.zeros((0, len(self.model.langs)))

    def _add(self, words, hashes: np.ndarray, first: np.ndarray) -> None:
        logs = np.zeros((len(hashes), len(self.model.langs)))
        starts, ends = words.starts[first], words.ends[first]
        short = np.flatnonzero(ends - starts < LONGEST)
        for rows, index in _by_length(words.data, starts[short], ends[short]):
            for at in range(0, len(rows), 1 << 14):
                logs[short[index[at : at + (1 << 14)]]] = forward(rows[at : at + (1 << 14)], self.model)
        long = np.flatnonzero(ends - starts >= LONGEST)
        parts = list(_long_words(words.data, starts[long], ends[long]))
        for at in range(0, len(parts), _ROWS):
            index, raw = zip(*parts[at : at + _ROWS])
            np.add.at(logs, long[list(index)], forward_long(list(raw), self.model))
        both = np.concatenate([self.known, hashes])
        order = np.argsort(both, kind="stable")
        self.known, self.logs = both[order], np.concatenate([self.logs, logs])[order]

    def __call__(self, texts: list[bytes]) -> np.ndarray:
        total = np.zeros((len(texts), len(self.model.langs)))
        for start, words, at in grouped_words(texts, _BETWEEN):
            hashes, first, inverse = np.unique(words.hashes, return_index=True, return_inverse=True)
            if not len(hashes):
                continue
            if len(self.known) > KEPT_WORDS:
                self.clear()
            new = ~np.isin(hashes, self.known, assume_unique=True)
            if new.any():
                self._add(words, hashes[new], first[new])
            logs = self.logs[np.searchsorted(self.known, hashes)][inverse]
            owner = start + np.repeat(np.arange(len(at) - 1), np.diff(at))
            for k in range(total.shape[1]):
                total[:, k] += np.bincount(owner, weights=logs[:, k], minlength=len(texts))
        return total


def identified(docs: DataFrame, model: Model) -> DataFrame:
    """`docs` with lang_pred and score of every text in two more columns."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("lang_pred string, score double")
    def identify(parts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        langs = shared.value.langs
        scorer = _Scorer(shared.value)
        for texts in parts:
            named, score = [UNDETERMINED] * len(texts), np.zeros(len(texts))
            if langs:
                logs = scorer(_lowered(texts))
                best = logs.argmax(axis=1)
                chance = 1 / np.exp(logs - logs.max(axis=1, keepdims=True)).sum(axis=1)
                for i, text in enumerate(texts):
                    if has_letter(text):
                        named[i], score[i] = langs[best[i]], chance[i]
            yield pd.DataFrame({"lang_pred": named, "score": score})

    columns = [F.col(f"`{c}`") for c in docs.columns]
    name = "_found"
    while name in docs.columns:
        name += "_"
    return docs.withColumn(name, identify("text")).select(*columns, f"{name}.lang_pred", f"{name}.score")


def language_id(docs: DataFrame, path: str = VOCABULARY) -> DataFrame:
    """doc_id, held_out, lang_pred and score of every row of `docs` (doc_id, text, lang).

    lang_pred is a language that was learned, `und` with score 0 for a text
    that is null or has no letter, or where no language could be learned; of
    equally likely languages the first by name. score is the share of the
    language in the sum of all languages' probabilities. Repeated rows are
    returned each, a null doc_id counts as held out, other columns are ignored.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out().alias("held_out"), "text")
    return identified(rows, learn(docs, path)).select("doc_id", "held_out", "lang_pred", "score")
