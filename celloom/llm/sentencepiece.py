"""SentencePiece encoding and decoding over a relational lattice.

A text, with a space put first, falls into words: a run of spaces and what follows it
up to the next space, line end or tab; line ends and tabs stand alone. What a word ends
with, as far as no two of its characters meet in a piece (a comma, digits), is cut off
character by character: these have one path each and take no part in that before them. No
piece of the vocabulary goes over such a cut, so words are encoded one by one,
and each distinct word once:

1. Every substring of up to LONGEST_PIECE characters of a word is a row; an equi-join
   with the piece table leaves the edges of the word's lattice. A character
   that is no piece gets an edge of its own, whose ids are its UTF-8 bytes'.
2. Edges are grouped by word and a higher-order aggregate folds them, by where
   they end, into the best edge into each place (Viterbi). The way back over these
   from a word's end, its best path, is read off for a batch of words at once.
3. Words beyond LONGEST_WORD characters are not cut. They are exploded by blocks, each
   with the characters before it that a piece can reach, and a word's edges are not
   grouped but sorted by where they end and folded as a stream: the scores of the
   last LONGEST_PIECE ends are carried on, and the last edge into each end is kept.

A path's score is the sum of its pieces' scores. The vocabulary's file ranks
its pieces for merging and has no probabilities, so a piece scores -ln(rank +
2.7), as Zipf's law has it; the ids are those of a unigram model with these
scores, not those of greedy merging. Of equal paths the one with the longer
last piece is taken.

Ids go back to documents through two tables: the most frequent words, with at
most FREQUENT ids, are broadcast; a document's other words are joined to it by
hash, and texts meet them compressed. Decoding concatenates the pieces' bytes, so it gives back every text.
"""

from __future__ import annotations

from array import array
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import Column, DataFrame, functions as F

from celloom.llm.common import arrow_schema, batch, landed, utf8
from celloom.llm.hashing import range_hashes, running

VOCABULARY = "/opt/tokenizers/piece_bpe_32k.model"
LONGEST_PIECE = 16
#: Longest word in characters whose edges are grouped, the size of a longer word's blocks, and most ids of a broadcast word.
LONGEST_WORD = 256
#: Most ids of the words that are broadcast, so that a task's share of memory for them is some 20 MB.
FREQUENT = 1 << 20
#: Text bytes for each task that builds lattices, and most such tasks; more words a task are spilled.
TASK_BYTES, MOST_TASKS = 4 << 20, 20_000
#: Bytes of text that a task works on at once, and most distinct words that it holds while it counts.
SLICE_BYTES, HELD_WORDS = 1 << 20, 1 << 18
ZIPF, UNKNOWN = 2.7, 10.0
FIRST_BYTE = 3

_ALONE = np.zeros(256, bool)
_ALONE[[0x0A, 0x09]] = True
_BLOCKS = "hash long, n long, at long, before int, block string"
_EDGES = "hash long, n long, end long, size int, score double, id int"
_HASHED = "hash long, n long, ids array<int>"
_COUNTED = "word string, n long"
_MISSING = "row long, hash long"
_ENCODED = "doc_id long, ids array<int>, n_ids long, decoded binary"


class Pieces(NamedTuple):
    """Of each id the text with a space for the mark, the score, and the bytes it decodes to."""

    texts: list[str | None]
    scores: list[float]
    raw: list[bytes]


def pieces(path: str = VOCABULARY, runs: bool = False) -> Pieces:
    """The vocabulary of a SentencePiece model file; pieces of several spaces only with `runs`."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    texts, scores, raw = [], [], []
    first = next(i for i in range(model.get_piece_size()) if not (model.is_control(i) or model.is_byte(i) or model.is_unknown(i)))
    for i in range(model.get_piece_size()):
        piece = model.id_to_piece(i).replace("▁", " ")
        plain = not (model.is_control(i) or model.is_byte(i) or model.is_unknown(i))
        plain = plain and (" " not in piece[1:] or (runs and not piece.strip(" ")))
        texts.append(piece if plain else None)
        scores.append(-float(np.log(max(i - first, 0) + ZIPF)))
        raw.append(bytes([int(piece[3:5], 16)]) if model.is_byte(i) else piece.encode() if plain else b"")
    return Pieces(texts, scores, raw)


def cuts(vocabulary: Pieces) -> np.ndarray:
    """Of each two bytes, the first one's value times 256 and the second one's added, whether no piece has them side by side."""
    cut = np.ones((256, 256), bool)
    joined = np.frombuffer(b"\n".join(t.encode() for t in vocabulary.texts if t is not None), np.uint8)
    inside = (joined[:-1] != 0x0A) & (joined[1:] != 0x0A)
    cut[joined[:-1][inside], joined[1:][inside]] = False
    return cut.ravel()


class Words(NamedTuple):
    """Bytes of texts, each after a space, the places of their words, the words' hashes, and of each text its first word."""

    data: bytes
    starts: np.ndarray
    ends: np.ndarray
    hashes: np.ndarray
    firsts: np.ndarray


def words_of(texts: list[bytes], cut: np.ndarray) -> Words:
    """The words of texts, their ends cut off where `cut` says; an empty text has none."""
    data = b"".join([b" " + t if t else b"" for t in texts])
    begins = np.cumsum([0, *(len(t) + 1 if t else 0 for t in texts)])
    raw = np.frombuffer(data, np.uint8)
    first = np.ones(len(raw), bool)
    if len(raw):
        space, alone = raw == 0x20, _ALONE[raw]
        first[1:] = (space[1:] & ~space[:-1]) | alone[1:] | alone[:-1]
        first[begins[:-1][np.diff(begins) > 0]] = True
        # characters that meet the one before in a piece, and the last one of each word
        begun = (raw & 0xC0) != 0x80
        apart = np.append(True, cut[(raw[:-1].astype(np.uint16) << 8) | raw[1:]])
        met = np.flatnonzero(begun & ~apart & ~first)
        starts = np.flatnonzero(first)
        last = np.full(len(starts), -1)
        last[np.searchsorted(starts, met, side="right") - 1] = met
        first |= begun & (np.arange(len(raw)) > np.repeat(np.where(last < 0, starts, last), np.diff(np.append(starts, len(raw)))))
    starts = np.flatnonzero(first)
    ends = np.append(starts[1:], len(raw))[: len(starts)]
    return Words(data, starts, ends, range_hashes(running(raw), starts, ends), np.searchsorted(starts, begins))


def _slices(column: pa.Array, most: int) -> Iterator[tuple[int, list[bytes]]]:
    """A binary column's values, some bytes of them at a time, each time with the first one's place."""
    sizes = pc.binary_length(column).to_numpy(zero_copy_only=False)
    cuts = np.flatnonzero(np.diff(np.cumsum(sizes) // most)) + 1
    for at, end in zip([0, *cuts.tolist()], [*cuts.tolist(), len(column)]):
        if end > at:
            yield at, column.slice(at, end - at).to_pylist()


def _counted(cut):
    schema = arrow_schema(_COUNTED)

    def made(held: dict[bytes, int]) -> pa.RecordBatch:
        words = pa.array(list(held), pa.binary()).cast(pa.string())
        return pa.record_batch([words, pa.array(list(held.values()), pa.int64())], schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[bytes, int] = {}
        for b in batches:
            for _, texts in _slices(b.column("bytes"), SLICE_BYTES):
                found = words_of(texts, cut.value)
                _, at, seen = np.unique(found.hashes, return_index=True, return_counts=True)
                for start, end, n in zip(found.starts[at].tolist(), found.ends[at].tolist(), seen.tolist()):
                    word = found.data[start:end]
                    held[word] = held.get(word, 0) + n
                if len(held) > HELD_WORDS:
                    # those seen again are held on, so that they are not given out time and again
                    again = {word: n for word, n in held.items() if n > 1}
                    again = again if len(again) <= HELD_WORDS // 2 else {}
                    yield made({word: n for word, n in held.items() if word not in again})
                    held = again
        if held:
            yield made(held)

    return run


def distinct_words(rows: DataFrame, cut) -> DataFrame:
    """(word, n) of the column `bytes`: its words, counted by each task before any shuffle, as far as HELD_WORDS allows; a word can come several times."""
    return rows.select("bytes").mapInArrow(_counted(cut), _COUNTED)


def _paths(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Words with the hashes that they have in texts and the ids of their best paths, from the last edges into their places."""
    schema = arrow_schema(_HASHED)
    for b in batches:
        words = [w.encode() for w in b.column("word").to_pylist()]
        ends = np.cumsum([0, *map(len, words)])
        sums = running(np.frombuffer(b"".join(words), np.uint8))
        places = b.column("starts").value_lengths().to_numpy(zero_copy_only=False)
        starts, pieces = (b.column(c).flatten().to_numpy(zero_copy_only=False) for c in ("starts", "ids"))
        base = np.cumsum(places) - places
        word, at, of, taken = np.arange(len(words)), places - 1, [], []
        while len(word):
            of.append(word)
            taken.append(pieces[base[word] + at])
            at = starts[base[word] + at]
            word, at = word[at > 0], at[at > 0]
        of, ids = np.concatenate(of[::-1]), np.concatenate(taken[::-1])
        order = np.argsort(of, kind="stable")
        of, ids = of[order], ids[order].astype(np.int32)
        spelt = np.flatnonzero(ids < 0)
        if len(spelt):
            raw = [chr(-1 - i).encode() for i in ids[spelt].tolist()]
            times = np.ones(len(ids), np.int64)
            times[spelt] = [len(r) for r in raw]
            of, ids = np.repeat(of, times), np.repeat(ids, times)
            ids[ids < 0] = np.frombuffer(b"".join(raw), np.uint8).astype(np.int32) + FIRST_BYTE
        offsets = np.concatenate([[0], np.cumsum(np.bincount(of, minlength=len(words)))])
        hashes = range_hashes(sums, ends[:-1], ends[1:]).view(np.int64)
        lists = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(ids))
        yield pa.record_batch([pa.array(hashes), b.column("n").cast(pa.int64()), lists], schema=schema)


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks of long words, each with the characters before it that a piece can reach."""
    schema = arrow_schema(_BLOCKS)
    for b in batches:
        for word, n in zip(b.column("word").to_pylist(), b.column("n").to_pylist()):
            raw = np.frombuffer(word.encode(), np.uint8)
            name = range_hashes(running(raw), np.array([0]), np.array([len(raw)])).view(np.int64)[0]
            at = range(0, len(word), LONGEST_WORD)
            before = [min(k, LONGEST_PIECE - 1) for k in at]
            block = [word[k - c : k + LONGEST_WORD] for k, c in zip(at, before)]
            yield batch(schema, hash=[name] * len(at), n=[n] * len(at), at=list(at), before=before, block=block)


def _folded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Ids of long words from their edges, sorted by word, end and size, the longest first."""
    schema, names, ring = arrow_schema(_HASHED), arrow_schema(_EDGES).names, LONGEST_PIECE + 1
    word, last, scores, back, through = None, 0, [0.0] * ring, array("b"), array("i")
    out: dict[str, list] = {name: [] for name in schema.names}

    def close() -> None:
        path, at = [], last
        while at:
            piece = through[at - 1]
            path += [piece] if piece >= 0 else [FIRST_BYTE + c for c in reversed(chr(-1 - piece).encode())]
            at -= back[at - 1]
        for name, value in zip(schema.names, (*word, np.array(path[::-1], np.int32))):
            out[name].append(value)

    for b in batches:
        for name, n, end, size, score, piece in zip(*(b.column(k).to_pylist() for k in names)):
            if word is None or word[0] != name:
                if word is not None:
                    close()
                word, last, scores, back, through = (name, n), 0, [0.0] * ring, array("b"), array("i")
            score += scores[(end - size) % ring]
            if end > last:
                last = end
                scores[end % ring] = score
                back.append(size)
                through.append(piece)
            elif score > scores[end % ring]:
                scores[end % ring], back[-1], through[-1] = score, size, piece
        if out["hash"]:
            yield batch(schema, **out)
            out = {name: [] for name in schema.names}
    if word is not None:
        close()
        yield batch(schema, **out)


def _edges(strings: DataFrame, vocabulary: Pieces) -> DataFrame:
    """Rows of `strings` (piece, size) that are pieces or single characters, with score and id."""
    known = [(t, i, s) for i, (t, s) in enumerate(zip(vocabulary.texts, vocabulary.scores)) if t is not None]
    table = strings.sparkSession.createDataFrame(known, "piece string, id int, score double")
    unknown = min(s for _, _, s in known) - UNKNOWN
    # the vocabulary is of fixed size
    edges = strings.join(F.broadcast(table), "piece", "left").where("id is not null or size = 1")
    # a character that is no piece goes as its code point, below 0, until its path is known
    return edges.withColumns({"score": F.coalesce("score", F.lit(unknown)), "id": F.coalesce("id", -1 - F.ascii("piece"))})


def _sizes(end: Column) -> Column:
    return F.explode(F.sequence(F.lit(1), F.least(end, F.lit(LONGEST_PIECE)))).alias("size")


def long_paths(words: DataFrame, vocabulary: Pieces) -> DataFrame:
    """(hash, n, ids) of long distinct words (word, n)."""
    blocks = words.select("word", "n").mapInArrow(_blocks, _BLOCKS)
    stop = F.explode(F.sequence(F.col("before") + 1, F.length("block"))).alias("stop")
    spots = blocks.select("hash", "n", (F.col("at") - F.col("before")).alias("at"), "block", stop)
    strings = spots.select("*", _sizes(F.col("stop"))).select(
        "hash",
        "n",
        (F.col("at") + F.col("stop")).alias("end"),
        "size",
        F.substring(F.col("block"), F.col("stop") - F.col("size") + 1, F.col("size")).alias("piece"),
    )
    edges = _edges(strings, vocabulary).select(*arrow_schema(_EDGES).names)
    return edges.repartition("hash").sortWithinPartitions("hash", "end", F.desc("size")).mapInArrow(_folded, _HASHED)


def best_paths(words: DataFrame, vocabulary: Pieces) -> DataFrame:
    """(word, n, starts, ids) of distinct words (word, n), with start and id of the best path's last edge into each place; they are not shuffled if they are dealt out by word."""
    spots = words.select("n", "word", F.explode(F.sequence(F.lit(1), F.length("word"))).alias("end"))
    strings = spots.select("n", "word", "end", _sizes(F.col("end"))).select(
        "n", "word", "end", "size", F.substring(F.col("word"), F.col("end") - F.col("size") + 1, F.col("size")).alias("piece")
    )
    edge = F.struct("end", (F.col("end") - F.col("size")).alias("start"), "score", "id")
    grouped = _edges(strings, vocabulary).groupBy("word").agg(F.first("n").alias("n"), F.sort_array(F.collect_list(edge)).alias("edges"))

    def reached(score: Column, start: Column, piece: Column) -> Column:
        return F.array(F.struct(score.alias("score"), start.alias("start"), piece.alias("id")))

    def step(best: Column, e: Column) -> Column:
        """`best` has the last edge of the best path to each place so far, the first for the place before the word."""
        end = e["end"]
        score = best[e["start"]]["score"] + e["score"]
        new = reached(score, e["start"], e["id"])
        # edges of one end come longest first, so an equal score does not replace
        better = F.when(score > best[end]["score"], F.concat(F.slice(best, F.lit(1), end), new)).otherwise(best)
        return F.when(F.size(best) <= end, F.concat(best, new)).otherwise(better)

    best = grouped.select("word", "n", F.aggregate("edges", reached(F.lit(0.0), F.lit(0), F.lit(0)), step).alias("best"))
    return best.select("word", "n", F.col("best.start").alias("starts"), F.col("best.id").alias("ids"))


class Table(NamedTuple):
    """Sorted hashes of words, the first place of each that begins with the same `bits`, and their ids, one word's after the other's."""

    hashes: np.ndarray
    heads: np.ndarray
    bits: int
    offsets: np.ndarray
    ids: np.ndarray


def _table(hashes: np.ndarray, lists: pa.ListArray) -> Table:
    """The table of words with these hashes and ids; a word that comes again is left out."""
    hashes, first = np.unique(hashes.view(np.uint64), return_index=True)
    lists = lists.take(pa.array(first, pa.int64()))
    offsets = np.concatenate([[0], np.cumsum(lists.value_lengths().to_numpy(zero_copy_only=False))]).astype(np.int64)
    bits = max(len(hashes).bit_length(), 1)
    heads = np.searchsorted(hashes, np.arange(1 << bits, dtype=np.uint64) << np.uint64(64 - bits))
    return Table(hashes, heads.astype(np.int32), bits, offsets, lists.flatten().to_numpy(zero_copy_only=False).astype(np.int32))


def _found(table: Table, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places in a table, and whether they are the words."""
    if not len(table.hashes):
        return np.zeros(len(hashes), np.int64), np.zeros(len(hashes), bool)
    last = len(table.hashes) - 1
    at = np.minimum(table.heads[hashes >> np.uint64(64 - table.bits)], last)
    # hashes are spread evenly, so few share a head
    left = np.flatnonzero(table.hashes[at] < hashes)
    while len(left):
        at[left] += 1
        left = left[at[left] <= last]
        left = left[table.hashes[at[left]] < hashes[left]]
    at = np.minimum(at, last)
    return at, table.hashes[at] == hashes


def _missing(shared, cut):
    schema = arrow_schema(_MISSING)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids = b.column("row").to_numpy()
            for at, texts in _slices(b.column("bytes"), SLICE_BYTES):
                found = words_of(texts, cut.value)
                places = np.flatnonzero(~_found(shared.value, found.hashes)[1])
                hashes, text = found.hashes[places], np.searchsorted(found.firsts, places, side="right") - 1
                order = np.lexsort((hashes, text))
                hashes, text = hashes[order], text[order]
                new = np.ones(len(order), bool)
                new[1:] = (hashes[1:] != hashes[:-1]) | (text[1:] != text[:-1])
                yield batch(schema, row=ids[at + text[new]], hash=hashes[new].view(np.int64))

    return run


def encode(hashes: np.ndarray, *tables: Table) -> tuple[np.ndarray, np.ndarray]:
    """Ids of words from tables that together know all of them, and where each word's begin, and the last ones end."""
    lengths, starts, base = np.zeros(len(hashes), np.int64), np.zeros(len(hashes), np.int64), 0
    left = np.arange(len(hashes))
    for table in tables:
        at, hit = _found(table, hashes[left])
        at, known = at[hit], left[hit]
        starts[known] = table.offsets[at] + base
        lengths[known] = table.offsets[at + 1] - table.offsets[at]
        left = left[~hit]
        base += len(table.ids)
    assert not len(left), "a word without ids"
    offsets = np.concatenate([[0], np.cumsum(lengths)])
    place = np.repeat(starts - offsets[:-1], lengths) + np.arange(offsets[-1])
    return np.concatenate([table.ids for table in tables])[place], offsets


def decode(ids, raw: list[bytes]) -> bytes:
    """The text of ids: their bytes, without the space put first."""
    return b"".join([raw[i] for i in ids])[1:]


def _encoded(shared, raw, cut):
    schema = arrow_schema(_ENCODED)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unzip = zstandard.ZstdDecompressor()
        for b in batches:
            sizes = np.array([zstandard.frame_content_size(p) for p in b.column("packed").to_pylist()])
            edges = np.flatnonzero(np.diff(np.cumsum(sizes) // SLICE_BYTES)) + 1
            for at, end in zip([0, *edges.tolist()], [*edges.tolist(), b.num_rows]):
                part = b.slice(at, end - at)
                rare = part.column("rare").flatten()
                own = _table(rare.field("hash").to_numpy(zero_copy_only=False), rare.field("ids"))
                found = words_of([unzip.decompress(p) for p in part.column("packed").to_pylist()], cut.value)
                ids, offsets = encode(found.hashes, shared.value, own)
                ends = offsets[found.firsts]
                decoded = [decode(ids[x:y].tolist(), raw.value) for x, y in zip(ends[:-1].tolist(), ends[1:].tolist())]
                lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(ids))
                yield pa.record_batch([part.column("doc_id"), lists, pa.array(np.diff(ends)), pa.array(decoded, pa.binary())], schema=schema)

    return run


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = arrow_schema("doc_id long, row long, packed binary")
    squeeze = zstandard.ZstdCompressor(level=3)
    for b in batches:
        for at, texts in _slices(b.column("bytes"), SLICE_BYTES):
            ids, rows = (b.column(c).slice(at, len(texts)) for c in ("doc_id", "row"))
            yield batch(schema, doc_id=ids, row=rows, packed=[squeeze.compress(t) for t in texts])


def _frequent(types: DataFrame, most: int) -> Table:
    """The words that are seen most, as many as have `most` ids in all: all of a count or none; those of very many ids are not among them."""
    types = types.where(F.size("ids") <= LONGEST_WORD)
    counts = types.groupBy("n").agg(F.sum(F.size("ids")).alias("k")).orderBy(F.desc("n"))
    # as many rows as there are different counts that still fit
    total, least = 0, None
    for row in counts.toLocalIterator():
        if total + row.k > most:
            break
        total, least = total + row.k, row.n
    if least is None:
        return _table(np.zeros(0, np.int64), pa.array([], pa.list_(pa.int32())))
    got = types.where(F.col("n") >= least).select("hash", "ids").toArrow()
    return _table(got.column("hash").to_numpy(), got.column("ids").combine_chunks())


def encoded(docs: DataFrame, path: str = VOCABULARY, frequent: int = FREQUENT, runs: bool = True) -> DataFrame:
    """doc_id, ids, n_ids and decoded (the bytes that the ids give back) of every row of `docs` (doc_id, text).

    The vocabulary is whole unless `runs` is off: then it is without its pieces of several spaces. A null or empty text has no ids. Repeated rows are returned each, a null
    doc_id too; other columns are ignored.
    """
    spark = docs.sparkSession
    vocabulary = pieces(path, runs)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("row"), utf8().alias("bytes"))
    total = rows.agg(F.coalesce(F.sum(F.octet_length("bytes")), F.lit(0))).first()[0]
    tasks = min(max(16, total // TASK_BYTES), MOST_TASKS)
    cut = spark.sparkContext.broadcast(cuts(vocabulary))
    words = distinct_words(rows, cut).repartition(tasks, "word").groupBy("word")
    # an aggregate, so that the condition on it stays above the shuffle and both branches share that
    words = words.agg(F.sum("n").alias("n"), F.max(F.length("word")).alias("chars"))
    short, long = words.where(F.col("chars") <= LONGEST_WORD), words.where(F.col("chars") > LONGEST_WORD)
    types = best_paths(short, vocabulary).mapInArrow(_paths, _HASHED).unionByName(long_paths(long, vocabulary))
    types = landed(types, "words")
    shared = spark.sparkContext.broadcast(_frequent(types, frequent))
    raw = spark.sparkContext.broadcast(vocabulary.raw)
    missing = rows.select("row", "bytes").mapInArrow(_missing(shared, cut), _MISSING)
    rare = missing.join(types.select("hash", "ids"), "hash").groupBy("row").agg(F.collect_set(F.struct("hash", "ids")).alias("rare"))
    packed = rows.mapInArrow(_packed, "doc_id long, row long, packed binary")
    return packed.join(rare, "row", "left").mapInArrow(_encoded(shared, raw, cut), _ENCODED)


def round_trip(docs: DataFrame, path: str = VOCABULARY) -> DataFrame:
    """doc_id, n_ids, ids_sha256 (of the ids, comma-joined) and decoded_sha256 of every row, with the ids; all pieces are used."""
    found = encoded(docs, path, runs=True)
    listed = F.replace(F.btrim(F.col("ids").cast("string"), F.lit("[]")), F.lit(", "), F.lit(","))
    return found.select("doc_id", "n_ids", F.sha2(listed, 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"), "ids")
