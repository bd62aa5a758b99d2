"""Token ids as length-delimited binary records with masked checksums, and an index of their offsets.

A file is a row of frames: the payload's length as 8 bytes, the masked CRC-32C
of these 8, the payload, the masked CRC-32C of the payload; all little-endian. A
frame with an empty payload holds no record and is skipped. A payload is a
header of 16 bytes (flags, number of ids, document id) and the ids in 2 or 4
bytes each, filled up with zeros to a multiple of 4. Files in the order of their
numbers hold the documents in ascending order of their ids.

Documents are dealt out by ranges of their ids and sorted, encoded, and framed in
chunks; Spark's text writer puts the chunks into files, so its commit keeps files
of failed tasks out, on any file system. The separator it writes after a chunk is
an empty frame.

The index is made from the files: they are read back, every checksum is tested,
and each record's file, offset, length and first token's number are kept in a
table of their own. ``read_records`` reads any records by that table,
``shuffled_records`` all of them in a random order.
"""

from __future__ import annotations

import os
import re
import struct
import zlib
from functools import lru_cache
from itertools import chain, islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from celloom.llm.common import arrow_schema, batch, utf8
from celloom.llm.crc32c import crc32c, masked

END_ID = 1
#: Bytes of text in a chunk, and chunks in a file.
CHUNK_BYTES, FILE_CHUNKS = 1 << 22, 8
#: Words that a task remembers with their ids.
REMEMBERED = 1 << 19
#: 32-bit words that are checked at once.
_CHECKED = 1 << 20

# Payload header: flags (1: the document has no id; 4: ids take 4 bytes, else 2), number of ids, document id.
_HEADER = 4
_NO_ID, _WIDE = 1, 4
_EMPTY = masked(np.zeros(1, np.uint32))

_INDEX = "file string, offset long, length long, doc_id long, n_tokens long, ids_crc32 long, start long"


def _sums(words: np.ndarray) -> np.ndarray:
    """Masked checksums of rows of words of equal length."""
    n, width = words.shape
    return masked(crc32c(words.ravel(), np.arange(n) * width, np.full(n, width)))


def empty_frame() -> bytes:
    length = np.zeros((1, 2), np.uint32)
    return np.concatenate([length[0], _sums(length), _EMPTY]).astype("<u4").tobytes()


def frames(doc_ids: list, ids: np.ndarray, counts: np.ndarray, wide: bool) -> bytes:
    """One frame a document: its id (or none) and its share of the token ids."""
    counts = np.asarray(counts, np.int64)
    per_word = 1 if wide else 2
    body = _HEADER + -(-counts // per_word)
    whole = body + 4  # length, its checksum, payload, its checksum
    ends = np.cumsum(whole)
    at = ends - whole
    out = np.zeros(int(whole.sum()), np.uint32)
    # ids, two of them a word if they are narrow
    first = (at + 3 + _HEADER) * per_word
    place = np.repeat(first - np.concatenate([[0], np.cumsum(counts)[:-1]]), counts) + np.arange(len(ids))
    out.view(np.uint32 if wide else np.uint16)[place] = ids
    named = np.array([0 if i is None else i for i in doc_ids], np.int64).view(np.uint64)
    out[at + 3] = np.where([i is None for i in doc_ids], _NO_ID, 0) | (_WIDE if wide else 0)
    out[at + 4] = counts
    out[at + 5], out[at + 6] = named & np.uint64(0xFFFFFFFF), named >> np.uint64(32)
    size = (body * 4).astype(np.uint64)
    length = np.stack([size & np.uint64(0xFFFFFFFF), size >> np.uint64(32)], 1).astype(np.uint32)
    out[at], out[at + 1], out[at + 2] = length[:, 0], length[:, 1], _sums(length)
    out[ends - 1] = masked(crc32c(out, at + 3, body))
    return out.astype("<u4", copy=False).tobytes()


class Damaged(ValueError):
    """A frame's bytes do not agree with its checksums."""


def scan(content: bytes, name: str = "") -> tuple[np.ndarray, np.ndarray]:
    """Offsets and payload sizes of a file's records, each frame tested against its checksums."""
    offsets, sizes, at = [], [], 0
    while at < len(content):
        if len(content) - at < 16:
            raise Damaged(f"{name}: the frame at {at} is cut")
        size = struct.unpack_from("<Q", content, at)[0]
        if size % 4 or at + 16 + size > len(content):
            raise Damaged(f"{name}: the frame at {at} has no sound length")
        offsets.append(at)
        sizes.append(size)
        at += 16 + size
    offsets, sizes = np.array(offsets, np.int64), np.array(sizes, np.int64)
    if not len(offsets):
        return offsets, sizes
    words = np.frombuffer(content, "<u4")
    first = offsets // 4
    sound = masked(crc32c(words, first, np.full(len(first), 2))) == words[first + 2]
    full = np.flatnonzero(sizes)
    sound[sizes == 0] &= words[first[sizes == 0] + 3] == _EMPTY
    group = np.cumsum(sizes[full]) // (4 * _CHECKED)
    for part in np.split(full, np.flatnonzero(np.diff(group)) + 1) if len(full) else []:
        sums = masked(crc32c(words, first[part] + 3, sizes[part] // 4))
        sound[part] &= sums == words[first[part] + 3 + sizes[part] // 4]
    if not sound.all():
        raise Damaged(f"{name}: the frame at {offsets[~sound][0]} does not agree with its checksum")
    return offsets[full], sizes[full]


def payload(content: bytes, offset: int) -> tuple[int | None, np.ndarray]:
    """A record's document id and token ids."""
    flags, n, low, high = struct.unpack_from("<4I", content, offset + 12)
    ids = np.frombuffer(content, "<u4" if flags & _WIDE else "<u2", n, offset + 12 + 4 * _HEADER)
    doc = int(np.array([low | high << 32], np.uint64).view(np.int64)[0])
    return None if flags & _NO_ID else doc, ids.astype(np.uint32)


# --- encoding --------------------------------------------------------------


@lru_cache(maxsize=1)
def _loaded(vocabulary: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    return Encoder(Tokenizer.from_str(vocabulary))


# Lower-case ASCII without the apostrophe of "it's" and the beginning of control strings, and how such words are cut.
_PLAIN = re.compile(rb"(?!.*<\|)[!-&(-@\[-~]+").fullmatch
_PARTS = re.compile(r"[a-z]+|[0-9]|[^a-z0-9]+").findall
# A word that ends in marks after a letter: the splitter always cuts there.
_MARKED = re.compile(rb"(?!.*<\|)(.*[a-z])([!-&(-/:-@\[-`{-~]+)", re.DOTALL).fullmatch


class _Numbers(dict):
    """Words with their numbers; a new word takes the next one."""

    def __missing__(self, word: bytes) -> int:
        n = self[word] = len(self)
        return n


class Encoder:
    """The ids of whole texts; each distinct word between ASCII blanks is encoded once while it is remembered.

    For a vocabulary whose words never go over white space: its splitter
    drops white space, and what it makes of a word depends on the word alone.
    Plain ASCII words, which its normalizer leaves as they are and its splitter
    cuts into letters, single digits and other characters, are cut here and
    go to the tokenizer's model at once; all other words go through the whole tokenizer.
    """

    def __init__(self, tokenizer):
        self.tokenizer = tokenizer
        self.wide = tokenizer.get_vocab_size(with_added_tokens=True) > 1 << 16
        self.number = _Numbers()
        self.ids, self.starts, self.counts, self.seen = (np.zeros(0, t) for t in (np.uint32, np.int64, np.int64, np.int64))

    def _forget(self) -> None:
        """Words seen once since the last time go, and if that is not enough all do."""
        keep = np.flatnonzero(self.seen > 1)
        if len(keep) > REMEMBERED // 2:
            keep = keep[:0]
        words = list(self.number)
        self.number = _Numbers((words[k], n) for n, k in enumerate(keep.tolist()))
        self.starts, self.counts = self.starts[keep], self.counts[keep]
        upto = np.cumsum(self.counts) - self.counts
        self.ids = self.ids[np.repeat(self.starts - upto, self.counts) + np.arange(int(self.counts.sum()))]
        self.starts, self.seen = upto, np.zeros(len(keep), np.int64)

    def _learn(self, words: list[bytes]) -> None:
        """The ids of new words, appended."""
        tokenize = self.tokenizer.model.tokenize
        known = len(self.counts)
        made: list = [None] * len(words)
        others = []
        for k, word in enumerate(words):
            if word.isalpha() and word.isascii():
                made[k] = [t.id for t in tokenize(word.decode())]
                continue
            if (marked := _MARKED(word)) is not None:
                # what is known of the word without the marks
                n = self.number.get(marked[1])
                if n is not None and n < known:
                    stem = self.ids[self.starts[n] : self.starts[n] + self.counts[n]].tolist()
                else:
                    stem = made[n - known] if n is not None and n - known < k else None
                if stem is not None:
                    made[k] = stem + [t.id for t in tokenize(marked[2].decode())]
                    continue
            if _PLAIN(word):
                made[k] = [t.id for part in _PARTS(word.decode()) for t in tokenize(part)]
            else:
                others.append(k)
        groups = [others[at : at + 512] for at in range(0, len(others), 512)]
        texts = [[words[k].decode() for k in group] for group in groups]
        for group, found in zip(groups, self.tokenizer.encode_batch(texts, is_pretokenized=True, add_special_tokens=False)):
            for k in group:
                made[k] = []
            for k, token in zip(found.word_ids, found.ids):
                made[group[k]].append(token)
        counts = np.fromiter(map(len, made), np.int64, len(made))
        starts = len(self.ids) + np.cumsum(counts) - counts
        self.ids = np.concatenate([self.ids, np.fromiter(chain.from_iterable(made), np.uint32, int(counts.sum()))])
        self.starts, self.counts = np.concatenate([self.starts, starts]), np.concatenate([self.counts, counts])
        self.seen = np.concatenate([self.seen, np.zeros(len(words), np.int64)])

    def encode(self, texts: list[bytes], end_id: int) -> tuple[np.ndarray, np.ndarray]:
        """All texts' ids in a row, an end id after each text, and how many each text has."""
        if len(self.number) > REMEMBERED:
            self._forget()
        # letters are lower-cased by the vocabulary anyway, but not within its control strings
        split = [(t if b"<|" in t else t.lower()).split() for t in texts]
        sizes = np.fromiter(map(len, split), np.int64, len(split))
        known = len(self.number)
        at = np.fromiter(map(self.number.__getitem__, chain.from_iterable(split)), np.int64, int(sizes.sum()))
        if len(self.number) > known:
            self._learn(list(islice(self.number, known, None)))
        self.seen += np.bincount(at, minlength=len(self.seen))
        per_word = self.counts[at]
        upto = np.concatenate([[0], np.cumsum(per_word)])
        bounds = np.concatenate([[0], np.cumsum(sizes)])
        ends = upto[bounds[1:]]
        flat = self.ids[np.repeat(self.starts[at] - upto[:-1], per_word) + np.arange(upto[-1])]
        return np.insert(flat, ends, end_id), np.diff(ends, prepend=0) + 1


# --- files -------------------------------------------------------------------


def default_vocabulary() -> str:
    from public_tokenizers import path

    return path("word_bpe_49k.json")


def write_records(docs: DataFrame, path: str, vocabulary: str | None = None, end_id: int = END_ID) -> None:
    """The ids of each row's whole text, an end id after them, in files below ``path``.

    Files of up to FILE_CHUNKS chunks hold the rows in ascending order of doc_id, a
    null id first, rows of one id by a hash of their texts; many rows of one
    id are dealt out like others. A null or empty text is its end id alone; an
    empty table leaves a folder without records. Other columns are not read.
    A text longer than a chunk is a chunk, so a file grows with its longest text.
    """
    text = open(vocabulary or default_vocabulary(), encoding="utf-8").read()
    schema = arrow_schema("chunk binary")

    def encode(batches):
        encoder = _loaded(text)
        ids, texts, size = [], [], 0

        def chunk():
            tokens, counts = encoder.encode(texts, end_id)
            return batch(schema, chunk=[frames(ids, tokens, counts, encoder.wide)])

        for b in batches:
            for doc, value in zip(b.column(0), b.column(1)):
                ids.append(doc.as_py())
                texts.append(value.as_py())
                size += len(texts[-1]) + 32
                if size >= CHUNK_BYTES:
                    yield chunk()
                    ids, texts, size = [], [], 0
        if ids:
            yield chunk()

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), utf8().alias("text"))
    rows = rows.select("*", F.xxhash64("text").alias("hash"), F.monotonically_increasing_id().alias("row"))
    rows = rows.repartitionByRange("doc_id", "hash", "row").sortWithinPartitions("doc_id", "hash", "row")
    chunks = rows.select("doc_id", "text").mapInArrow(encode, "chunk binary")
    (
        chunks.select(F.col("chunk").cast("string"))
        .write.option("encoding", "ISO-8859-1")
        .option("lineSep", empty_frame().decode("ISO-8859-1"))
        .option("maxRecordsPerFile", FILE_CHUNKS)
        .text(f"{path}/records")
    )


def _files(spark: SparkSession, path: str) -> DataFrame:
    read = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(f"{path}/records")
    return read.select(F.element_at(F.split("path", "/"), -1).alias("file"), "content")


def write_index(spark: SparkSession, path: str) -> DataFrame:
    """The records found in the files, as a table below ``path``, and read from there.

    A row a record: file, offset and length of its frame, doc_id, n_tokens,
    ids_crc32 (of the ids as 32-bit integers) and start, the number of ids in all records before it.
    A damaged frame raises.
    """
    schema = arrow_schema(_INDEX)

    def read(batches):
        for b in batches:
            for name, content in zip(b.column(0), b.column(1)):
                name, content = name.as_py(), content.as_py()
                offsets, sizes = scan(content, name)
                found = [payload(content, at) for at in offsets.tolist()]
                counts = np.array([len(ids) for _, ids in found], np.int64)
                yield batch(
                    schema,
                    file=[name] * len(found),
                    offset=offsets,
                    length=sizes + 16,
                    doc_id=[doc for doc, _ in found],
                    n_tokens=counts,
                    ids_crc32=[zlib.crc32(ids.astype("<u4", copy=False)) for _, ids in found],
                    start=np.cumsum(counts) - counts,
                )

    inside = _files(spark, path).mapInArrow(read, _INDEX)
    inside.write.parquet(f"{path}/offsets")
    inside = spark.read.schema(_INDEX).parquet(f"{path}/offsets")
    # a row a file: files are ordered by the task that wrote them, then by their number in it
    number = lambda group: F.regexp_extract("file", r"^part-(\d+)-.*-c(\d+)\.", group).cast("long")
    files = inside.groupBy("file").agg(F.sum("n_tokens").alias("n"))
    before = Window.orderBy(number(1), number(2)).rowsBetween(Window.unboundedPreceding, -1)
    files = files.select("file", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    index = inside.join(files, "file").withColumn("start", F.col("start") + F.col("before")).drop("before")
    index.write.parquet(f"{path}/index")
    return spark.read.parquet(f"{path}/index")


def read_records(spark: SparkSession, path: str, wanted: DataFrame) -> DataFrame:
    """(position, doc_id, ids) of the records that rows (file, offset, position) name, in any order.

    Each file with such records is read once; a record's checksum is tested where it is read.
    """
    out = "position long, doc_id long, ids array<long>"
    schema = arrow_schema(out)

    def read(batches):
        for b in batches:
            for name, content, asked in zip(b.column(1), b.column(2), b.column(3)):
                content = content.as_py()
                rows = []
                for at, position in ((a["offset"], a["position"]) for a in asked.as_py()):
                    size = struct.unpack_from("<Q", content, at)[0]
                    scan(content[at : at + size + 16], f"{name}+{at}")
                    rows.append((position, *payload(content, at)))
                positions, ids, tokens = zip(*rows)
                yield batch(schema, position=positions, doc_id=ids, ids=pa.array([t.astype(np.int64) for t in tokens], pa.list_(pa.int64())))

    asked = wanted.groupBy("file").agg(F.collect_list(F.struct("offset", "position")).alias("asked"))
    found = _files(spark, path).join(asked, "file").select("file", "file", "content", "asked")
    return found.toDF("name", "file", "content", "asked").mapInArrow(read, out)


def shuffled_records(spark: SparkSession, path: str, seed: int) -> DataFrame:
    """(position, doc_id, ids) of all records in an order that the seed alone decides."""
    index = spark.read.parquet(f"{path}/index")
    drawn = index.select("file", "offset", F.xxhash64(F.lit(seed), "doc_id", "start").alias("position"))
    return read_records(spark, path, drawn).orderBy("position")


def token_records(docs: DataFrame, path: str, vocabulary: str | None = None, end_id: int = END_ID) -> DataFrame:
    """Records and index of all rows written below ``path``; the index, as read back."""
    write_records(docs, path, vocabulary, end_id)
    return write_index(docs.sparkSession, path)
