"""Binary token records: round trips, damage, offsets and order."""

import glob
import os
import zlib

import numpy as np
import pytest
from public_tokenizers import path as vocabulary_path
from tokenizers import Tokenizer

from celloom.llm import records
from celloom.llm.crc32c import crc32c, masked
from celloom.llm.queries import QUERIES
from celloom.llm.records import (
    Damaged,
    Encoder,
    empty_frame,
    frames,
    payload,
    read_records,
    scan,
    shuffled_records,
    token_records,
)
from tests.llm.helpers import collected, documents, texts


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(vocabulary_path("word_bpe_49k.json"))


def plain(tokenizer, rows):
    """(doc_id, start, n_tokens, ids_crc32) with the library's ids of whole texts."""
    ids = [e.ids + [1] for e in tokenizer.encode_batch([t or "" for _, t in rows], add_special_tokens=False)]
    order = sorted(range(len(rows)), key=lambda k: (rows[k][0] is not None, rows[k][0] or 0))
    out, start = [], 0
    for k in order:
        out.append((rows[k][0], start, len(ids[k]), zlib.crc32(np.array(ids[k], "<u4").tobytes())))
        start += len(ids[k])
    return out


def bitwise(data: bytes) -> int:
    crc = 0xFFFFFFFF
    for byte in data:
        crc ^= byte
        for _ in range(8):
            crc = crc >> 1 ^ (0x82F63B78 if crc & 1 else 0)
    return crc ^ 0xFFFFFFFF


def test_checksums_equal_the_bitwise_form():
    assert bitwise(b"123456789") == 0xE3069283
    rng = np.random.default_rng(3)
    words = rng.integers(0, 1 << 32, 700, dtype=np.uint32)
    starts = np.array([0, 5, 9, 100, 3, 250])
    lengths = np.array([1, 63, 64, 65, 128, 400])
    got = crc32c(words, starts, lengths)
    assert got.tolist() == [bitwise(words[a : a + n].tobytes()) for a, n in zip(starts, lengths)]
    one = bitwise(words[:1].tobytes())
    assert masked(got)[0] == ((one >> 15 | one << 17) + 0xA282EAD8) & 0xFFFFFFFF


@pytest.mark.parametrize("wide", [False, True])
def test_frames_come_back(wide):
    rng = np.random.default_rng(1)
    doc_ids = [None, -5, 0, 1 << 62, -(1 << 63), 7]
    counts = np.array([0, 1, 2, 3, 1000, 5])
    ids = rng.integers(0, 1 << (20 if wide else 16), counts.sum(), dtype=np.uint32)
    content = empty_frame() + frames(doc_ids, ids, counts, wide) + empty_frame()
    offsets, sizes = scan(content)
    found = [payload(content, at) for at in offsets.tolist()]
    assert [d for d, _ in found] == doc_ids
    assert np.concatenate([i for _, i in found]).tolist() == ids.tolist()
    assert [len(i) for _, i in found] == counts.tolist()
    for k in range(0, len(content), 3):
        hurt = bytearray(content)
        hurt[k] ^= 0x10
        with pytest.raises(Damaged):
            scan(bytes(hurt))
    with pytest.raises(Damaged):
        scan(content[:-4])


def test_words_alone_give_the_ids_of_whole_texts(tokenizer):
    odd = [
        "á ́b \xa0 x\xa0y　z \x85 \x1c\x1d\x1e\x1f w", "don't CAN'T it's 'S ''ll", "<|endoftext|>x <|startoftext|><|endoftext|> <|end",
        "ΑΣ ΣΑΣ İstanbul ﬁ Å Å", "1234 5 67a8 ½ ²", "​‍ ﻿ 👩‍👩‍👧 漢字かな", "\x00 \x7f \x0b\x0c", "!!! ... --- a!b?c", "end. end, end... (end) it's. its' 'x' <|endoftext|>. a<|startoftext|>, é. é, 7. 7a! a7!", "़ क़ ाि",
    ]
    many = odd + [t or "" for t in texts(6, 80)]
    encoder = Encoder(tokenizer)
    for part in (many, many[::-1], []):
        ids, counts = encoder.encode([t.encode() for t in part], 1)
        want = [e.ids + [1] for e in tokenizer.encode_batch(part, add_special_tokens=False)]
        assert counts.tolist() == [len(w) for w in want]
        assert ids.tolist() == [i for w in want for i in w]


def test_words_are_forgotten(tokenizer, monkeypatch):
    monkeypatch.setattr(records, "REMEMBERED", 20)
    encoder = Encoder(tokenizer)
    for t in texts(2, 30):
        ids, _ = encoder.encode([(t or "").encode()], 1)
        assert ids.tolist() == tokenizer.encode(t or "", add_special_tokens=False).ids + [1]
        assert len(encoder.number) <= 40 + len((t or "").split())


ROW = ("doc_id", "start", "n_tokens", "ids_crc32")


def test_equals_whole_texts(spark, folder, tokenizer, monkeypatch):
    monkeypatch.setattr(records, "CHUNK_BYTES", 3000)
    monkeypatch.setattr(records, "FILE_CHUNKS", 2)
    rows = [(7 * i % 101 - 30, t) for i, t in enumerate(texts(4, 80))] + [(None, "no id"), (1 << 62, "last")]
    got = collected(token_records(documents(spark, rows), folder), *ROW)
    assert got == sorted(plain(tokenizer, rows), key=repr)
    assert len(glob.glob(f"{folder}/records/part-*")) > 3


def test_many_rows_of_one_id(spark, folder, tokenizer, monkeypatch):
    monkeypatch.setattr(records, "CHUNK_BYTES", 2000)
    monkeypatch.setattr(records, "FILE_CHUNKS", 1)
    rows = [(5, f"text {i % 7} of five") for i in range(400)] + [(i, "x y") for i in range(10)] + [(None, None)] * 3
    index = token_records(documents(spark, rows), folder).orderBy("start").collect()
    assert [r["doc_id"] for r in index] == sorted((i for i, _ in rows), key=lambda i: (i is not None, i or 0))
    assert sum(r["n_tokens"] for r in index) == sum(r[2] for r in plain(tokenizer, rows))
    at = 0
    for r in index:
        assert r["start"] == at
        at += r["n_tokens"]
    assert len({r["file"] for r in index if r["doc_id"] == 5}) > 1


def test_shuffled_reads_by_the_index(spark, folder, tokenizer):
    rows = [(i, t) for i, t in enumerate(texts(5, 50))]
    index = token_records(documents(spark, rows), folder)
    want = {i: e.ids + [1] for (i, _), e in zip(rows, tokenizer.encode_batch([t or "" for _, t in rows], add_special_tokens=False))}
    first = [(r["doc_id"], list(r["ids"])) for r in shuffled_records(spark, folder, 1).collect()]
    again = [(r["doc_id"], list(r["ids"])) for r in shuffled_records(spark, folder, 1).collect()]
    other = [r["doc_id"] for r in shuffled_records(spark, folder, 2).collect()]
    assert dict(first) == want and len(first) == len(rows)
    assert first == again and [i for i, _ in first] != other and [i for i, _ in first] != sorted(want)
    some = index.where("doc_id in (3, 11)").selectExpr("file", "offset", "doc_id as position")
    assert sorted((r["position"], list(r["ids"])) for r in read_records(spark, folder, some).collect()) == [(3, want[3]), (11, want[11])]


def test_damaged_files_are_refused(spark, folder):
    token_records(documents(spark, [(i, f"text {i}") for i in range(20)]), folder)
    name = max(glob.glob(f"{folder}/records/part-*"), key=os.path.getsize)
    content = bytearray(open(name, "rb").read())
    content[40] ^= 1
    open(name, "wb").write(content)
    with pytest.raises(Exception, match="checksum|sound length"):
        scan(bytes(content))


def test_empty_table_and_odd_columns(spark, tmp_path):
    assert token_records(documents(spark).limit(0), f"{tmp_path}/a").collect() == []
    docs = documents(spark)
    assert token_records(docs, f"{tmp_path}/b").count() == docs.count()


def test_query_equals_whole_texts(spark, data, tokenizer):
    rows = [tuple(r) for r in spark.read.parquet(f"{data}/documents.parquet").select("doc_id", "text").collect()]
    assert collected(QUERIES["op13_token_records"](spark, data), *ROW) == sorted(plain(tokenizer, rows), key=repr)
