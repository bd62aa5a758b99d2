from collections import Counter
from types import SimpleNamespace

import pyarrow as pa
import pytest

from celloom.llm import sentencepiece
from celloom.llm.sentencepiece import FIRST_BYTE, VOCABULARY, cuts, decode, encoded, pieces, round_trip, words_of
from tests.llm.helpers import documents


@pytest.fixture(scope="module")
def vocabulary():
    return pieces()


@pytest.fixture(scope="module")
def library(vocabulary):
    """The library itself, its model turned to a unigram one with the same scores."""
    import sentencepiece
    from sentencepiece import sentencepiece_model_pb2 as pb

    model = pb.ModelProto()
    with open(VOCABULARY, "rb") as file:
        model.ParseFromString(file.read())
    model.trainer_spec.model_type = 1
    for i, piece in enumerate(model.pieces):
        if vocabulary.texts[i] is not None:
            piece.score, piece.type = vocabulary.scores[i], 1
        elif piece.type not in (2, 3, 6):
            piece.type = 5
    return sentencepiece.SentencePieceProcessor(model_proto=model.SerializeToString())


def test_no_piece_crosses_a_word(vocabulary):
    assert not any(c in t for t in vocabulary.texts if t for c in "\n\t")
    assert not any(" " in t[1:] for t in vocabulary.texts if t)
    assert vocabulary.raw[FIRST_BYTE + 0xE2] == b"\xe2"


@pytest.mark.parametrize("frequent", [1_000_000, 40])
def test_round_trip_and_best_paths(spark, vocabulary, library, frequent):
    """With all words in the broadcast table, and with most of them joined."""
    docs = documents(spark)
    texts = {}
    for r in docs.collect():
        texts.setdefault(r.doc_id, []).append(r.text)
    found = encoded(docs, frequent=frequent, runs=False).collect()
    assert len(found) == sum(map(len, texts.values()))
    for r in found:
        text = bytes(r.decoded).decode()
        assert text in [t or "" for t in texts[r.doc_id]] and r.n_ids == len(r.ids)
        assert decode(r.ids, vocabulary.raw) == text.encode()
        if "▁" in text or any(len(w) > 200 for w in text.split()):
            continue  # the library takes the mark for a space; words are cut here
        want = library.encode(text)
        cost = lambda ids: sum(vocabulary.scores[i] for i in ids)
        assert list(r.ids) == want or abs(cost(r.ids) - cost(want)) < 1e-3


@pytest.fixture(scope="module")
def whole_library():
    """The library with all of the model's pieces, none marked as unused, and the same scores."""
    import sentencepiece
    from sentencepiece import sentencepiece_model_pb2 as pb

    model = pb.ModelProto()
    with open(VOCABULARY, "rb") as file:
        model.ParseFromString(file.read())
    model.trainer_spec.model_type = 1
    scores = pieces(runs=True).scores
    for i, piece in enumerate(model.pieces):
        if piece.type not in (2, 3, 6):
            piece.score = scores[i]
    return sentencepiece.SentencePieceProcessor(model_proto=model.SerializeToString())


def test_the_vocabulary_is_whole(whole_library):
    vocabulary = pieces(runs=True)
    for i in range(whole_library.get_piece_size()):
        special = whole_library.is_control(i) or whole_library.is_byte(i) or whole_library.is_unknown(i)
        assert vocabulary.texts[i] == (None if special else whole_library.id_to_piece(i).replace("▁", " "))


@pytest.mark.parametrize("frequent", [1_000_000, 0])
def test_runs_of_spaces_and_long_words(spark, whole_library, frequent):
    """Paths go through runs of spaces and over any length of word, as the library's with all pieces do."""
    import random

    rng = random.Random(5)
    signs = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789+/"
    texts = [
        "def f(x):\n" + " " * 15 + "return x\n" + " " * 16 + "\n\t  y  =  1   \n",
        "a" + "".join(" " * k + "b" for k in range(1, 40)),
        "  leading", "trailing  ", " " * 300, " " * 700 + "word" + " " * 700, "\t \t  \t",
        "".join(rng.choice(signs) for _ in range(5000)),
        "so " + "international" * 60 + " it is",
        "".join(rng.choice("的一是不了人我在有他这中大来上國漢字😀é\u0301ñ") for _ in range(900)),
        "x" * 900, "=" * 257 + " " + "-" * 1024 + "\n" + "ab" * 128,
    ]
    vocabulary = pieces(runs=True)
    found = {r.doc_id: r for r in encoded(documents(spark, list(enumerate(texts))), frequent=frequent, runs=True).collect()}
    cost = lambda ids: sum(vocabulary.scores[i] for i in ids)
    for i, text in enumerate(texts):
        want = whole_library.encode(text)
        assert bytes(found[i].decoded).decode() == text
        assert list(found[i].ids) == want or abs(cost(found[i].ids) - cost(want)) < 1e-3 * len(want), text[:40]
    assert 359 in found[0].ids and 259 in found[2].ids


def test_round_trip_uses_all_pieces(spark):
    row = round_trip(documents(spark, [(1, "a" + " " * 16 + "\nb")])).first()
    assert 359 in row.ids


def test_digests(spark):
    import hashlib

    for r in round_trip(documents(spark, [(1, "some words\n"), (2, None)])).collect():
        text = "some words\n" if r.doc_id == 1 else ""
        assert r.decoded_sha256 == hashlib.sha256(text.encode()).hexdigest()
        assert r.ids_sha256 == hashlib.sha256(",".join(map(str, r.ids)).encode()).hexdigest()


def test_empty_table(spark):
    assert encoded(documents(spark, [])).collect() == []


def test_ends_of_words_are_cut_off():
    """Single characters at a word's end that meet in no piece are words; what a piece can go over is not cut."""
    texts = [b"word, word.\tword  word", b"", "漢字, a!! it's".encode()]
    found = words_of(texts, cuts(pieces(runs=True)))
    got = [found.data[a:b].decode() for a, b in zip(found.starts, found.ends)]
    assert "".join(got) == " word, word.\tword  word 漢字, a!! it's"
    assert got[:7] == [" word", ",", " word", ".", "\t", "word", "  word"] and got[-4:] == [" a!!", " it", "'", "s"]
    assert found.firsts.tolist()[:3] == [0, 7, 7] and found.firsts[-1] == len(got)


@pytest.mark.parametrize("held", [4, 1 << 18])
def test_a_task_counts_its_words(monkeypatch, held):
    """A word comes once for each time that the task's words are given out, not once for each text."""
    monkeypatch.setattr(sentencepiece, "HELD_WORDS", held)
    monkeypatch.setattr(sentencepiece, "SLICE_BYTES", 64)
    texts = [b"one word, two words, one word" for _ in range(50)] + [f"text number{i}".encode() for i in range(20)]
    batches = [pa.record_batch({"bytes": pa.array(texts[k : k + 7], pa.binary())}) for k in range(0, len(texts), 7)]
    cut, rows = cuts(pieces(runs=True)), []
    for b in sentencepiece._counted(SimpleNamespace(value=cut))(iter(batches)):
        rows += zip(b.column("word").to_pylist(), b.column("n").to_pylist())
    total = Counter()
    for word, n in rows:
        total[word] += n
    found = words_of(texts, cut)
    assert total == Counter(found.data[a:b].decode() for a, b in zip(found.starts, found.ends))
    assert held == 4 or len(rows) == len(total)
