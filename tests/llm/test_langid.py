import math
import random
import zlib

import numpy as np

from celloom.llm import langid
from celloom.llm.langid import (
    BYTE,
    VOCABULARY,
    Model,
    _raw_hash,
    fit,
    forward,
    forward_long,
    has_letter,
    language_id,
    training_texts,
    vocabulary,
)
from tests.llm.helpers import documents


def _prose(rng, lang):
    stock = {"en": ["the", "and", "with", "tion", "house"], "de": ["der", "und", "nicht", "schaft", "haus"]}[lang]
    return " ".join(rng.choice(stock) + rng.choice(["", rng.choice(stock)]) for _ in range(30)) + "."


def test_tells_languages(spark):
    rng = random.Random(6)
    rows = [(i, _prose(rng, "en" if i % 2 else "de")) for i in range(120)]
    odd = [(500, None), (501, ""), (502, "12 + 3 = 15 ²"), (None, "the house"), (503, "the " * 5000), (504, "x" * 3000), rows[3]]
    docs = documents(spark, rows + odd).drop("lang")
    docs = docs.selectExpr("*", "CASE WHEN doc_id >= 500 THEN null WHEN doc_id % 2 = 1 THEN 'en' ELSE 'de' END AS lang")
    found = language_id(docs).collect()
    assert len(found) == len(rows) + len(odd)
    by_id = {r.doc_id: r for r in found}
    assert all(by_id[i].lang_pred == ("en" if i % 2 else "de") and by_id[i].score > 0.5 for i, _ in rows)
    assert all(by_id[i].held_out == (zlib.crc32(str(i).encode()) % 5 == 0) for i, _ in rows)
    assert [(by_id[i].lang_pred, by_id[i].score) for i in (500, 501, 502)] == [("und", 0.0)] * 3
    assert (by_id[None].lang_pred, by_id[None].held_out, by_id[503].lang_pred) == ("en", True, "en")
    assert all(0 <= r.score <= 1 for r in found)


def test_forward_sums_all_segmentations():
    pieces = {b" a": 0.2, b"a": 0.3, b"b": 0.25, b"ab": 0.15, b"bab": 0.1}
    order = sorted(pieces, key=lambda p: int(_raw_hash(np.frombuffer(p, np.uint8))))
    hashes = np.array([_raw_hash(np.frombuffer(p, np.uint8)) for p in order], np.uint64)
    model = Model(["x"], hashes, np.array([[pieces[p]] for p in order]), 3)

    def total(word):
        if not word:
            return 1.0
        ways = sum(p * total(word[len(w) :]) for w, p in pieces.items() if word.startswith(w))
        return ways + BYTE * total(word[1:])

    for word in (b" abab", b" babba", b" zab"):
        got = forward(np.frombuffer(word, np.uint8)[None, :], model)
        assert math.isclose(got[0, 0], math.log(total(word)))


def test_letters():
    assert [has_letter(t) for t in (None, "", "²½ 12_", "1a", "漢", "́")] == [False, False, False, True, True, False]


def test_nothing_to_learn(spark):
    found = language_id(documents(spark, [(1, "some words"), (2, None)]).selectExpr("doc_id", "text", "cast(null as string) AS lang")).collect()
    assert {(r.lang_pred, r.score) for r in found} == {("und", 0.0)}
    assert language_id(documents(spark, [])).collect() == []


def _model(pieces, langs=1):
    order = sorted(pieces, key=lambda p: int(_raw_hash(np.frombuffer(p, np.uint8))))
    hashes = np.array([_raw_hash(np.frombuffer(p, np.uint8)) for p in order], np.uint64)
    table = np.array([[pieces[p] * (1 + k) for k in range(langs)] for p in order])
    return Model([str(k) for k in range(langs)], hashes, table, max(map(len, pieces))), order


def plain_log(word, pieces, factor=1.0):
    """The log probability of all segmentations, place by place, in logs."""
    logs = [0.0]
    for end in range(1, len(word) + 1):
        terms = []
        for start in range(end):
            p = factor * pieces.get(word[start:end], 0.0) + (BYTE if start == end - 1 else 0.0)
            if p:
                terms.append(logs[start] + math.log(p))
        top = max(terms)
        logs.append(top + math.log(sum(math.exp(t - top) for t in terms)))
    return logs[-1]


def test_long_words_equal_the_plain_sum(monkeypatch):
    pieces = {b" a": 0.1, b"a": 0.2, b"b": 0.15, b"ab": 0.1, b"bab": 0.05, "\u00e9".encode(): 0.02, b"abababababab": 0.03, b" telling": 0.01}
    model, _ = _model(pieces, langs=2)
    rng = random.Random(5)
    words = [b" " + "".join(rng.choice("aabbz\u00e9") for _ in range(n)).encode() for n in (1, 39, 40, 41, 127, 128, 129, 300, 700)]
    words += [b" telling" * 40, b" " + b"ab" * 300]
    for block in (16, 128):
        monkeypatch.setattr(langid, "BLOCK", block)
        got = forward_long(words, model)
        for word, logs in zip(words, got):
            want = [plain_log(word, pieces, 1 + k) for k in range(2)]
            assert np.allclose(logs, want, rtol=1e-9), word
            assert np.allclose(forward(np.frombuffer(word, np.uint8)[None, :], model)[0], want, rtol=1e-9)


def test_all_letter_pieces_of_the_vocabulary_are_used():
    hashes, longest = vocabulary(VOCABULARY)
    assert longest > 8 and len(hashes) > 22_000
    for piece in (" después", " conseguenza", "istoire", " également"):
        raw = piece.encode()
        if len(raw) > 8 and _raw_hash(np.frombuffer(raw, np.uint8)) in hashes:
            return
    raise AssertionError("no long piece found")


def test_fit_equals_the_plain_expectation():
    names = [b" a", b"a", b"b", b"ab", b"bab", b" "]
    model, order = _model({p: 1.0 for p in names})
    counts = {b" abab": 3.0, b" babb": 2.0, b" zaba": 1.0}
    words = [np.frombuffer(b"".join(counts), np.uint8).reshape(3, 5)]
    got = fit(words, [np.array(list(counts.values()))], model.hashes, model.longest)

    def ways(word):
        """Every segmentation as a list of pieces, None for a byte that is none."""
        if not word:
            yield []
            return
        for end in range(1, len(word) + 1):
            if word[:end] in order:
                yield from ([word[:end], *w] for w in ways(word[end:]))
        yield from ([None, *w] for w in ways(word[1:]))

    expected = {p: sum(n * sum(w[i : i + len(p)] == p for i in range(len(w))) for w, n in counts.items()) for p in order}
    for _ in range(langid.ROUNDS):
        total = sum(expected.values()) + langid.SMOOTH * len(order)
        p = {q: (expected[q] + langid.SMOOTH) / total for q in order}
        expected = dict.fromkeys(order, 0.0)
        for word, n in counts.items():
            found = [(w, math.prod(p.get(q, BYTE) if q else BYTE for q in w)) for w in ways(word)]
            whole = sum(value for _, value in found)
            for w, value in found:
                for q in w:
                    if q:
                        expected[q] += n * value / whole
    total = sum(expected.values()) + langid.SMOOTH * len(order)
    assert np.allclose(got, [(expected[q] + langid.SMOOTH) / total for q in order], rtol=1e-6)


def test_scripts_without_spaces_and_very_long_words(spark):
    rng = random.Random(2)
    han = {"zh": "\u4e00\u7684\u662f\u4e0d\u4e86", "ja": "\u306e\u306b\u306f\u3092\u305f"}
    rows = [(i, "".join(rng.choice(han["zh" if i % 2 else "ja"]) for _ in range(200))) for i in range(80)]
    rows += [(900, "".join(rng.choice(han["zh"]) for _ in range(40_000))), (901, "".join(rng.choice(han["ja"]) for _ in range(3000)) + "x")]
    docs = documents(spark, rows).drop("lang")
    docs = docs.selectExpr("*", "CASE WHEN doc_id >= 900 THEN null WHEN doc_id % 2 = 1 THEN 'zh' ELSE 'ja' END AS lang")
    by_id = {r.doc_id: r for r in language_id(docs).collect()}
    assert all(by_id[i].lang_pred == ("zh" if i % 2 else "ja") for i in range(80))
    assert (by_id[900].lang_pred, by_id[901].lang_pred) == ("zh", "ja")
    assert not any(math.isnan(r.score) for r in by_id.values())


def test_rows_of_one_id_are_one_text(spark):
    docs = documents(spark, [(1, f"text {k}") for k in range(2000)] + [(k, "other") for k in (2, 3, 4, 6)]).drop("lang")
    sample = training_texts(docs.selectExpr("*", "'en' AS lang"), 3).collect()
    assert len(sample) == 3 and len({r.doc_id for r in sample}) == 3
