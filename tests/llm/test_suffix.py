import hashlib

import numpy as np

from celloom.llm.suffix import _refine, anchors, repeated_passages, spans_of
from tests.llm.helpers import collected, documents


def plain(rows, length=50):
    least = {}
    data = [(i, (t or "").encode()) for i, t in rows]
    for i, b in data:
        if i is not None:
            for p in range(len(b) - length + 1):
                s = b[p : p + length]
                least[s] = min(i, least.get(s, i))
    out = []
    for i, b in data:
        gone = bytearray(len(b))
        for p in range(len(b) - length + 1):
            if i is not None and least[b[p : p + length]] < i:
                gone[p : p + length] = b"\1" * length
        kept = bytes(c for c, g in zip(b, gone) if not g)
        spans = sum(1 for k, g in enumerate(gone) if g and (k == 0 or not gone[k - 1]))
        out.append((i, len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return out


COLUMNS = ("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


def test_equals_all_strings(spark):
    docs = documents(spark)
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    want = sorted(plain(rows), key=repr)
    assert sum(w[2] for w in want) > 1000
    assert collected(repeated_passages(docs), *COLUMNS) == want


def test_a_passage_in_most_documents(spark):
    """Each with its own surroundings, so that one gram has many contexts in one task."""
    passage = "the same passage of more than fifty bytes stands here again "
    rows = [(100 - i, f"{i * 7919} {'ab' * (i % 9)} {passage}{i * 104729} {'cd' * (i % 11)}") for i in range(80)]
    docs = documents(spark, rows)
    assert collected(repeated_passages(docs), *COLUMNS) == sorted(plain(rows), key=repr)


def test_empty_table(spark):
    assert repeated_passages(documents(spark, [])).collect() == []


def test_every_string_has_one_anchor():
    rng = np.random.default_rng(2)
    text = rng.integers(97, 100, 5000).astype(np.uint8).tobytes()
    found = [(first, last) for _, _, _, _, first, last in anchors(text)]
    first, last = (np.concatenate(x) for x in zip(*found))
    assert first[0] == 0 and last[-1] == len(text) - 50
    assert (first[1:] == last[:-1] + 1).all()
    assert list(anchors(b"x" * 49)) == []


def test_spans():
    starts, ends = np.array([0, 3, 10, 15, 30]), np.array([5, 8, 15, 18, 31])
    assert spans_of(starts, ends).tolist() == [[0, 8], [10, 18], [30, 31]]
    assert callable(_refine)
