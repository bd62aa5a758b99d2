"""Repeated passages by anchors (winnowing) and hashes of strings.

A byte goes if a string of 50 bytes covers it that also starts in a document
with a smaller doc_id. This is not bucket-pointer refinement: no bucket is
sorted by the bucket identifiers of later offsets, and no identifiers are
updated and used again. Positions are put into buckets by a short gram, and only
buckets of several documents are opened, in two fixed levels, by hashes of
longer strings. The hash of a string of any length comes from the same running
sums of its text.

Level 0 takes 24-byte grams, not at every position but at anchors: of the 27
grams in a 50-byte string the one with the least hash. Equal strings have equal
anchors, so nothing is lost and one position in 14 is sorted.
Level 1 refines a bucket by the context of the anchor: all bytes of the 50-byte
strings that have this anchor. If a smaller document has the same context, all
these strings go. Else, if the bucket has other contexts, the least document of
each context goes to
Level 2, where its 50-byte strings are sorted themselves.

Equal entries of a task become one before they are dealt out, and what a task
sees repeated is decided there, so a passage that a third of all documents hold
costs one entry a task, not one a document.

Identifiers are 64-bit hashes (an anchor's gram is compared by at least 40 bits
and its context by 48 more).
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, functions as F

from celloom.llm.common import arrow_schema, batch, landed, utf8
from celloom.llm.hashing import mix, range_hashes, running

LENGTH = 50
GRAM = 24
#: Strings that a task looks at in one piece of a long text.
BLOCK = 1 << 20
#: Entries that a task gathers before it deals them out, and wanted in a bucket.
FLUSH, IN_BUCKET = 1 << 20, 1 << 20
#: Fewest buckets, so that a document's anchors are spread alike over small and large inputs.
BUCKETS = 64
#: Contexts of one gram in a task, beyond which all go on to level 2.
CONTEXTS = 8

_POSTS = "bucket int, doc_id long, row long, blob binary"
_ACTIONS = "doc_id long, row long, covered binary, opened binary"
_STRINGS = "bucket int, doc_id long, row long, blob binary"
_SPANS = "doc_id long, row long, spans binary"
_RESULT = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, spans binary"


def _cut(values: np.ndarray, width: int) -> np.ndarray:
    """The low bytes of 64-bit values."""
    return np.ascontiguousarray(values).view(np.uint8).reshape(-1, 8)[:, :width]


def _joined(raw: np.ndarray, width: int) -> np.ndarray:
    whole = np.zeros((len(raw) // width, 8), np.uint8)
    whole[:, :width] = raw.reshape(-1, width)
    return whole.view(np.uint64).ravel()


def _low(values: np.ndarray, width: int) -> np.ndarray:
    return values & np.uint64((1 << (8 * width)) - 1)


def anchors(text: bytes, length: int = LENGTH, gram: int = GRAM) -> Iterator[tuple[int, np.ndarray, ...]]:
    """By pieces of a text: its place, running sums, and of every anchor the gram's hash, the
    context's hash, and the first and last start of the strings that have this anchor."""
    strings = len(text) - length + 1
    width = length - gram + 1
    low = np.uint64((1 << 24) - 1)
    for at in range(0, max(strings, 0), BLOCK):
        data = np.frombuffer(text, np.uint8, min(strings - at, BLOCK) + length - 1, at)
        sums = running(data)
        starts = np.arange(len(data) - gram + 1)
        grams = range_hashes(sums, starts, starts + gram)
        # the least hash of each string's grams, the first of equal ones
        least = (grams & ~low) | starts.astype(np.uint64)
        reach = 1
        while reach * 2 <= width:
            least = np.minimum(least[:-reach], least[reach:])
            reach *= 2
        if reach < width:
            least = np.minimum(least[: len(least) - (width - reach)], least[width - reach :])
        place = (least & low).astype(np.int64)
        first = np.flatnonzero(np.r_[True, place[1:] != place[:-1]])
        last = np.r_[first[1:], len(place)] - 1
        place = place[first]
        context = range_hashes(sums, first, last + length) ^ (place - first).astype(np.uint64)
        # hashes of anchors are small ones: mixed again, they fill all buckets alike
        yield at, sums, mix(grams[place]), _low(context, 6), first, last


def _buckets_of(values: np.ndarray, buckets: int) -> np.ndarray:
    return ((values >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int32)


def _edges(*keys: np.ndarray) -> np.ndarray:
    """Where sorted keys change; the first too."""
    new = np.ones(len(keys[0]), bool)
    new[1:] = np.any([k[1:] != k[:-1] for k in keys], axis=0)
    return new


def _by_owner(owner: np.ndarray) -> Iterator[tuple[int, slice]]:
    """Stretches of equal owners in a sorted array."""
    cuts = np.flatnonzero(np.r_[_edges(owner), True]) if len(owner) else np.zeros(1, int)
    for s, e in zip(cuts[:-1], cuts[1:]):
        yield int(owner[s]), slice(s, e)


def _pack_owned(ids: np.ndarray, rows: np.ndarray, owner: np.ndarray, *columns: np.ndarray) -> bytes:
    """Entries with their documents: count, ids, rows, entries of each, then the columns' bytes."""
    own, counts = np.unique(owner, return_counts=True)
    order = np.argsort(owner, kind="stable")
    parts = [np.uint32(len(own)).tobytes(), ids[own].tobytes(), rows[own].tobytes(), counts.astype(np.uint32).tobytes()]
    return b"".join(parts + [np.ascontiguousarray(c[order]).tobytes() for c in columns])


def _unpack_owned(blobs: list[bytes], widths: tuple[int, ...]):
    """Ids, rows, owner of each entry, and the columns of all blobs, as raw bytes."""
    ids, rows, owners, columns, base = [], [], [], [[] for _ in widths], 0
    for blob in blobs:
        k = int(np.frombuffer(blob, np.uint32, 1)[0])
        ids.append(np.frombuffer(blob, np.int64, k, 4))
        rows.append(np.frombuffer(blob, np.int64, k, 4 + 8 * k))
        counts = np.frombuffer(blob, np.uint32, k, 4 + 16 * k)
        owners.append(np.repeat(np.arange(base, base + k), counts))
        base += k
        n, at = int(counts.sum()), 4 + 20 * k
        for column, width in zip(columns, widths):
            column.append(np.frombuffer(blob, np.uint8, n * width, at))
            at += n * width
    return np.concatenate(ids), np.concatenate(rows), np.concatenate(owners), [np.concatenate(c) for c in columns]


def _actions(ids: np.ndarray, rows: np.ndarray, covered, opened) -> dict[str, list]:
    """One row for each document with contexts that are covered or opened; both are (owner, contexts)."""
    found: dict[int, list[bytes]] = {}
    for k, (owner, contexts) in enumerate((covered, opened)):
        order = np.argsort(owner, kind="stable")
        owner, contexts = owner[order], contexts[order]
        for own, part in _by_owner(owner):
            found.setdefault(own, [b"", b""])[k] = _cut(contexts[part], 6).tobytes()
    keys = list(found)
    return {
        "doc_id": [int(ids[k]) for k in keys],
        "row": [int(rows[k]) for k in keys],
        "covered": [found[k][0] for k in keys],
        "opened": [found[k][1] for k in keys],
    }


def _post_anchors(buckets: int, length: int, gram: int):
    """Anchors by bucket; buckets below 0 carry what is decided already."""
    schema = arrow_schema(_POSTS)

    def flush(ids, rows, grams, contexts, owner) -> Iterator[pa.RecordBatch]:
        ids, rows = np.array(ids, np.int64), np.array(rows, np.int64)
        grams, contexts = np.concatenate(grams), np.concatenate(contexts)
        owner = np.repeat(np.arange(len(ids)), owner)
        order = np.lexsort((ids[owner], contexts, grams))
        grams, contexts, owner = grams[order], contexts[order], owner[order]
        new_class, new_gram = _edges(grams, contexts), _edges(grams)
        least = ids[owner[np.flatnonzero(new_class)[np.cumsum(new_class) - 1]]]
        covered = ids[owner] > least
        # grams with many contexts here: all are opened, two of the contexts tell the other tasks
        gram_at = np.cumsum(new_gram) - 1
        nth = np.cumsum(new_class)
        nth -= nth[np.flatnonzero(new_gram)[gram_at]]
        crowded = np.bincount(gram_at, weights=new_class)[gram_at] > CONTEXTS
        opened = crowded & ~covered
        sent = ~covered & (~crowded | (new_class & (nth < 2)))
        done = _actions(ids, rows, (owner[covered], contexts[covered]), (owner[opened], contexts[opened]))
        blobs = [np.uint32(len(c)).tobytes() + c + o for c, o in zip(done["covered"], done["opened"])]
        yield batch(schema, bucket=[-1 - r % buckets for r in done["row"]], doc_id=done["doc_id"], row=done["row"], blob=blobs)
        grams, contexts, owner = grams[sent], contexts[sent], owner[sent]
        place = _buckets_of(grams, buckets)
        order = np.argsort(place, kind="stable")
        grams, contexts, owner, place = grams[order], contexts[order], owner[order], place[order]
        keys, blobs = [], []
        for key, part in _by_owner(place):
            keys.append(key)
            blobs.append(_pack_owned(ids, rows, owner[part], _cut(grams[part], 5), _cut(contexts[part], 6)))
        yield batch(schema, bucket=keys, doc_id=[None] * len(keys), row=[None] * len(keys), blob=blobs)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = ([], [], [], [], []), 0
        for b in batches:
            for doc_id, row, text in zip(*(b.column(c).to_pylist() for c in ("doc_id", "row", "bytes"))):
                if doc_id is None:
                    continue
                for _, _, grams, contexts, _, _ in anchors(text, length, gram):
                    for column, value in zip(held, (doc_id, row, grams, contexts, len(grams))):
                        column.append(value)
                    size += len(grams)
                if size >= FLUSH:
                    yield from flush(*held)
                    held, size = ([], [], [], [], []), 0
        if size:
            yield from flush(*held)

    return run


def _refine(table: pa.Table) -> pa.Table:
    """Of a bucket of anchors: contexts that a smaller document has, and contexts to look into."""
    schema = arrow_schema(_ACTIONS)
    if table.column("bucket")[0].as_py() < 0:
        rows = table.to_pylist()
        cut = [4 + int(np.frombuffer(r["blob"], np.uint32, 1)[0]) for r in rows]
        return pa.Table.from_batches(
            [
                batch(
                    schema,
                    doc_id=[r["doc_id"] for r in rows],
                    row=[r["row"] for r in rows],
                    covered=[r["blob"][4:c] for r, c in zip(rows, cut)],
                    opened=[r["blob"][c:] for r, c in zip(rows, cut)],
                )
            ]
        )
    ids, rows, owner, (grams, contexts) = _unpack_owned(table.column("blob").to_pylist(), (5, 6))
    grams, contexts = _joined(grams, 5), _joined(contexts, 6)
    # grams of one document go at once
    order = np.argsort(grams, kind="stable")
    grams, contexts, owner = grams[order], contexts[order], owner[order]
    new = _edges(grams)
    at = np.cumsum(new) - 1
    doc = ids[owner]
    low = np.minimum.reduceat(doc, np.flatnonzero(new))
    high = np.maximum.reduceat(doc, np.flatnonzero(new))
    several = (low < high)[at]
    grams, contexts, owner = grams[several], contexts[several], owner[several]
    order = np.lexsort((ids[owner], contexts, grams))
    grams, contexts, owner = grams[order], contexts[order], owner[order]
    new_class, new_gram = _edges(grams, contexts), _edges(grams)
    if len(grams):
        least = ids[owner[np.flatnonzero(new_class)[np.cumsum(new_class) - 1]]]
        at = np.cumsum(new_gram) - 1
        classes = np.bincount(at, weights=new_class)[at]
    else:
        least, classes = np.zeros(0, np.int64), np.zeros(0)
    covered = ids[owner] > least
    opened = ~covered & (classes > 1)
    return pa.Table.from_batches(
        [batch(schema, **_actions(ids, rows, (owner[covered], contexts[covered]), (owner[opened], contexts[opened])))]
    )


def _apply(buckets: int, length: int, gram: int):
    """What level 1 removes, as spans in buckets below 0, and the strings of opened contexts by bucket."""
    schema = arrow_schema(_STRINGS)

    def flush(ids, rows, hashes, starts, owner) -> Iterator[pa.RecordBatch]:
        ids, rows = np.array(ids, np.int64), np.array(rows, np.int64)
        hashes, starts = np.concatenate(hashes), np.concatenate(starts)
        owner = np.repeat(np.arange(len(ids)), owner)
        order = np.lexsort((ids[owner], hashes))
        hashes, starts, owner = hashes[order], starts[order], owner[order]
        new = _edges(hashes)
        least = ids[owner[np.flatnonzero(new)[np.cumsum(new) - 1]]]
        gone = ids[owner] > least
        yield _spans_found(schema, ids, rows, owner[gone], starts[gone], buckets)
        hashes, starts, owner = hashes[~gone], starts[~gone], owner[~gone]
        place = _buckets_of(hashes, buckets)
        order = np.argsort(place, kind="stable")
        hashes, starts, owner, place = hashes[order], starts[order], owner[order], place[order]
        keys, blobs = [], []
        for key, part in _by_owner(place):
            keys.append(key)
            blobs.append(_pack_owned(ids, rows, owner[part], hashes[part], starts[part].astype(np.uint32)))
        yield batch(schema, bucket=keys, doc_id=[None] * len(keys), row=[None] * len(keys), blob=blobs)

    def _spans_found(schema, ids, rows, owner, starts, buckets):
        order = np.lexsort((starts, owner))
        owner, starts = owner[order], starts[order]
        out = {"bucket": [], "doc_id": [], "row": [], "blob": []}
        for own, part in _by_owner(owner):
            out["bucket"].append(-1 - int(rows[own]) % buckets)
            out["doc_id"].append(int(ids[own]))
            out["row"].append(int(rows[own]))
            out["blob"].append(spans_of(starts[part], starts[part] + length).tobytes())
        return batch(schema, **out)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unzip = zstandard.ZstdDecompressor()
        held, size = ([], [], [], [], []), 0
        for b in batches:
            out = {"bucket": [], "doc_id": [], "row": [], "blob": []}
            for r in b.select(["doc_id", "row", "packed", "covered", "opened"]).to_pylist():
                text = unzip.decompress(r["packed"])
                covered = np.unique(_joined(np.frombuffer(b"".join(r["covered"]), np.uint8), 6))
                opened = np.unique(_joined(np.frombuffer(b"".join(r["opened"]), np.uint8), 6))
                spans = []
                for at, sums, _, contexts, first, last in anchors(text, length, gram):
                    hit = np.isin(contexts, covered)
                    spans.append(np.stack([first[hit] + at, last[hit] + length + at]))
                    look = np.isin(contexts, opened) & ~hit
                    if look.any():
                        lo, hi = first[look], last[look]
                        counts = hi - lo + 1
                        starts = np.repeat(lo - np.r_[0, np.cumsum(counts)[:-1]], counts) + np.arange(counts.sum())
                        for column, value in zip(
                            held, (r["doc_id"], r["row"], range_hashes(sums, starts, starts + length), starts + at, len(starts))
                        ):
                            column.append(value)
                        size += len(starts)
                found = np.concatenate(spans, axis=1) if spans else np.zeros((2, 0), np.int64)
                if found.shape[1]:
                    out["bucket"].append(-1 - r["row"] % buckets)
                    out["doc_id"].append(r["doc_id"])
                    out["row"].append(r["row"])
                    out["blob"].append(spans_of(*found).tobytes())
                if size >= FLUSH:
                    yield from flush(*held)
                    held, size = ([], [], [], [], []), 0
            yield batch(schema, **out)
        if size:
            yield from flush(*held)

    return run


def spans_of(starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The union of ranges sorted by start, as an array of starts and ends; touching ones are one."""
    if not len(starts):
        return np.zeros((0, 2), np.int64)
    reach = np.maximum.accumulate(ends)
    first = np.r_[True, starts[1:] > reach[:-1]]
    return np.stack([starts[first], reach[np.r_[np.flatnonzero(first)[1:] - 1, len(starts) - 1]]], axis=1).astype(np.int64)


def _repeated(length: int):
    """Of a bucket of strings, the spans of those that a smaller document has; spans found before pass."""
    schema = arrow_schema(_SPANS)

    def run(table: pa.Table) -> pa.Table:
        if table.column("bucket")[0].as_py() < 0:
            return table.select(["doc_id", "row", "blob"]).rename_columns(["doc_id", "row", "spans"]).cast(schema)
        ids, rows, owner, (hashes, starts) = _unpack_owned(table.column("blob").to_pylist(), (8, 4))
        hashes, starts = hashes.view(np.uint64), starts.view(np.uint32).astype(np.int64)
        order = np.lexsort((ids[owner], hashes))
        hashes, starts, owner = hashes[order], starts[order], owner[order]
        new = _edges(hashes)
        least = ids[owner[np.flatnonzero(new)[np.cumsum(new) - 1]]]
        gone = ids[owner] > least
        starts, owner = starts[gone], owner[gone]
        order = np.lexsort((starts, owner))
        starts, owner = starts[order], owner[order]
        out = {"doc_id": [], "row": [], "spans": []}
        for own, part in _by_owner(owner):
            out["doc_id"].append(int(ids[own]))
            out["row"].append(int(rows[own]))
            out["spans"].append(spans_of(starts[part], starts[part] + length).tobytes())
        return pa.Table.from_batches([batch(schema, **out)])

    return run


def _remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts without their spans."""
    schema = arrow_schema(_RESULT)
    unzip = zstandard.ZstdDecompressor()
    for b in batches:
        out = {name: [] for name in schema.names}
        for r in b.select(["doc_id", "packed", "spans"]).to_pylist():
            text = unzip.decompress(r["packed"])
            found = np.frombuffer(b"".join(r["spans"] or ()), np.int64).reshape(-1, 2)
            found = found[np.argsort(found[:, 0], kind="stable")]
            spans = spans_of(found[:, 0], found[:, 1])
            kept, at = hashlib.sha256(), 0
            for start, end in spans.tolist():
                kept.update(text[at:start])
                at = end
            kept.update(text[at:])
            out["doc_id"].append(r["doc_id"])
            out["n_bytes"].append(len(text))
            out["n_removed"].append(int((spans[:, 1] - spans[:, 0]).sum()))
            out["n_spans"].append(len(spans))
            out["kept_sha256"].append(kept.hexdigest())
            out["spans"].append(spans.tobytes())
        yield batch(schema, **out)


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts compressed, as whole documents are dealt out by their key."""
    schema = arrow_schema("doc_id long, row long, packed binary")
    squeeze = zstandard.ZstdCompressor(level=3)
    for b in batches:
        packed = [squeeze.compress(t) for t in b.column("bytes").to_pylist()]
        yield batch(schema, doc_id=b.column("doc_id"), row=b.column("row"), packed=packed)


def repeated_passages(docs: DataFrame, length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """Every row of `docs` (doc_id, text) without the bytes of passages that a smaller doc_id has.

    Returns doc_id, n_bytes, n_removed, n_spans, kept_sha256 and spans (pairs
    of little-endian 64-bit starts and ends of what goes, in bytes of the
    UTF-8 text). Null texts are empty; texts shorter than `length` stay whole.
    Rows of one doc_id do not remove each other's bytes; repeated rows are
    returned each. A row without doc_id stays whole and removes nothing.
    Other columns are ignored.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("row"), utf8().alias("bytes"))
    total = rows.agg(F.coalesce(F.sum(F.octet_length("bytes")), F.lit(0))).first()[0]
    expected = total * 2 // (length - gram + 2)
    buckets = max(BUCKETS, -(-expected // IN_BUCKET))
    posts = rows.mapInArrow(_post_anchors(buckets, length, gram), _POSTS)
    actions = landed(posts.groupBy("bucket").applyInArrow(_refine, _ACTIONS), "actions")

    packed = rows.mapInArrow(_packed, "doc_id long, row long, packed binary")
    by_row = actions.groupBy("doc_id", "row").agg(F.collect_list("covered").alias("covered"), F.collect_list("opened").alias("opened"))
    strings = packed.join(by_row, ["doc_id", "row"]).mapInArrow(_apply(buckets, length, gram), _STRINGS)
    spans = landed(strings.groupBy("bucket").applyInArrow(_repeated(length), _SPANS), "spans")
    spans = spans.groupBy("doc_id", "row").agg(F.collect_list("spans").alias("spans"))
    return packed.join(spans, ["doc_id", "row"], "left").mapInArrow(_remove, _RESULT)
