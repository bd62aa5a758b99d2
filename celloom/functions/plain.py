"""Flat records read a batch of them at a time, by whole-array steps.

A record is plain if it is one <row> of c-numbered elements, each with text of
printable characters or closed at once, and no attributes but m and s counted
from 1: no entities, comments, name spaces, nested elements or stray white space.
What the built-in parser makes of such a record is known, and is made here at a
fraction of its cost. All other records are left to that parser.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, functions as F
from pyspark.sql.types import ArrayType, StringType, StructField, StructType

from celloom.functions.cells import CELLS

# Printable but for & < > (and " in an attribute); spaces only between words.
_WORD, _ID = r"[!-%'-;=?-~]+", r"[ !#-%'-;=?-~]*"
_NAME, _AT = r"c(?:0|[1-9][0-9]{0,5})", r"[1-9][0-9]{0,8}"
_PLAIN = (
    rf'\A<row(?: id="{_ID}")?>'
    rf'(?:<{_NAME}(?: m="{_AT}")?(?: s="{_AT}")?(?:/>|>{_WORD}(?: {_WORD})*</{_NAME}>))*</row>\z'
)
_CELL = pa.struct([("_VALUE", pa.string()), ("_m", pa.int64()), ("_s", pa.int64())])


def plain_tags(tags: Iterable[str]) -> bool:
    """Whether the tags are spelled as those of plain records are."""
    return all(re.fullmatch(_NAME, tag) for tag in tags)


@dataclass(frozen=True)
class _Elements:
    """The elements of a batch's plain records, in order: the record's place in the batch, the tag's number, where
    the attributes begin, where the text lies."""

    data: np.ndarray
    plain: np.ndarray
    record: np.ndarray
    number: np.ndarray
    name_end: np.ndarray
    start: np.ndarray
    end: np.ndarray
    empty: np.ndarray

    def positions(self, chosen: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """m and s of some elements; 0 where there is none."""
        at, found = self.name_end[chosen], []
        for name in b"ms":
            has = (self.data[at] == ord(" ")) & (self.data[at + 1] == name)
            number = np.zeros(len(at), np.int64)
            number[has], after = _numbers(self.data, at[has] + 4)
            at[has] = after + 1
            found.append(number)
        return found[0], found[1]

    def texts(self, chosen: np.ndarray, none: np.ndarray | None = None) -> pa.Array:
        """The texts of some elements, in any order; NULL for those closed at once, and where there is ``none``."""
        # texts and what lies between them are the items of one array over the data
        offsets = np.stack([self.start, self.end], axis=1).reshape(-1)
        buffers = [None, pa.py_buffer(offsets), pa.py_buffer(self.data)]
        items = pa.Array.from_buffers(pa.large_string(), max(len(offsets) - 1, 0), buffers)
        void = self.empty[chosen] if none is None else none | self.empty[chosen]
        return items.take(pa.array(2 * chosen, mask=void)).cast(pa.string())


def _numbers(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The numbers that begin at some places, and where they end."""
    number = np.zeros(len(at), np.int64)
    while True:
        digit = data[at] - np.uint8(48)
        more = digit < 10
        if not more.any():
            return number, at
        number = np.where(more, number * 10 + digit, number)
        at = at + more


def _names(data: np.ndarray, at: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The names, of so many characters, that begin at some places, as eight bytes each."""
    words = np.ndarray(len(data) - 7, "<u8", data, strides=(1,))  # a record's end has as many bytes left
    return words[at] & (np.uint64(1) << (8 * size).astype(np.uint64)) - np.uint64(1)


def _name_numbers(name: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The numbers that follow the c: digits moved to the last bytes, then added in pairs, fours and eights."""
    digits = (name >> np.uint64(8) << (72 - 8 * size).astype(np.uint64)) & np.uint64(0x0F0F0F0F0F0F0F0F)
    pairs = (digits * np.uint64(2561) >> np.uint64(8)) & np.uint64(0x00FF00FF00FF00FF)
    fours = (pairs * np.uint64(6553601) >> np.uint64(16)) & np.uint64(0x0000FFFF0000FFFF)
    return (fours * np.uint64(42949672960001) >> np.uint64(32)).astype(np.int64)


def _elements(text: pa.Array) -> _Elements:
    plain = pc.fill_null(pc.match_substring_regex(text, _PLAIN), False)
    kept = text if plain.false_count == 0 else text.filter(plain)
    plain = plain.to_numpy(zero_copy_only=False).copy()
    places = np.flatnonzero(plain)
    kept = kept.cast(pa.large_string())
    offsets = np.frombuffer(kept.buffers()[1], np.int64)[kept.offset : kept.offset + len(kept) + 1] if len(kept) else [0, 0]
    data = np.frombuffer(kept.buffers()[2] or b"", np.uint8)[offsets[0] : offsets[-1]]
    brackets = np.flatnonzero(data & ~np.uint8(2) == ord("<"))  # of both kinds, in turn
    opening, closing = brackets[0::2], brackets[1::2]
    kind = data[opening + 1]
    which = np.flatnonzero(kind == ord("c"))
    rows = np.flatnonzero(kind == ord("r"))
    nth = np.repeat(np.arange(len(rows)), np.diff(np.searchsorted(which, rows), append=len(which)))
    start, end, opened = closing[which] + 1, opening[which + 1], opening[which]
    empty = data[start - 2] == ord("/")
    number, name_end = np.zeros(len(which), np.int64), np.zeros(len(which), np.int64)
    number[empty], name_end[empty] = _numbers(data, opened[empty] + 2)
    if not empty.all():
        # an element's own name is as long as the one that closes it, if they are the same
        full = ~empty
        size = closing[which[full] + 1] - end[full] - 2
        name = _names(data, opened[full] + 1, size)
        number[full], name_end[full] = _name_numbers(name, size), opened[full] + 1 + size
        other = (name != _names(data, end[full] + 2, size)) | (data[name_end[full]] - np.uint8(48) < 10)
        # elements closed by another's name
        plain[places[nth[full][other]]] = False
    record = places[nth]
    if plain.sum() == len(places):
        return _Elements(data, plain, record, number, name_end, start, end, empty)
    own = plain[record]
    return _Elements(data, plain, record[own], number[own], name_end[own], start[own], end[own], empty[own])


def _batch_cells(text: pa.Array, tags: Sequence[str]) -> pa.Array:
    found = _elements(text)
    columns = []
    for tag in tags:
        chosen = np.flatnonzero(found.number == int(tag[1:]))
        m, s = found.positions(chosen)
        cells = pa.StructArray.from_arrays(
            [found.texts(chosen), pa.array(m, mask=m == 0), pa.array(s, mask=s == 0)], fields=list(_CELL)
        )
        counts = np.bincount(found.record[chosen], minlength=len(text))
        offsets = pa.array(np.concatenate([[0], np.cumsum(counts)]).astype(np.int32))
        columns.append(pa.ListArray.from_arrays(offsets, cells, mask=pa.array(counts == 0)))
    fields = [pa.field(tag, column.type) for tag, column in zip(tags, columns)]
    return pa.StructArray.from_arrays(columns, fields=fields, mask=pa.array(~found.plain))


def plain_cells(xml: Column | str, schema: StructType) -> Column | None:
    """The cells of plain records, NULL for all others; None if the schema asks for anything else."""
    tags = schema.fieldNames()
    if not tags or not plain_tags(tags) or any(f.dataType != CELLS for f in schema.fields):
        return None

    @F.arrow_udf(schema)
    def cells(text: pa.Array) -> pa.Array:
        return _batch_cells(text, tags)

    return cells(xml)


# --- wide columns -------------------------------------------------------------

#: Records with a position above this are left to the parser, whatever their columns then take.
MOST_POSITION = 10_000
#: Places that the lists of a batch may have together; a batch with more is taken in halves.
MOST_PLACES = 20_000_000

#: (tag, m or None, depth): 0 is a scalar, 1 a list, 2 a list of lists.
Wide = tuple[str, int | None, int]

_TYPES = (pa.string(), pa.list_(pa.string()), pa.list_(pa.list_(pa.string())))


def _places(group: np.ndarray, at: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Lists for ``n`` groups, whose numbers do not fall: where each list begins, and which of the items stands at each
    place; -1 where none does. Of several at one position, the first."""
    sizes = np.zeros(n, np.int64)
    if len(group):
        first = np.flatnonzero(np.diff(group, prepend=-1))
        sizes[group[first]] = np.maximum.reduceat(at, first)
    offsets = np.concatenate([[0], np.cumsum(sizes)])
    item = np.full(offsets[-1], -1, np.int64)
    item[(offsets[group] + at - 1)[::-1]] = np.arange(len(at))[::-1]
    return offsets, item


def _batch_wide(text: pa.Array, columns: Sequence[Wide]) -> pa.Array:
    found, n = _elements(text), len(text)
    of_tag, far, most = {}, [], 0
    for tag in {tag for tag, _, _ in columns}:
        chosen = np.flatnonzero(found.number == int(tag[1:]))
        m, s = found.positions(chosen)
        of_tag[tag] = chosen, found.record[chosen], np.maximum(m, 1), np.maximum(s, 1)
        beyond = (m > MOST_POSITION) | (s > MOST_POSITION)
        far.append(found.record[chosen[beyond]])
        most += int(m[~beyond].sum() + s[~beyond].sum())
    if most > MOST_PLACES and n > 1:
        return pa.concat_arrays([_batch_wide(part, columns) for part in (text.slice(0, n // 2), text.slice(n // 2))])
    plain = found.plain.copy()
    plain[np.concatenate([np.zeros(0, np.int64), *far])] = False
    if plain.sum() < found.plain.sum():
        of_tag = {tag: tuple(part[plain[record]] for part in (chosen, record, m, s)) for tag, (chosen, record, m, s) in of_tag.items()}

    def texts(chosen: np.ndarray, item: np.ndarray) -> pa.Array:
        if not len(chosen):
            return pa.nulls(len(item), pa.string())
        return found.texts(chosen[np.maximum(item, 0)], item < 0)

    def lists(offsets: np.ndarray, items: pa.Array, none: np.ndarray | None = None) -> pa.Array:
        return pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), items, mask=None if none is None else pa.array(none))

    made = []
    for tag, index, depth in columns:
        chosen, record, m, s = of_tag[tag]
        none = np.bincount(record, minlength=n) == 0
        at = m
        if index is not None:
            own = m == index
            chosen, record, m, s = chosen[own], record[own], m[own], s[own]
            at = s
        if depth == 0:
            lone = at == 1
            chosen, record, item = chosen[lone], record[lone], np.full(n, -1, np.int64)
            item[record[::-1]] = np.arange(len(record))[::-1]
            made.append(texts(chosen, item))
        elif depth == 1:
            offsets, item = _places(record, at, n)
            made.append(lists(offsets, texts(chosen, item), none))
        else:
            outer, _ = _places(record, m, n)
            group = outer[record] + m - 1
            if (np.diff(group) < 0).any():
                order = np.argsort(group, kind="stable")
                chosen, group, s = chosen[order], group[order], s[order]
            # a group without cells is a list of one NULL
            held = np.zeros(outer[-1], bool)
            held[group] = True
            lacks = np.flatnonzero(~held)
            if len(lacks):
                order = np.argsort(np.concatenate([group, lacks]), kind="stable")
                item = np.concatenate([np.arange(len(group)), np.full(len(lacks), -1)])[order]
                group, s = np.concatenate([group, lacks])[order], np.concatenate([s, np.ones(len(lacks), np.int64)])[order]
            else:
                item = np.arange(len(group))
            inner, place = _places(group, s, outer[-1])
            item = np.where(place < 0, -1, item[place]) if len(item) else place
            made.append(lists(outer, lists(inner, texts(chosen, item)), none))
    names = [str(k) for k in range(len(columns))]
    fields = [pa.field(name, _TYPES[depth]) for name, (_, _, depth) in zip(names, columns)]
    return pa.StructArray.from_arrays([a.cast(f.type) for a, f in zip(made, fields)], fields=fields, mask=pa.array(~plain))


def plain_wide(xml: Column | str, columns: Sequence[Wide]) -> Column | None:
    """The wide columns of plain records, named 0, 1, ..., NULL for all others; None if tags are spelled otherwise."""
    if not columns or not plain_tags(tag for tag, _, _ in columns):
        return None
    types = StringType(), ArrayType(StringType()), ArrayType(ArrayType(StringType()))

    @F.arrow_udf(StructType([StructField(str(k), types[depth]) for k, (_, _, depth) in enumerate(columns)]))
    def wide(text: pa.Array) -> pa.Array:
        return _batch_wide(text, columns)

    return wide(xml)


# --- over whole batches -----------------------------------------------------

TAG_COUNTS = "tag string, n bigint, rest string"


def tag_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """How many plain records of a batch hold a tag; the other records as they are."""
    for batch in batches:
        text = batch.column(0)
        found = _elements(text)
        held = np.unique(found.record * 1_000_000 + found.number) % 1_000_000
        numbers, counts = np.unique(held, return_counts=True)
        rest = text.filter(pa.array(~found.plain))
        tags = pa.array([f"c{k}" for k in numbers] + [None] * len(rest), pa.string())
        counts = pa.concat_arrays([pa.array(counts.astype(np.int64)), pa.nulls(len(rest), pa.int64())])
        texts = pa.concat_arrays([pa.nulls(len(numbers), pa.string()), rest.cast(pa.string())])
        yield pa.RecordBatch.from_arrays([tags, counts, texts], names=["tag", "n", "rest"])


#: The place of a trait among those asked for; -1 for records that are not plain.
MARKS = "trait int"

_ABOVE_ONE = '(?:[2-9][0-9]*|1[0-9]+)"'


def _trait_pattern(trait: tuple) -> str:
    """What a plain record that shows a trait holds."""
    kind, tag, *index = trait
    if kind == "list":
        return f'<{tag} m="{_ABOVE_ONE}'
    if kind == "sub":
        return f'<{tag}(?: m="[0-9]+")? s="{_ABOVE_ONE}'
    return f'<{tag}' + ('(?: m="1")?' if index[0] == 1 else f' m="{index[0]}"') + f' s="{_ABOVE_ONE}'


def position_marks(traits: Sequence[tuple]):
    """For mapInArrow: which traits some plain record shows, and -1 if there are other records while one is open.

    ("list", tag): an m above 1; ("sub", tag): an s above 1; ("group", tag, m): an s above 1 beside that m. Records
    that hold no such text need not be read further; once a task has seen all traits, the rest of its records neither.
    """
    patterns = [_trait_pattern(trait) for trait in traits]

    def marks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unseen, others = dict(enumerate(patterns)), False
        for batch in batches:
            text, new = batch.column(0), []
            if unseen:
                fits = pc.fill_null(pc.match_substring_regex(text, _PLAIN), False)
                holds = pc.match_substring_regex(text, "|".join(unseen.values()))
                likely = text.filter(pc.and_(fits, pc.fill_null(holds, False)))
                plain = _elements(likely).plain  # not one closed by another's name
                others_too = fits.false_count > 0 or not plain.all()
                shown = likely.filter(pa.array(plain))
                new = [k for k, p in unseen.items() if len(shown) and pc.any(pc.match_substring_regex(shown, p)).as_py()]
                for k in new:
                    del unseen[k]
                if others_too and not others:
                    others = True
                    new.append(-1)
            yield pa.RecordBatch.from_arrays([pa.array(new, pa.int32())], names=["trait"])

    return marks


def not_plain(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For mapInArrow: the other records."""
    for batch in batches:
        found = _elements(batch.column(0))
        yield batch.filter(pa.array(~found.plain))
