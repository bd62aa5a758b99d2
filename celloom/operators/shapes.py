"""What shape each wide column takes in a batch: scalar, list, list of lists.

A column's type must be known before the projection is built. The plain way
is to parse the whole batch twice more: once to look for sub-values, once to
measure the lists. Only cells that carry an explicit m or s attribute can make
a column more than a scalar, so here the batch's text is searched for such
tags first, at a fraction of a parse; then only they are parsed, and only
where they occur.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import ArrayType

from celloom.functions import cells as C
from celloom.functions.plain import MARKS, not_plain, plain_tags, position_marks
from celloom.functions.xml import cell_schema, parse_xml
from celloom.model import LookupRow

SCALAR, LIST, NESTED = "scalar", "list", "nested"

Shapes = dict[str, str]

# Start tags with an m (s) attribute other than a plain "1". The name must
# follow white space, and no raw "<" can occur in a start tag, so every such
# tag is found; text that merely looks like one only adds a candidate. The
# parser takes names in either case unless the session says otherwise.
_ATTRIBUTE = r"""<([^\s<>/]+)(?=\s)[^<]*?\s(?i:{0})\s*=\s*(?!"1"|'1')"""

# The parser also takes positions from child elements <_m> and <_s>, and a
# document type may define text of its own: such records are always parsed.
_ELSEWHERE = ("<_", "<!DOCTYPE")

PILOT_ROWS = 200


def list_shapes(shapes: Shapes) -> Shapes:
    """The shapes before normalisation: no scalars."""
    return {name: LIST if shape == SCALAR else shape for name, shape in shapes.items()}


def sub_value_tags(df: DataFrame, rows: Sequence[LookupRow], parsed: str) -> set[str]:
    """Tags mapped without an m index that hold an s above 1 in any row."""
    tags = list(dict.fromkeys(r.tag for r in rows if r.m_index is None))
    if not tags:
        return set()
    flags = df.agg(
        *[F.expr(f"bool_or({C.has_sub_values(f'{parsed}.`{t}`')})").alias(t) for t in tags]
    ).first()
    return {t for t in tags if flags[t]}


def list_sizes(df: DataFrame) -> DataFrame:
    """One row: the longest list of each array column (NULL if there is none)."""
    return df.agg(
        *[
            F.max(F.size(F.col(f"`{f.name}`"))).alias(f.name)
            for f in df.schema.fields
            if isinstance(f.dataType, ArrayType)
        ]
    )


def normalize_arrays(df: DataFrame) -> DataFrame:
    """Flat list columns with no list of two or more items become scalars.

    Lists of lists stay. For a DataFrame already built; ``parse_wide`` reaches
    the same result without building the lists first.
    """
    flat = [
        f.name
        for f in df.schema.fields
        if isinstance(f.dataType, ArrayType) and not isinstance(f.dataType.elementType, ArrayType)
    ]
    if not flat:
        return df
    sizes = list_sizes(df.select(*[F.col(f"`{c}`") for c in flat])).first()
    single = {c for c in flat if (sizes[c] or 0) <= 1}
    return df.select(
        *[
            F.get(F.col(f"`{c}`"), F.lit(0)).alias(c) if c in single else F.col(f"`{c}`")
            for c in df.columns
        ]
    )


def _marked_tags(xml: Column, attribute: str) -> Column:
    """In lower case. Most records have no s at all, which a plain search tells sooner."""
    found = F.regexp_extract_all(xml, F.lit(_ATTRIBUTE.format(attribute)), F.lit(1))
    tags = F.transform(F.array_distinct(found), F.lower)
    present = xml.rlike(rf"\s(?i:{attribute})\s*=")
    return F.when(present, tags).otherwise(F.array().cast("array<string>"))


def _marked_elsewhere(xml: Column) -> Column:
    return reduce(Column.__or__, [xml.contains(text) for text in _ELSEWHERE])


def _traits(rows: Sequence[LookupRow], normalize: bool) -> dict[tuple, tuple[str, str]]:
    """Every fact that can lift a column's shape: key -> (attribute it needs, test)."""
    traits = {}
    for r in rows:
        cells = f"_cells.`{r.tag}`"
        if r.m_index is None:
            traits["sub", r.tag] = ("s", C.has_sub_values(cells))
        if not normalize:
            continue
        if r.m_index is None:
            traits["list", r.tag] = ("m", C.list_is_plural(cells))
        else:
            traits["group", r.tag, r.m_index] = ("s", C.group_is_plural(cells, r.m_index))
    return traits


def _prove(df: DataFrame, traits: dict[tuple, tuple[str, str]]) -> set[tuple]:
    """Which of the traits hold in some row. Parses the traits' tags only."""
    keys = list(traits)
    schema = cell_schema(key[1] for key in keys)
    flags = (
        df.select(parse_xml("_xml", schema).alias("_cells"))
        .agg(*[F.expr(f"bool_or({traits[key][1]})").alias(str(i)) for i, key in enumerate(keys)])
        .first()
    )
    return {key for i, key in enumerate(keys) if flags[i]}


def _search(text: DataFrame, traits: dict[tuple, tuple[str, str]]) -> set[tuple]:
    """Which of the traits hold in some row of any kind, by a search of its text first."""
    wanted: dict[str, dict[str, None]] = {}
    for key, (attribute, _) in traits.items():
        wanted.setdefault(attribute, {})[key[1].lower()] = None
    if not traits:
        return set()

    def mapped(attribute: str) -> Column:
        tags = F.array(*[F.lit(t) for t in wanted[attribute]])
        return F.array_intersect(_marked_tags(F.col("_xml"), attribute), tags)

    elsewhere = _marked_elsewhere(F.col("_xml"))
    def named(attribute: str, tags: Column) -> Column:
        return F.transform(tags, lambda tag: F.struct(F.lit(attribute).alias("attribute"), tag.alias("tag")))

    unclear = F.when(elsewhere, F.array(F.lit(""))).otherwise(F.array().cast("array<string>"))
    found = F.concat(*[named(a, mapped(a)) for a in wanted], named("any", unclear))
    # grouped in each task first: what is shuffled is two rows a mapped tag and task, and one
    marked = {
        (r["mark"]["attribute"], r["mark"]["tag"])
        for r in text.select(F.explode(found).alias("mark")).distinct().collect()
    }
    open_traits = {k: t for k, t in traits.items() if (t[0], k[1].lower()) in marked}

    proven: set[tuple] = set()
    if ("any", "") in marked:
        proven |= _prove(text.where(elsewhere), traits)
        open_traits = {k: t for k, t in open_traits.items() if k not in proven}
    if open_traits:
        pilot = text.limit(PILOT_ROWS)
        proven |= _prove(pilot, open_traits)
        settled = proven | {("list", k[1]) for k in proven if k[0] == "sub"}
        open_traits = {k: t for k, t in open_traits.items() if k not in settled}
    if open_traits:

        def shows(attribute: str) -> Column:
            tags = sorted({k[1].lower() for k, t in open_traits.items() if t[0] == attribute})
            if not tags:
                return F.lit(False)
            return F.arrays_overlap(
                _marked_tags(F.col("_xml"), attribute), F.array(*[F.lit(t) for t in tags])
            )

        proven |= _prove(text.where(shows("s") | shows("m")), open_traits)
    return proven


def profile_shapes(
    df: DataFrame,
    rows: Sequence[LookupRow],
    xml_column: str = "XMLRECORD",
    normalize: bool = True,
) -> Shapes:
    """The exact shape of every column over the whole batch.

    Once a trait is seen it holds for the batch, so a few rows settle most of
    them; what they do not settle is parsed from every row that could show it.
    Without ``normalize`` only sub-values are looked for: nothing is a scalar.
    """
    text = df.select(F.col(xml_column).alias("_xml"))
    traits = _traits(rows, normalize)
    if not traits:
        return {r.name: LIST for r in rows}

    proven: set[tuple] = set()
    rest = True
    if plain_tags(r.tag for r in rows):
        keys = list(traits)
        # two rows a trait and task, at most
        marks = {r["trait"] for r in text.mapInArrow(position_marks(keys), MARKS).distinct().collect()}
        proven = {keys[k] for k in marks if k >= 0}
        text = text.mapInArrow(not_plain, "_xml string")
        rest = -1 in marks
    if rest:
        proven |= _search(text, {k: t for k, t in traits.items() if k not in proven})

    def shape(r: LookupRow) -> str:
        if r.m_index is not None:
            return LIST if ("group", r.tag, r.m_index) in proven else SCALAR
        if ("sub", r.tag) in proven:
            return NESTED
        return LIST if ("list", r.tag) in proven else SCALAR

    found = {r.name: shape(r) for r in rows}
    return found if normalize else list_shapes(found)
