"""XML column to wide columns, driven by lookup rows."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, functions as F

from celloom.functions import cells as C
from celloom.functions.plain import TAG_COUNTS, plain_cells, plain_wide, tag_counts
from celloom.functions.xml import parse_xml, xml_schema
from celloom.model import LookupRow, leading_columns, named_columns
from celloom.operators.shapes import LIST, NESTED, SCALAR, Shapes, list_shapes, profile_shapes

XML_COLUMN = "XMLRECORD"
PARSED = "_parsed"
_CORRUPT = "_corrupt"
_WIDE = "_wide"
_DEPTH = {SCALAR: 0, LIST: 1, NESTED: 2}


def parse_config(rows: Iterable[LookupRow], xml_column: str = XML_COLUMN) -> tuple[list, dict]:
    """(no columns yet, schema per XML column): columns follow once shapes are known."""
    return [], {xml_column: xml_schema(rows)}


def with_cells(
    df: DataFrame,
    rows: Iterable[LookupRow],
    xml_column: str = XML_COLUMN,
    into: str = PARSED,
    corrupt_column: str | None = None,
) -> DataFrame:
    """The cells of each record: plain records are read batch by batch, all others by the built-in parser."""
    schema = xml_schema(rows)
    cells = parse_xml(xml_column, schema, corrupt_column)
    plain = None if corrupt_column else plain_cells(xml_column, schema)
    return df.withColumn(into, cells if plain is None else F.coalesce(plain, cells))


def corrupt_rows(df: DataFrame, rows: Iterable[LookupRow], xml_column: str = XML_COLUMN) -> DataFrame:
    """The rows whose XML does not parse."""
    parsed = parse_xml(xml_column, xml_schema(rows), corrupt_column=_CORRUPT)
    return df.where(parsed[_CORRUPT].isNotNull())


def wide_column(row: LookupRow, shape: str, parsed: str = PARSED, made: str | None = None) -> str:
    """The SQL text of one wide column, named; ``made`` is there for records without cells."""
    cells = f"{parsed}.`{row.tag}`"
    if row.m_index is not None:
        built = (C.group_scalar if shape == SCALAR else C.group_list)(cells, row.m_index)
    else:
        built = {SCALAR: C.value_scalar, LIST: C.value_list, NESTED: C.nested_list}[shape](cells)
    if made is not None:
        built = f"CASE WHEN {_WIDE} IS NOT NULL THEN {made} ELSE {built} END"
    return f"{built} AS `{row.name}`"


def chosen_rows(lookup: Sequence[LookupRow], columns: int | Iterable[str] | None) -> list[LookupRow]:
    """The lookup's rows: all, the first so many, or those of some columns."""
    rows = list(lookup)
    if columns is None:
        return rows
    return leading_columns(rows, columns) if isinstance(columns, int) else named_columns(rows, columns)


def parse_wide(
    df: DataFrame,
    lookup: Sequence[LookupRow],
    keep: Sequence[str] = ("recid",),
    columns: int | Iterable[str] | None = None,
    normalize: bool = True,
    shapes: Shapes | None = None,
    xml_column: str = XML_COLUMN,
    corrupt: str | None = None,
) -> DataFrame:
    """One wide column per lookup row, then the ``keep`` columns.

    ``corrupt`` names a column more, of the same parse: the XML of rows that do
    not parse, NULL in all others.

    Shapes come from the whole batch unless given. With ``normalize`` a list
    column whose lists all hold at most one item is read as a scalar straight
    from the cells; without it every column is a list, or a list of lists.
    Only tags of the chosen columns enter the XML schema: the optimizer does
    not prune it, and each mapped tag costs parse time.
    """
    rows = chosen_rows(lookup, columns)
    if shapes is None:
        shapes = profile_shapes(df, rows, xml_column, normalize)
    elif not normalize:
        shapes = list_shapes(shapes)
    kept = [f"`{c}`" for c in keep]
    if corrupt is not None:
        kept.append(f"{PARSED}.`{_CORRUPT}` AS `{corrupt}`")
    # plain records' columns are made batch by batch, without their cells in between
    wide = None if corrupt is not None else plain_wide(xml_column, [(r.tag, r.m_index, _DEPTH[shapes[r.name]]) for r in rows])
    if wide is None:
        parsed = with_cells(df, rows, xml_column, corrupt_column=corrupt and _CORRUPT)
        return parsed.selectExpr(*[wide_column(r, shapes[r.name]) for r in rows], *kept)
    others = F.when(F.col(_WIDE).isNull(), parse_xml(xml_column, xml_schema(rows)))
    return df.withColumn(_WIDE, wide).withColumn(PARSED, others).selectExpr(
        *[wide_column(r, shapes[r.name], made=f"{_WIDE}.`{k}`") for k, r in enumerate(rows)], *kept
    )


def tag_census(df: DataFrame, lookup: Iterable[LookupRow], xml_column: str = XML_COLUMN) -> DataFrame:
    """(tag, mapped, row_count): every element that stands right under a record's root, in how many records, and
    whether the lookup takes it.

    Plain records are counted batch by batch; the others are parsed whole, as
    VARIANT, for which no schema is needed. Names are in lower case, as the parser
    matches them. Attributes of the root are not elements; records that do not
    parse have none.
    """
    mapped = sorted({r.tag.lower() for r in lookup})
    counted = df.select(xml_column).mapInArrow(tag_counts, TAG_COUNTS)
    whole = counted.withColumn("_record", F.expr("from_xml(rest, 'variant', map('rowTag', 'row'))"))
    found = whole.lateralJoin(whole.sparkSession.tvf.variant_explode_outer(F.col("_record").outer()))
    element = F.when(~F.startswith("key", F.lit("_")), F.lower("key"))
    seen = found.select(F.coalesce("tag", element).alias("tag"), F.coalesce("n", F.lit(1)).alias("n"))
    return seen.where("tag IS NOT NULL").groupBy("tag").agg(F.sum("n").alias("row_count")).select(
        "tag", F.col("tag").isin(*mapped).alias("mapped"), "row_count"
    )
