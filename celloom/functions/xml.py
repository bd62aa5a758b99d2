"""Built-in XML parsing of one column, and the schema the lookup asks for."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, functions as F
from pyspark.sql.types import StringType, StructField, StructType

from celloom.functions.cells import CELLS
from celloom.model import LookupRow, Window


def cell_schema(tags: Iterable[str]) -> StructType:
    """One cell array per distinct tag, in order of first mention."""
    return StructType([StructField(tag, CELLS) for tag in dict.fromkeys(tags)])


def xml_schema(rows: Iterable[LookupRow]) -> StructType:
    return cell_schema(r.tag for r in rows)


def parse_xml(
    column: Column | str,
    schema: StructType,
    corrupt_column: str | None = None,
    options: dict[str, str] | None = None,
) -> Column:
    """The built-in XML parser over one column; unparsable text gives NULL fields.

    ``corrupt_column`` adds a field that receives such text.
    """
    opts = {"rowTag": "row", **(options or {})}
    if corrupt_column:
        schema = StructType([*schema.fields, StructField(corrupt_column, StringType())])
        opts["columnNameOfCorruptRecord"] = corrupt_column
    return F.from_xml(column, schema, opts)


def business_date(xml: Column | str, date_tag: str) -> Column:
    """The first 8 characters of the first <date_tag> under <row>; absent, empty or unparsable -> NULL.

    Cut as the source cuts it, so that both sides group a longer date alike.
    """
    cells = parse_xml(xml, cell_schema([date_tag]))[date_tag]
    return F.substring(F.get(cells, F.lit(0))["_VALUE"], 1, 8)


def in_window(day: Column, window: Window | None) -> Column:
    """Both ends inclusive, compared as text; a NULL date is in no window."""
    return F.lit(True) if window is None else day.between(*window)
