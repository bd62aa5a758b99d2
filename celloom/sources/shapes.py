"""What shapes the columns of landed records take, kept with each landing.

A column's shape over several landings is the deepest that it has in one of
them, so what is known of each landing is merged without looking at its XML.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import SparkSession

from celloom.model import LookupRow
from celloom.operators.shapes import LIST, NESTED, SCALAR, Shapes, profile_shapes
from celloom.sources.files import path_exists
from celloom.sources.landing import read_landed

# Readers of a landing pass over names that begin with an underscore.
_FOLDER = "_shapes"
_KEPT = "tag string, m_index int, shape string"
_DEPTH = {SCALAR: 0, LIST: 1, NESTED: 2}

Source = tuple[str, int | None]


def kept_shapes(spark: SparkSession, path: str) -> dict[Source, str]:
    """What is kept of one landing: a row a tag, or a group of a tag, that was ever asked for."""
    folder = f"{path}/{_FOLDER}"
    if not path_exists(spark, f"{folder}/*.parquet"):
        return {}
    rows = spark.read.schema(_KEPT).parquet(folder).collect()
    return {(r["tag"], r["m_index"]): r["shape"] for r in rows}


def _of_landing(spark: SparkSession, path: str, rows: Sequence[LookupRow], xml_column: str) -> dict[Source, str]:
    known = kept_shapes(spark, path)
    new = {(r.tag, r.m_index): r for r in rows if (r.tag, r.m_index) not in known}
    if not new:
        return known
    # names as they come from the lookup may repeat a source, or a name of another lookup
    asked = [LookupRow(r.tag, r.m_index, str(k)) for k, r in enumerate(new.values())]
    shapes = profile_shapes(read_landed(spark, path), asked, xml_column)
    found = {(r.tag, r.m_index): shapes[r.name] for r in asked}
    kept = spark.createDataFrame([(*source, shape) for source, shape in found.items()], _KEPT)
    kept.coalesce(1).write.mode("append").parquet(f"{path}/{_FOLDER}")
    return known | found


def landed_shapes(
    spark: SparkSession, paths: Sequence[str], rows: Sequence[LookupRow], xml_column: str = "XMLRECORD"
) -> Shapes:
    """The shape of each lookup row's column over all records of some landings.

    Records are searched only for what is not kept yet, and then it is.
    """
    shapes = {r.name: SCALAR for r in rows}
    for path in paths:
        kept = _of_landing(spark, path, rows, xml_column)
        for r in rows:
            shapes[r.name] = max(shapes[r.name], kept[r.tag, r.m_index], key=_DEPTH.__getitem__)
    return shapes
