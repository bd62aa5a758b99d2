"""Fitting a batch and a stored table to each other's list depth.

A wide column is STRING (depth 0), ARRAY<STRING> (1) or ARRAY<ARRAY<STRING>>
(2), and both the batch and the table may be the narrower one. A narrower
batch is wrapped; a narrower table is migrated. Columns of any other type, or
of equal depth, pass through.

``compat`` keeps every value the way existing tables hold it, uneven as that
is: a stored list becomes one m group ([[a, b]]) while a batch's list becomes
one group per item ([[a], [b]]); a stored NULL becomes [NULL] or [[NULL]]; a
batch's NULL string becomes []; a list column the batch lacks becomes []. With
``compat=False`` lists always become one group per item and NULL stays NULL.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import ArrayType, DataType, StringType, StructField, StructType


def depth(dtype: DataType) -> int | None:
    if isinstance(dtype, StringType):
        return 0
    if isinstance(dtype, ArrayType):
        return 2 if isinstance(dtype.elementType, ArrayType) else 1
    return None


def nullable(dtype: DataType) -> DataType:
    """The type with NULL items allowed at every level, as stored lists have it."""
    if isinstance(dtype, ArrayType):
        return ArrayType(nullable(dtype.elementType), True)
    return dtype


def nullable_schema(schema: StructType) -> StructType:
    return StructType([StructField(f.name, nullable(f.dataType)) for f in schema.fields])


def _col(name: str) -> Column:
    return F.col(f"`{name}`")


def _deeper(column: Column, old: int, new: int) -> Column:
    """Wrapped item by item, NULL kept."""
    if (old, new) == (0, 1):
        wrapped = F.array(column)
    elif (old, new) == (0, 2):
        wrapped = F.array(F.array(column))
    else:
        wrapped = F.transform(column, lambda item: F.array(item))
    return F.when(column.isNotNull(), wrapped)


def wrap_batch_column(column: Column, old: int, new: int, dtype: DataType, compat: bool = True) -> Column:
    """A batch column brought to the table's greater depth."""
    wrapped = _deeper(column, old, new)
    if compat and (old, new) == (0, 1):
        wrapped = F.coalesce(wrapped, F.array().cast(dtype))
    return wrapped.cast(dtype)


def migrate_table_column(column: Column, old: int, new: int, dtype: DataType, compat: bool = True) -> Column:
    """A stored column brought to the batch's greater depth."""
    if not compat:
        return _deeper(column, old, new).cast(dtype)
    return (F.array(F.array(column)) if (old, new) == (0, 2) else F.array(column)).cast(dtype)


def missing_batch_column(dtype: DataType, compat: bool = True) -> Column:
    if compat and isinstance(dtype, ArrayType):
        return F.array().cast(dtype)
    return F.lit(None).cast(dtype)


@dataclass(frozen=True)
class ColumnAction:
    """What one column needs: ``side`` is batch, table or neither."""

    name: str
    side: str | None
    action: str
    dtype: DataType
    old: int | None = None
    new: int | None = None


def plan_reconcile(batch: StructType, table: StructType) -> list[ColumnAction]:
    """One action per column: the table's columns in order, then the batch's new ones."""
    batch, table = nullable_schema(batch), nullable_schema(table)
    incoming = {f.name: f.dataType for f in batch.fields}
    actions = []
    for f in table.fields:
        have = incoming.get(f.name)
        if have is None:
            actions.append(ColumnAction(f.name, "batch", "add", f.dataType))
            continue
        b, t = depth(have), depth(f.dataType)
        if b is None or t is None or b == t:
            actions.append(ColumnAction(f.name, None, "keep", f.dataType))
        elif b > t:
            actions.append(ColumnAction(f.name, "table", "migrate", have, t, b))
        else:
            actions.append(ColumnAction(f.name, "batch", "wrap", f.dataType, b, t))
    stored = set(table.fieldNames())
    actions += [
        ColumnAction(f.name, "table", "add", f.dataType)
        for f in batch.fields
        if f.name not in stored
    ]
    return actions


def reconciled_schema(batch: StructType, table: StructType) -> StructType:
    return StructType([StructField(a.name, a.dtype) for a in plan_reconcile(batch, table)])


def fit_batch(df: DataFrame, table: StructType, compat: bool = True) -> DataFrame:
    """The batch with the reconciled schema."""

    def fitted(a: ColumnAction) -> Column:
        if a.side == "batch" and a.action == "add":
            return missing_batch_column(a.dtype, compat)
        if a.side == "batch" and a.action == "wrap":
            return wrap_batch_column(_col(a.name), a.old, a.new, a.dtype, compat)
        return _col(a.name)

    return df.select(*[fitted(a).alias(a.name) for a in plan_reconcile(df.schema, table)])


def migrate_table(df: DataFrame, target: StructType, compat: bool = True) -> DataFrame:
    """Stored rows brought to a later schema of the same table.

    All columns in one projection: a stored row either has its old shape or
    its new one, with no half-migrated state in between.
    """
    have = {f.name: f.dataType for f in df.schema.fields}
    target = nullable_schema(target)

    def migrated(f: StructField) -> Column:
        if f.name not in have:
            return F.lit(None).cast(f.dataType)
        old, new = depth(have[f.name]), depth(f.dataType)
        if old is None or new is None or old >= new:
            return _col(f.name)
        return migrate_table_column(_col(f.name), old, new, f.dataType, compat)

    return df.select(*[migrated(f).alias(f.name) for f in target.fields])
