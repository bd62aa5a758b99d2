"""The multi-value (m) / sub-value (s) cell model as SQL expressions.

A tag's cells arrive as ARRAY<STRUCT<_VALUE, _m, _s>> in document order. An
absent attribute means position 1, a hole becomes NULL, and on a repeated
position the first cell wins.

Every function takes the SQL text of an expression for the cells and returns
SQL text. A wide table has hundreds of such columns, and one expression string
per column is built far faster than the same tree of Column objects.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql.types import ArrayType, LongType, StringType, StructField, StructType

CELL = StructType(
    [
        StructField("_VALUE", StringType()),
        StructField("_m", LongType()),
        StructField("_s", LongType()),
    ]
)
CELLS = ArrayType(CELL)

_NO_ITEMS = "CAST(array() AS ARRAY<STRING>)"
_NO_GROUPS = "CAST(array() AS ARRAY<ARRAY<STRING>>)"

# Lambda variables: they must not be the name of anything the cells' text uses.
X, P, G, M, SLOT = "__cell", "__positions", "__group", "__m", "__slot"


def m_of(cell: str) -> str:
    return f"coalesce({cell}._m, 1L)"


def s_of(cell: str) -> str:
    return f"coalesce({cell}._s, 1L)"


def bind(value: str, name: str, body: str) -> str:
    """Evaluate ``value`` once and let ``body`` use it under ``name``.

    Spark does not hoist loop-invariant expressions out of a lambda, so a
    derived array used inside one would be rebuilt for every element.
    """
    return f"get(transform(array({value}), {name} -> {body}), 0)"


def _lay_out(cells: str, position: Callable[[str], str]) -> str:
    """Non-empty cells as a list over ``position``.

    A lone cell at position 1 needs no lambda at all, and positions that
    already run 1, 2, 3, ... need one pass; only holes, repeats and disorder
    take the general way.
    """
    first = f"get({cells}, 0)"
    slots = (
        f"transform(sequence(1L, array_max({P})), "
        f"{SLOT} -> get({cells}._VALUE, CAST(array_position({P}, {SLOT}) - 1 AS INT)))"
    )
    general = bind(
        f"transform({cells}, {X} -> {position(X)})",
        P,
        f"CASE WHEN {P} = sequence(1L, CAST(size({P}) AS BIGINT)) THEN {cells}._VALUE "
        f"ELSE {slots} END",
    )
    return (
        f"CASE WHEN size({cells}) = 1 AND {position(first)} = 1 "
        f"THEN array({first}._VALUE) ELSE {general} END"
    )


def in_group(cells: str, m_index: int | str) -> str:
    return f"filter({cells}, {X} -> {m_of(X)} = {m_index})"


def group_list(cells: str, m_index: int) -> str:
    """ARRAY<STRING> over s of one m group; tag absent -> NULL, group absent -> []."""
    items = f"CASE WHEN size({G}) = 0 THEN {_NO_ITEMS} ELSE {_lay_out(G, s_of)} END"
    return f"CASE WHEN {cells} IS NOT NULL THEN {bind(in_group(cells, m_index), G, items)} END"


def value_list(cells: str) -> str:
    """ARRAY<STRING> over m."""
    return (
        f"CASE WHEN {cells} IS NULL THEN NULL WHEN size({cells}) = 0 THEN {_NO_ITEMS} "
        f"ELSE {_lay_out(cells, m_of)} END"
    )


def nested_list(cells: str) -> str:
    """ARRAY<ARRAY<STRING>>: m groups, each a list over its own s; no group -> [NULL]."""
    items = f"CASE WHEN size({G}) = 0 THEN array(CAST(NULL AS STRING)) ELSE {_lay_out(G, s_of)} END"
    groups = (
        f"transform(sequence(1L, array_max(transform({cells}, {X} -> {m_of(X)}))), "
        f"{M} -> {bind(in_group(cells, M), G, items)})"
    )
    return (
        f"CASE WHEN {cells} IS NULL THEN NULL WHEN size({cells}) = 0 THEN {_NO_GROUPS} "
        f"ELSE {groups} END"
    )


def group_scalar(cells: str, m_index: int) -> str:
    """First item of ``group_list``, without building the list."""
    return f"get(filter({cells}, {X} -> {m_of(X)} = {m_index} AND {s_of(X)} = 1), 0)._VALUE"


def value_scalar(cells: str) -> str:
    """First item of ``value_list``, without building the list."""
    first = f"get({cells}, 0)"
    return (
        f"CASE WHEN {m_of(first)} = 1 THEN {first}._VALUE "
        f"ELSE get({in_group(cells, 1)}, 0)._VALUE END"
    )


def has_sub_values(cells: str) -> str:
    return f"exists({cells}, {X} -> {s_of(X)} > 1)"


def list_is_plural(cells: str) -> str:
    """Would ``value_list`` hold more than one item? (m = 0 counts down to two.)"""
    return f"array_max(transform({cells}, {X} -> {m_of(X)})) <> 1"


def group_is_plural(cells: str, m_index: int) -> str:
    """Would ``group_list`` hold more than one item?"""
    return f"array_max(transform({in_group(cells, m_index)}, {X} -> {s_of(X)})) <> 1"
