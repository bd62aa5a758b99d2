"""Three depths on each side, and columns only one side has."""

import pytest

from celloom.operators.reconcile import fit_batch, migrate_table, plan_reconcile, reconciled_schema

TYPES = {0: "string", 1: "array<string>", 2: "array<array<string>>"}
VALUES = {0: ["x", None], 1: [["x", "y"], [], None], 2: [[["x"], ["y"]], [], None]}

# What each kind of value becomes, by (from, to) depth.
BATCH = {
    (0, 1): [["x"], []],
    (0, 2): [[["x"]], None],
    (1, 2): [[["x"], ["y"]], [], None],
}
TABLE = {
    (0, 1): [["x"], [None]],
    (0, 2): [[["x"]], [[None]]],
    (1, 2): [[["x", "y"]], [[]], [None]],
}
EVEN = {
    (0, 1): [["x"], None],
    (0, 2): [[["x"]], None],
    (1, 2): [[["x"], ["y"]], [], None],
}


def _frame(spark, depth, name="c"):
    rows = [(i, v) for i, v in enumerate(VALUES[depth])]
    return spark.createDataFrame(rows, f"i int, {name} {TYPES[depth]}").coalesce(1)


def _values(df, name="c"):
    return [r[name] for r in df.orderBy("i").collect()]


@pytest.mark.parametrize("compat", [True, False])
@pytest.mark.parametrize("table", [0, 1, 2])
@pytest.mark.parametrize("batch", [0, 1, 2])
def test_depths(spark, batch, table, compat):
    incoming, stored = _frame(spark, batch), _frame(spark, table)
    schema = reconciled_schema(incoming.schema, stored.schema)
    deeper = max(batch, table)
    assert schema["c"].dataType.simpleString() == TYPES[deeper]
    fitted = fit_batch(incoming, stored.schema, compat)
    moved = migrate_table(stored, schema, compat)
    assert fitted.dtypes == moved.dtypes
    wrap, migrate = (BATCH, TABLE) if compat else (EVEN, EVEN)
    assert _values(fitted) == (wrap[batch, deeper] if batch < deeper else VALUES[batch])
    assert _values(moved) == (migrate[table, deeper] if table < deeper else VALUES[table])


@pytest.mark.parametrize("compat", [True, False])
@pytest.mark.parametrize("depth", [0, 1, 2])
def test_one_sided_columns(spark, depth, compat):
    ids = spark.createDataFrame([(1,)], "i int")
    other = _frame(spark, depth)
    fitted = fit_batch(ids, other.schema, compat)
    assert _values(fitted) == [[] if compat and depth else None]
    moved = migrate_table(ids, reconciled_schema(other.schema, ids.schema), compat)
    assert _values(moved) == [None]
    assert fitted.schema["c"].dataType.simpleString() == TYPES[depth]


def test_other_types_pass(spark):
    a = spark.createDataFrame([(1, 2)], "i int, c bigint")
    b = spark.createDataFrame([(1, "2")], "i int, c string")
    assert [x.action for x in plan_reconcile(a.schema, b.schema)] == ["keep", "keep"]
    assert fit_batch(a, b.schema).dtypes == a.dtypes


def test_column_order_is_the_tables(spark):
    a = spark.createDataFrame([(1, "n", "o")], "i int, new string, old string")
    b = spark.createDataFrame([("o", 1)], "old string, i int")
    assert fit_batch(a, b.schema).columns == ["old", "i", "new"]
