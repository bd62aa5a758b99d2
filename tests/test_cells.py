"""Edge cases of the cell model, and shapes against the plain way to find them."""

import random

import pytest
from pyspark.sql import functions as F

from celloom.functions import cells as C
from celloom.functions.xml import business_date, cell_schema, parse_xml
from celloom.model import LookupRow
from celloom.operators import shapes as S
from celloom.operators.parsing import corrupt_rows, parse_config, parse_wide, with_cells

EDGE = [
    (
        "e1",
        '<row><c1>a</c1><c1 m="3">b</c1><c2 m="2" s="2">q</c2><c2>p</c2><c3/>'
        '<c4>first</c4><c4>second</c4><c6 m="0">z</c6></row>',
    ),
    ("e2", '<row><c1>only</c1><c2 m="1" s="3">t</c2></row>'),
    ("e3", "<row><c1>bad"),
    ("e4", None),
    ("e5", '<row id="10"><c1 m="x">v</c1></row>'),
    ("e6", "<row/>"),
    ("e7", "<row><c1>a<b>n</b></c1></row>"),
]


@pytest.fixture(scope="module")
def edge(spark):
    return spark.createDataFrame(EDGE, "recid string, XMLRECORD string")


def _one(df, recid, column):
    parsed = df.withColumn("p", parse_xml("XMLRECORD", cell_schema(f"c{i}" for i in range(1, 7))))
    return parsed.where(F.col("recid") == recid).select(F.expr(column)).first()[0]


def c(tag):
    return f"p.{tag}"


@pytest.mark.parametrize(
    ("recid", "column", "want"),
    [
        ("e1", lambda: C.group_list(c("c1"), 1), ["a"]),
        ("e1", lambda: C.group_list(c("c1"), 2), []),
        ("e1", lambda: C.group_list(c("c1"), 3), ["b"]),
        ("e1", lambda: C.group_list(c("c5"), 1), None),
        ("e1", lambda: C.group_list(c("c2"), 1), ["p"]),
        ("e1", lambda: C.value_list(c("c1")), ["a", None, "b"]),
        ("e1", lambda: C.nested_list(c("c2")), [["p"], [None, "q"]]),
        ("e1", lambda: C.value_list(c("c3")), [None]),
        ("e1", lambda: C.value_list(c("c4")), ["first"]),
        ("e1", lambda: C.value_list(c("c6")), [None, "z"]),
        ("e1", lambda: C.value_scalar(c("c6")), None),
        ("e1", lambda: C.value_scalar(c("c4")), "first"),
        ("e1", lambda: C.group_scalar(c("c1"), 3), "b"),
        ("e1", lambda: C.nested_list(c("c1")), [["a"], [None], ["b"]]),
        ("e2", lambda: C.group_list(c("c1"), 1), ["only"]),
        ("e2", lambda: C.group_list(c("c1"), 2), []),
        ("e2", lambda: C.group_list(c("c2"), 1), [None, None, "t"]),
        ("e2", lambda: C.group_scalar(c("c2"), 1), None),
        ("e2", lambda: C.nested_list(c("c2")), [[None, None, "t"]]),
        ("e2", lambda: C.value_list(c("c3")), None),
        ("e3", lambda: C.value_list(c("c1")), None),
        ("e4", lambda: C.value_list(c("c1")), None),
        ("e5", lambda: C.value_list(c("c1")), None),
        ("e6", lambda: C.value_list(c("c1")), None),
        ("e7", lambda: C.value_list(c("c1")), ["a"]),
    ],
)
def test_edge_cells(edge, recid, column, want):
    assert _one(edge, recid, column()) == want


def test_empty_cell_list(spark):
    df = spark.range(1).select(F.array().cast(C.CELLS).alias("cells"))
    got = df.selectExpr(C.group_list("cells", 1), C.value_list("cells"), C.nested_list("cells")).first()
    assert tuple(got) == ([], [], [])


def test_sub_value_detection(edge):
    rows = [LookupRow(f"c{i}", None, f"n{i}") for i in range(1, 7)]
    for ids, want in ((["e1", "e2"], {"c2"}), (["e6"], set()), ([], set())):
        df = with_cells(edge.where(F.col("recid").isin(ids) if ids else F.lit(False)), rows)
        assert S.sub_value_tags(df, rows, "_parsed") == want


def test_corrupt_rows_are_counted_and_failfast_raises(edge):
    rows = [LookupRow("c1", None, "n1")]
    assert {r["recid"] for r in corrupt_rows(edge, rows).collect()} == {"e3", "e5"}
    strict = parse_xml("XMLRECORD", cell_schema(["c1"]), options={"mode": "FAILFAST"})
    with pytest.raises(Exception, match="MALFORMED_RECORD_IN_PARSING"):
        edge.where("recid = 'e3'").select(strict).collect()


def test_every_row_is_kept(edge):
    rows = [LookupRow("c1", None, "n1"), LookupRow("c2", None, "n2")]
    wide = parse_wide(edge, rows)
    assert wide.count() == len(EDGE)
    assert dict(wide.dtypes) == {"n1": "array<string>", "n2": "array<array<string>>", "recid": "string"}


def test_business_date(spark):
    xml = ["<row><c9>20260101</c9><c9>x</c9></row>", "<row><c9/></row>", "<row/>", "<row><c9>2", None]
    df = spark.createDataFrame([(x,) for x in xml], "x string").coalesce(1)
    got = [r[0] for r in df.select(business_date("x", "c9")).collect()]
    assert got == ["20260101", None, None, None, None]


def test_whole_text_survives(spark):
    texts = ["a & b < c > d", "  padded  ", "línea\ntwo", "x" * 100_000, "]]>"]
    from celloom.fixtures import cell, record

    df = spark.createDataFrame([(str(i), t) for i, t in enumerate(texts)], "k string, t string")
    xml = df.select(F.col("k").alias("recid"), record(F.col("k"), cell("c1", F.col("t"))).alias("XMLRECORD"))
    got = parse_wide(xml, [LookupRow("c1", None, "t")]).collect()
    assert {r["recid"]: r["t"] for r in got} == {str(i): t.strip() for i, t in enumerate(texts)}


def test_parse_config(spark):
    columns, schemas = parse_config([LookupRow("c1", 1, "a"), LookupRow("c1", 2, "b"), LookupRow("c2", None, "c")])
    assert columns == []
    assert schemas["XMLRECORD"].fieldNames() == ["c1", "c2"]


# --- the profile -----------------------------------------------------------


def _random_record(rng, tags):
    out = []
    for tag in tags:
        plural, sub = tags[tag]
        for _ in range(rng.choice([0, 1, 1, 2, 4])):
            attributes = []
            if rng.random() < 0.7:
                m = rng.choice([0, 1, 1, 2, 3, 7]) if plural else 1
                attributes.append(
                    rng.choice(['m="{}"', "m='{}'", 'm = "{}"', '\n m="0{}"', 'M="{}"']).format(m)
                )
            if rng.random() < 0.5:
                s = rng.choice([0, 1, 2, 3]) if sub else 1
                attributes.append(f's="{s}"')
            if rng.random() < 0.2:
                attributes.append(rng.choice(['x="a>b"', 'note=" m = 5 "', 'ms="2"']))
            rng.shuffle(attributes)
            value = rng.choice(["v", "", " m=3 s='2' ", "<!-- <c1 m='9'> -->", "<![CDATA[<c2 s='8'>]]>"])
            name = tag.upper() if rng.random() < 0.1 else tag
            out.append(f"<{name}{''.join(' ' + a for a in attributes)}>{value}{rng.randint(0, 9)}</{name}>")
    rng.shuffle(out)
    return "<row>" + "".join(out) + "</row>"


def _plain_pass(df, rows):
    """Detection over a full parse, lists built, list sizes measured, lists flattened."""
    parsed = with_cells(df, rows)
    sub = S.sub_value_tags(parsed, rows, "_parsed")
    shapes = {r.name: S.NESTED if r.m_index is None and r.tag in sub else S.LIST for r in rows}
    lists = parse_wide(df, rows, shapes=shapes, normalize=False)
    return lists, S.normalize_arrays(lists)


def _sorted(df):
    return sorted((r.asDict(recursive=True) for r in df.collect()), key=lambda r: r["recid"])


@pytest.mark.parametrize("seed", range(6))
def test_profile_equals_plain_passes(spark, seed, monkeypatch):
    """Also with a pilot that sees one row only, so that the rest decides."""
    rng = random.Random(seed)
    monkeypatch.setattr(S, "PILOT_ROWS", rng.choice([1, 1000]))
    tags = {f"c{i}": (rng.random() < 0.5, rng.random() < 0.4) for i in range(1, 9)}
    rows = [LookupRow(t, None, f"n_{t}") for t in tags if t != "c3"]
    rows += [LookupRow("c3", m, f"n_c3_{m}") for m in (1, 2, 3)] + [LookupRow("c99", None, "absent")]
    records = [(str(i), _random_record(rng, tags)) for i in range(rng.choice([1, 3, 40]))]
    records += [("bad", '<row><c1 m="4"'), ("null", None)]
    df = spark.createDataFrame(records, "recid string, XMLRECORD string")
    lists, normalized = _plain_pass(df, rows)
    for fused, plain in (
        (parse_wide(df, rows, normalize=False), lists),
        (parse_wide(df, rows), normalized),
    ):
        assert fused.dtypes == plain.dtypes
        assert _sorted(fused) == _sorted(plain)


def test_attributes_from_a_document_type_do_not_count(spark):
    """Defaults declared inside a record would escape the text search; the parser ignores them."""
    xml = '<!DOCTYPE row [<!ATTLIST c1 m CDATA "2">]><row><c1>a</c1></row>'
    df = spark.createDataFrame([("1", xml)], "recid string, XMLRECORD string")
    cells = df.select(parse_xml("XMLRECORD", cell_schema(["c1"]))["c1"]).first()[0]
    assert cells is None or [x["_m"] for x in cells] == [None]


@pytest.mark.parametrize(
    ("xml", "want"),
    [
        ("<row><C1 M='2'>x</C1></row>", "array<string>"),
        ("<row><c1>x<_m>2</_m></c1></row>", "array<string>"),
        ("<row><c1><_S>2</_S></c1></row>", "array<array<string>>"),
        ("<row><c1 m='&#50;'>x</c1></row>", "array<string>"),
        ("<row><g><c1 m='2'>x</c1></g><c1>y</c1></row>", "string"),
        ("<row><c1 n:m='2'>x</c1></row>", "string"),
        ("<row><!-- <c1 m='2'>x</c1> --><c1 m='01'>y</c1></row>", "string"),
    ],
)
def test_positions_written_in_other_ways(spark, xml, want):
    """Seen in one record among many, behind the pilot."""
    plain = [(str(i), "<row><c1>a</c1></row>") for i in range(500)]
    df = spark.createDataFrame([*plain, ("x", xml)], "recid string, XMLRECORD string")
    rows = [LookupRow("c1", None, "n")]
    assert dict(parse_wide(df, rows).dtypes)["n"] == want
    assert _plain_pass(df, rows)[1].dtypes == parse_wide(df, rows).dtypes


def test_normalize_without_arrays(spark):
    df = spark.range(1)
    assert S.normalize_arrays(df) is df


@pytest.mark.parametrize("names", [["dense_list"], ["nested_values"], ["part", "returned_part"], None])
def test_each_record_is_parsed_once(spark, data, names):
    """With the chosen tags only, and with no column of the file read but two."""
    from celloom import fixtures as X
    from celloom.model import named_columns
    from celloom.sources.landing import land_raw, read_landed
    from celloom.workspace import new_folder

    path = new_folder(spark, "once")
    land_raw(X.line_records(spark.read.parquet(f"{data}/lineitem.parquet")), path)
    rows = X.LINE_LOOKUP if names is None else named_columns(X.LINE_LOOKUP, names)
    shapes = {r.name: S.LIST if r.m_index is not None else S.NESTED for r in rows}
    plan = parse_wide(read_landed(spark, path), rows, shapes=shapes)._jdf.queryExecution()
    physical = plan.executedPlan().toString()
    assert physical.count("from_xml(") == 1
    assert "Exchange" not in physical
    assert "ReadSchema: struct<recid:string,XMLRECORD:string>" in physical
    assert physical.count("StructField(c") == len({r.tag for r in rows})
