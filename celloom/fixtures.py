"""Relational rows rendered as multi-value XML records, each from one row alone.

No grouping is involved: a record is as large as its row makes it, and
rendering is a projection.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from celloom.model import LookupRow


def escape(value: Column) -> Column:
    text = value.cast("string")
    for raw, entity in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;")):
        text = F.replace(text, F.lit(raw), F.lit(entity))
    return text


def cell(
    tag: str, value: Column, m: Column | int | None = None, s: Column | int | None = None, number: bool = False
) -> Column:
    """``<tag m=".." s="..">value</tag>``; a NULL value renders nothing. A ``number``, or other text of the code's own, has nothing to escape."""
    opening = [f"<{tag}"]
    for name, position in (("m", m), ("s", s)):
        if isinstance(position, int):
            opening[-1] += f' {name}="{position}"'
        elif position is not None:
            opening[-1] += f' {name}="'
            opening += [position.cast("string"), '"']
    opening[-1] += ">"
    parts = [F.lit(p) if isinstance(p, str) else p for p in opening]
    text = value.cast("string") if number else escape(value)
    return F.coalesce(F.concat(*parts, text, F.lit(f"</{tag}>")), F.lit(""))


def cells(positions: Column, render) -> Column:
    return F.array_join(F.transform(positions, render), "")


#: So many cells of a record are rendered one by one.
FEW = 8


def counted_cells(n: Column, render, step: int = 1) -> Column:
    """The cells of positions 1, 1 + step, ... up to ``n``: few without a loop, which is not compiled, others by one."""
    few = F.concat(*[F.when(n >= k, render(k)).otherwise("") for k in range(1, FEW + 1, step)])
    by = [F.lit(step)] if step > 1 else []
    return F.when(n.between(1, FEW), few).otherwise(cells(F.sequence(F.lit(1), n, *by), render))


def record(key: Column, *content: Column) -> Column:
    return F.concat(F.lit('<row id="'), key, F.lit('">'), *content, F.lit("</row>"))


def day_text(timestamp: str) -> Column:
    return F.date_format(F.to_date(timestamp), "yyyyMMdd")


def amount_text(name: str) -> Column:
    return F.col(name).cast("decimal(18,2)").cast("string")


ORDER_LOOKUP = [
    LookupRow("c1", None, "customer"),
    LookupRow("c8", None, "status"),
    LookupRow("c23", None, "total_price"),
    LookupRow("c46", None, "priority"),
    LookupRow("c0", None, "account_number"),
    LookupRow("c167", None, "order_date"),
]


def order_records(orders: DataFrame) -> DataFrame:
    """(recid, XMLRECORD) per order. Orders of status P carry no date tag."""
    key = F.col("o_orderkey").cast("string")
    words = F.split("o_orderpriority", "[- ]+")
    return orders.select(
        key.alias("recid"),
        record(
            key,
            cell("c1", F.col("o_custkey"), number=True),
            cell("c8", F.col("o_orderstatus")),
            cell("c23", amount_text("o_totalprice"), number=True),
            cells(
                F.sequence(F.lit(1), F.size(words)),
                lambda m: cell("c46", F.get(words, m - 1), m),
            ),
            cell("c167", F.when(F.col("o_orderstatus") != "P", day_text("o_orderdate")), number=True),
        ).alias("XMLRECORD"),
    )


LINE_LOOKUP = [
    LookupRow("c1", None, "return_flag"),
    LookupRow("c167", None, "ship_date"),
    LookupRow("c8", None, "quantity"),
    LookupRow("c20", 1, "part"),
    LookupRow("c20", 2, "supplier"),
    LookupRow("c20", 3, "group_values"),
    LookupRow("c20", 4, "returned_part"),
    LookupRow("c50", 2, "absent_group"),
    LookupRow("c46", None, "dense_list"),
    LookupRow("c47", None, "sparse_list"),
    LookupRow("c48", None, "repeated_list"),
    LookupRow("c28", None, "nested_values"),
    LookupRow("c49", None, "explicit_first"),
    LookupRow("c0", None, "never_there"),
]


def line_records(lineitem: DataFrame) -> DataFrame:
    """(recid, XMLRECORD) per line, as many values as its line number says.

    c46 runs 1..n, c47 has odd positions only, c48 has every position twice,
    c28 has sub-values, c20 is one tag with a meaning per group, c50 is there
    for line status F only.
    """
    key = F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    n, part, supplier = F.col("l_linenumber"), F.col("l_partkey"), F.col("l_suppkey")

    stem = F.coalesce(F.concat(part.cast("string"), F.lit(".")), F.lit(""))

    def nested(m: Column | int) -> Column:
        # one to three sub-values, one by one: a loop in a loop costs several times as much
        more = F.pmod(m + supplier, F.lit(3))

        def nth(s: int) -> Column:
            rest = F.lit(f"{m}.{s}") if isinstance(m, int) else F.concat(m.cast("string"), F.lit(f".{s}"))
            text = F.concat(stem, rest)
            return F.when(more >= s - 1, cell("c28", text, m, s, number=True)).otherwise("")

        return F.concat(nth(1), nth(2), nth(3))

    return lineitem.select(
        key.alias("recid"),
        record(
            key,
            cell("c1", F.col("l_returnflag")),
            cell("c8", amount_text("l_quantity"), number=True),
            cell("c20", part, number=True),
            cell("c20", supplier, 2, number=True),
            counted_cells(n, lambda s: cell("c20", part * 10 + s, 3, s, number=True)),
            cell("c20", F.when(F.col("l_returnflag") == "R", part), 4, number=True),
            counted_cells(n, nested),
            counted_cells(n, lambda m: cell("c46", part + m, m, number=True)),
            counted_cells(n, lambda m: cell("c47", part + m, m, number=True), 2),
            counted_cells(
                n,
                lambda m: F.concat(cell("c48", part + m, m, number=True), cell("c48", F.lit("later"), m, number=True)),
            ),
            cell("c49", supplier, 1, number=True),
            F.when(F.col("l_linestatus") == "F", F.lit("<c50/>")).otherwise(""),
            cell("c167", day_text("l_shipdate"), number=True),
        ).alias("XMLRECORD"),
    )


# The tags that repeat, how often, and their columns' places.
REPEATS = {46: 9, 47: 23, 48: 23, 49: 23, 50: 23, 99: 3, 100: 2, 249: 2, 250: 2}
PLACES = {100: 19, 99: 20, 46: 29, 47: 30, 250: 54, 48: 180, 50: 181, 49: 182, 249: 221}


def _wide_lookup() -> list[LookupRow]:
    """289 columns: 34 groups of c20 and 255 other tags, in a mixed order, repeated ones at their places."""
    rows = []
    for i in range(289):
        k = i * 97 % 289
        if k < 34:
            rows.append(LookupRow("c20", k + 1, f"group_{k + 1}"))
        else:
            tag = k - 33 if k - 33 < 20 else k - 32
            if tag not in PLACES:
                rows.append(LookupRow(f"c{tag}", None, f"column_{tag}"))
    for tag, place in sorted(PLACES.items(), key=lambda p: p[1]):
        rows.insert(place, LookupRow(f"c{tag}", None, f"column_{tag}"))
    return rows


WIDE_LOOKUP = _wide_lookup()


def _wide_tags() -> list[tuple[str, int | None]]:
    """Tag and m of every element of a wide record."""
    single = [(f"c{t}", None) for t in range(1, 254, 5) if t not in REPEATS and t != 20]
    groups = [("c20", m) for m in (1, 2, 3, 4)]
    return single + groups + [(f"c{t}", m) for t, n in REPEATS.items() for m in range(1, n + 1)]


def populated(rows: list[LookupRow]) -> int:
    """Elements of a wide record that some lookup rows take."""
    lists = {r.tag for r in rows if r.m_index is None}
    cells = {(r.tag, r.m_index) for r in rows if r.m_index is not None}
    return sum(tag in lists or (tag, m) in cells for tag, m in _wide_tags())


def wide_records(rows: DataFrame, key: str, value: str) -> DataFrame:
    """(recid, XMLRECORD): about 165 elements under 60 of the tags of WIDE_LOOKUP."""
    places = F.array(
        *[
            F.struct(
                F.lit(f"<{tag}" + ("" if m is None else f' m="{m}"') + ">").alias("open"),
                F.lit(f".{tag[1:]}.{m or 1}</{tag}>").alias("rest"),
            )
            for tag, m in _wide_tags()
        ]
    )
    # one expression for all elements, not one each: the code that Spark makes stays small
    rendered = rows.select(F.col(key).cast("string").alias("recid"), escape(F.col(value)).alias("text"), places.alias("places"))
    content = cells(F.col("places"), lambda p: F.concat(p["open"], F.col("text"), p["rest"]))
    return rendered.select("recid", record(F.col("recid"), content, F.lit('<c20 m="32"></c20>')).alias("XMLRECORD"))
