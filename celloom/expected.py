"""The results of ``celloom.queries`` in plain SQL on the tables, without any XML."""

_LINE = """
    line AS (
        SELECT concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey) AS recid,
               CAST(l_linenumber AS BIGINT) AS n, l_partkey AS part, l_suppkey AS supplier,
               l_returnflag, l_linestatus, l_quantity, l_shipdate
        FROM lineitem
    )"""

_DENSE = "array_to_string(list_transform(range(1, n + 1), lambda m: CAST(part + m AS VARCHAR)), ',')"
_SPARSE = """array_to_string(list_transform(range(1, n + n % 2),
    lambda m: CASE WHEN m % 2 = 1 THEN CAST(part + m AS VARCHAR) ELSE '~' END), ',')"""
_GROUP = "array_to_string(list_transform(range(1, n + 1), lambda s: CAST(part * 10 + s AS VARCHAR)), ',')"

_DAY = "CASE WHEN o_orderstatus <> 'P' THEN strftime(o_orderdate, '%Y%m%d') END"
_PRICE = "CAST(CAST(o_totalprice AS DECIMAL(18, 2)) AS VARCHAR)"

_WIDE_ORDERS = f"""
    SELECT CAST(o_custkey AS VARCHAR) AS customer, o_orderstatus AS status, {_PRICE} AS total_price,
           array_to_string(regexp_split_to_array(o_orderpriority, '[- ]+'), ',') AS priority,
           CAST(NULL AS VARCHAR) AS account_number, {_DAY} AS order_date,
           CAST(o_orderkey AS VARCHAR) AS recid
    FROM orders"""

_SOURCE = f"SELECT {_DAY} AS business_date, count(*) AS row_count FROM orders GROUP BY 1"
_TARGET = f"""
    SELECT {_DAY} AS business_date, count(*) AS row_count FROM orders
    WHERE EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey) GROUP BY 1"""


def _aligned(source: str, target: str) -> str:
    return f"""
    aligned AS (
        SELECT coalesce(s.business_date, t.business_date) AS business_date,
               CAST(coalesce(s.row_count, 0) AS BIGINT) AS source_rows,
               CAST(coalesce(t.row_count, 0) AS BIGINT) AS target_rows
        FROM ({source}) s FULL JOIN ({target}) t
          ON s.business_date IS NOT DISTINCT FROM t.business_date
    )"""


def _gaps(where: str) -> str:
    return f"""
    WITH {_aligned(_SOURCE, _TARGET)}
    SELECT business_date, source_rows, target_rows, source_rows - target_rows AS missing
    FROM aligned WHERE source_rows > target_rows {where}"""


_DATED = f"SELECT CAST(o_orderkey AS VARCHAR) AS recid, {_DAY} AS business_date FROM orders"

_TEXT = "CASE WHEN o_orderstatus <> 'P' THEN o_orderpriority END"

EXPECTED: dict[str, str] = {
    "xml_parse": f"""
        WITH {_LINE}
        SELECT recid,
               '~:~:' || part || ',2:~:' || supplier || ',' ||
               array_to_string(list_transform(range(1, n + 1),
                   lambda s: '3:' || s || ':' || (part * 10 + s)), ',') ||
               CASE WHEN l_returnflag = 'R' THEN ',4:~:' || part ELSE '' END AS c20,
               CAST(NULL AS VARCHAR) AS c0,
               CASE WHEN l_linestatus = 'F' THEN '~:~:~' END AS c50
        FROM line""",
    "wide_parse": _WIDE_ORDERS,
    "column_subset": f"""
        SELECT o_orderstatus AS status, {_DAY} AS order_date, CAST(o_orderkey AS VARCHAR) AS recid
        FROM orders""",
    "first_columns": f"""
        SELECT CAST(o_custkey AS VARCHAR) AS customer, o_orderstatus AS status, {_PRICE} AS total_price,
               CAST(o_orderkey AS VARCHAR) AS recid
        FROM orders""",
    "mv_fixed_group": f"""
        WITH {_LINE}
        SELECT recid, CAST(part AS VARCHAR) AS part, CAST(supplier AS VARCHAR) AS supplier,
               {_GROUP} AS group_values,
               CASE WHEN l_returnflag = 'R' THEN CAST(part AS VARCHAR) ELSE '' END AS returned_part,
               CASE WHEN l_linestatus = 'F' THEN '' END AS absent_group
        FROM line""",
    "mv_list": f"""
        WITH {_LINE}
        SELECT recid, {_DENSE} AS dense_list, {_SPARSE} AS sparse_list, {_DENSE} AS repeated_list,
               CAST(NULL AS VARCHAR) AS never_there
        FROM line""",
    "mv_two_level": f"""
        WITH {_LINE}
        SELECT recid, array_to_string(list_transform(range(1, n + 1),
                   lambda m: array_to_string(list_transform(range(1, 2 + (m + supplier) % 3),
                       lambda s: part || '.' || m || '.' || s), ',')), ';') AS nested_values
        FROM line""",
    "subvalue_detect": """
        SELECT DISTINCT 'c28' AS tag FROM lineitem, range(1, 8) r(m)
        WHERE m <= l_linenumber AND (m + l_suppkey) % 3 > 0""",
    "max_list_size": """
        SELECT CAST(1 AS INTEGER) AS part,
               CAST(max(l_linenumber) AS INTEGER) AS group_values,
               CAST(max(l_linenumber) AS INTEGER) AS dense_list,
               CAST(max(l_linenumber - 1 + l_linenumber % 2) AS INTEGER) AS sparse_list,
               CAST(max(l_linenumber) AS INTEGER) AS nested_values,
               CAST(NULL AS INTEGER) AS never_there
        FROM lineitem""",
    "normalize_arrays": f"""
        WITH {_LINE}
        SELECT recid, l_returnflag AS return_flag, CAST(part AS VARCHAR) AS part,
               CASE WHEN l_returnflag = 'R' THEN CAST(part AS VARCHAR) END AS returned_part,
               CAST(NULL AS VARCHAR) AS absent_group, CAST(supplier AS VARCHAR) AS explicit_first,
               CAST(NULL AS VARCHAR) AS never_there, {_GROUP} AS group_values, {_DENSE} AS dense_list
        FROM line""",
    "pinned_shapes": f"""
        WITH {_LINE}
        SELECT recid, CAST(supplier AS VARCHAR) AS explicit_first,
               replace({_DENSE}, ',', ';') AS dense_list
        FROM line""",
    "tag_census": """
        SELECT tag, tag IN ('c1', 'c20', 'c46', 'c0') AS mapped, count(*) AS row_count
        FROM (
            SELECT unnest(['c1', 'c8', 'c20', 'c28', 'c46', 'c47', 'c48', 'c49', 'c167']) AS tag FROM lineitem
            UNION ALL SELECT 'c50' FROM lineitem WHERE l_linestatus = 'F'
        )
        GROUP BY tag""",
    "corrupt_records": f"""
        SELECT CASE WHEN o_orderstatus <> 'O' THEN CAST(o_custkey AS VARCHAR) END AS customer,
               CASE WHEN o_orderstatus <> 'O' THEN {_DAY} END AS order_date,
               CAST(o_orderkey AS VARCHAR) AS recid,
               CASE WHEN o_orderstatus = 'O' THEN true END AS corrupt
        FROM orders""",
    "lookup_load": """
        SELECT 'c' || p_partkey AS field_index,
               CASE WHEN p_size % 2 = 0 THEN CAST(p_size AS BIGINT) END AS m_index,
               trim(p_name || ', ' || p_type) AS resolved_name_en
        FROM part WHERE lower(p_brand) = 'brand#11'""",
    "date_extract": _DATED,
    "window_filter": f"SELECT * FROM ({_DATED}) WHERE business_date BETWEEN '19960101' AND '19961231'",
    "count_by_date": _SOURCE,
    "count_outer_join": f"""
        WITH {_aligned(
            "SELECT strftime(o_orderdate, '%Y%m%d') AS business_date, count(*) AS row_count FROM orders GROUP BY 1",
            "SELECT strftime(l_shipdate, '%Y%m%d') AS business_date, count(*) AS row_count FROM lineitem GROUP BY 1",
        )}
        SELECT * FROM aligned""",
    "gap_check": _gaps(""),
    "gap_check_window": _gaps("AND business_date BETWEEN '19960101' AND '19961231'"),
    "gap_summary": f"""
        WITH {_aligned(_SOURCE, _TARGET)}
        SELECT 'orders' AS dataset, CAST(sum(source_rows) AS BIGINT) AS source_rows,
               count(*) FILTER (WHERE source_rows > 0) AS source_dates,
               CAST(sum(target_rows) AS BIGINT) AS target_rows,
               count(*) FILTER (WHERE target_rows > 0) AS target_dates,
               count(*) FILTER (WHERE source_rows > target_rows) AS gap_dates
        FROM aligned""",
    "gap_report": f"""
        WITH {_aligned(_SOURCE, _TARGET)},
        gap AS (
            SELECT row_number() OVER (ORDER BY business_date ASC NULLS LAST) AS position,
                   'orders ' || coalesce(nullif(business_date, ''), '(no date)') || ': oracle=' ||
                   source_rows || ' bronze=' || target_rows || ' (missing ' ||
                   (source_rows - target_rows) || ')' AS line
            FROM aligned WHERE source_rows > target_rows
        )
        SELECT position, line FROM gap WHERE position <= 50
        UNION ALL
        SELECT 51, '... and ' || (count(*) - 50) || ' more (see task log)' FROM gap HAVING count(*) > 50""",
    "gap_report_datasets": """
        WITH counted AS (
            SELECT 0 AS turn, 'lines' AS dataset, strftime(l_shipdate, '%Y%m%d') AS day,
                   count(*) AS source_rows, count(*) FILTER (WHERE l_returnflag <> 'R') AS target_rows
            FROM lineitem GROUP BY 3
            UNION ALL
            SELECT 1, 'orders', strftime(o_orderdate, '%Y%m%d'), count(*),
                   count(*) FILTER (WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem))
            FROM orders GROUP BY 3
        ),
        gap AS (
            SELECT row_number() OVER (ORDER BY turn, day) AS position,
                   dataset || ' ' || day || ': oracle=' || source_rows || ' bronze=' || target_rows ||
                   ' (missing ' || (source_rows - target_rows) || ')' AS line
            FROM counted WHERE day BETWEEN '19960101' AND '19960115' AND source_rows > target_rows
        )
        SELECT position, line FROM gap WHERE position <= 50
        UNION ALL
        SELECT 51, '... and ' || (count(*) - 50) || ' more (see task log)' FROM gap HAVING count(*) > 50""",
    "gap_ledger": """
        WITH target AS (
            SELECT CASE WHEN o_orderstatus = 'F' THEN strftime(CAST(o_orderdate AS DATE) + 1, '%Y%m%d')
                        WHEN o_orderstatus = 'O' THEN strftime(o_orderdate, '%Y%m%d') END AS day,
                   o_orderstatus AS status, CAST(o_orderkey AS VARCHAR) AS recid, o_custkey
            FROM orders
        ),
        sides AS (
            SELECT day, 1 AS s, 0 AS t,
                   CASE WHEN status = 'O' AND day LIKE '199603%' THEN 'X' || recid ELSE recid END AS recid
            FROM target WHERE o_custkey <> 1
            UNION ALL SELECT day, 0, 1, recid FROM target
        ),
        keyed AS (
            SELECT day, recid, sum(s) AS s, sum(t) AS t FROM sides GROUP BY day, recid
        )
        SELECT day AS business_date, CAST(sum(s) AS BIGINT) AS source_rows, CAST(sum(t) AS BIGINT) AS target_rows,
               CAST(sum(s) - sum(t) AS BIGINT) AS missing, bool_and(s = t) AS same_keys
        FROM keyed GROUP BY day HAVING NOT bool_and(s = t)""",
    "raw_landing": f"""
        SELECT recid, load_id, business_date
        FROM ({_DATED}), (VALUES ('20260101T000000'), ('20260102T000000')) loads(load_id)""",
    "reland_overwrite": """
        SELECT CAST(o_orderkey AS VARCHAR) AS recid, '20260101T000000' AS load_id
        FROM orders WHERE o_orderstatus = 'F'""",
    "landed_window": f"SELECT * FROM ({_DATED}) WHERE business_date BETWEEN '19960101' AND '19961231'",
    "hash_split": """
        SELECT CAST(o_orderkey AS VARCHAR) AS recid, count(*) AS row_count,
               CAST(16 AS BIGINT) AS filled_buckets
        FROM orders GROUP BY o_orderkey""",
    "merge_upsert": f"""
        WITH shipped AS (
            SELECT l_orderkey, strftime(max(l_shipdate), '%Y%m%d') AS ship_date
            FROM lineitem GROUP BY l_orderkey
        )
        SELECT CAST(o_orderkey AS VARCHAR) AS recid,
               CASE WHEN o_orderstatus = 'P' THEN 'P' WHEN l_orderkey IS NOT NULL THEN 'L'
                    ELSE o_orderstatus END AS status,
               CASE WHEN o_orderstatus = 'P' OR l_orderkey IS NULL THEN {_PRICE} END AS price,
               CASE WHEN o_orderstatus <> 'P' THEN ship_date END AS ship_date
        FROM orders LEFT JOIN shipped ON o_orderkey = l_orderkey
        UNION ALL
        SELECT CAST(l_orderkey AS VARCHAR), 'L', NULL, ship_date FROM shipped
        WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders)
        UNION ALL
        SELECT 'C' || c_custkey, c_mktsegment, NULL, NULL FROM customer""",
    "replace_load": """
        SELECT CAST(o_orderkey AS VARCHAR) AS recid,
               CAST(CASE WHEN o_orderstatus <> 'P' THEN 1 ELSE 0 END AS INTEGER) AS priority_size,
               CASE WHEN o_orderstatus <> 'P' THEN o_orderpriority ELSE '' END AS priority,
               CAST(0 AS INTEGER) AS words_size, CAST(NULL AS VARCHAR) AS status,
               strftime(o_orderdate, '%Y%m%d') AS order_date
        FROM orders""",
    "ingest_history": _WIDE_ORDERS,
    "windowed_history_merge": f"""
        SELECT CAST(o_orderkey AS VARCHAR) AS recid,
               CASE WHEN {_DAY} BETWEEN '19960101' AND '19961231' THEN lower(o_orderstatus)
                    ELSE o_orderstatus END AS status,
               {_DAY} AS order_date, CAST(o_custkey AS VARCHAR) AS customer
        FROM orders""",
    "reparse_landed": f"""
        SELECT CAST(o_orderkey AS VARCHAR) AS recid,
               CASE WHEN {_DAY} BETWEEN '19960101' AND '19961231' THEN lower(o_orderstatus)
                    ELSE o_orderstatus END AS status,
               {_DAY} AS order_date, array_to_string(regexp_split_to_array(o_orderpriority, '[- ]+'), ',') AS priority
        FROM orders""",
    "daily_merge": f"""
        SELECT CAST(o_orderkey AS VARCHAR) AS recid,
               CASE WHEN {_DAY} = '19960305' THEN lower(o_orderstatus) ELSE o_orderstatus END AS status,
               {_DAY} AS order_date, CAST(o_custkey AS VARCHAR) AS customer
        FROM orders""",
    "empty_batch": """
        SELECT CAST(o_orderkey AS VARCHAR) AS recid, CAST(0 AS BIGINT) AS second_rows, CAST(1 AS BIGINT) AS loads
        FROM orders""",
    "ingest_datasets": """
        SELECT 'orders' AS dataset, count(*) AS source_rows, count(*) AS target_rows, false AS failed FROM orders
        UNION ALL SELECT 'lines', count(*), count(*), false FROM lineitem
        UNION ALL SELECT 'broken', 0, NULL, true""",
    "reconcile_add_missing": f"""
        SELECT CAST(o_orderkey AS VARCHAR) AS recid,
               CASE WHEN o_orderstatus = 'F' THEN {_TEXT} END AS old_text,
               CASE WHEN o_orderstatus <> 'F' THEN {_TEXT} END AS new_text,
               CAST(CASE WHEN o_orderstatus = 'F' THEN len(string_split(o_orderpriority, '-'))
                         ELSE 0 END AS INTEGER) AS old_size,
               CAST(CASE WHEN o_orderstatus IN ('F', 'P') THEN -1
                         ELSE len(string_split(o_orderpriority, '-')) END AS INTEGER) AS new_size
        FROM orders""",
    "reconcile_widen_table": """
        SELECT CAST(o_orderkey AS VARCHAR) AS recid,
               CASE WHEN o_orderstatus = 'P' THEN '[[~]]' ELSE '[[' || o_orderpriority || ']]' END AS c0,
               CASE WHEN o_orderstatus = 'P' THEN '[~]'
                    ELSE '[[' || replace(o_orderpriority, '-', ',') || ']]' END AS c1,
               CASE WHEN o_orderstatus = 'P' THEN '[[~]]' ELSE '[[' || o_orderpriority || ']]' END AS c2
        FROM orders""",
    "reconcile_wrap_df": """
        SELECT CAST(o_orderkey AS VARCHAR) AS recid,
               CASE WHEN o_orderstatus = 'P' THEN 'null' ELSE '[[' || o_orderpriority || ']]' END AS c0,
               CASE WHEN o_orderstatus = 'P' THEN 'null'
                    ELSE '[[' || replace(o_orderpriority, '-', '],[') || ']]' END AS c1,
               CASE WHEN o_orderstatus = 'P' THEN '[[]]' ELSE '[[' || o_orderpriority || ']]' END AS c2
        FROM orders""",
    "file_stats": """
        SELECT CAST(0 AS BIGINT) AS files_missed, CAST(0 AS BIGINT) AS delete_files,
               count(*) + count(*) FILTER (WHERE o_orderstatus = 'F') AS stored_records,
               count(*) AS live_rows, true AS has_bytes
        FROM orders""",
    "conditional_aggs": """
        SELECT count(*) FILTER (WHERE l_returnflag <> 'R') AS data_files,
               count(*) FILTER (WHERE l_returnflag = 'R') AS delete_files,
               CAST(sum(l_partkey) AS BIGINT) AS bytes,
               CAST(sum(CAST(trunc(l_quantity) AS BIGINT)) FILTER (WHERE l_returnflag <> 'R') AS BIGINT)
                   AS stored_records
        FROM lineitem""",
    "compact_preserves_rows": f"""
        SELECT CAST(o_orderkey AS VARCHAR) AS recid,
               CASE WHEN o_orderstatus = 'F' THEN 'merged' ELSE o_orderstatus END AS status,
               {_PRICE} AS price, true AS fewer_files
        FROM orders""",
    "compact_to_size": """
        SELECT concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey) AS recid, l_returnflag AS flag,
               sha256(concat_ws('-', l_orderkey, l_linenumber)) AS digest,
               true AS none_above, true AS none_small, true AS settled
        FROM lineitem""",
    "merge_keyless": f"""
        SELECT recid, status, price, count(*) * CASE WHEN recid IS NULL THEN 2 ELSE 1 END AS row_count
        FROM (
            SELECT CASE WHEN o_orderstatus = 'F' THEN CAST(o_orderkey AS VARCHAR) END AS recid,
                   o_orderstatus AS status, {_PRICE} AS price
            FROM orders
        )
        GROUP BY recid, status, price""",
    "maintenance_run": """
        SELECT 'bronze/orders_wide' AS name, false AS dry, true AS published,
               count(*) + count(*) FILTER (WHERE o_orderstatus = 'F') AS stored_before,
               count(*) AS stored_after, count(*) AS live_rows
        FROM orders
        UNION ALL
        SELECT 'silver/customer_wide', false, true,
               count(*) + count(*) FILTER (WHERE c_mktsegment = 'BUILDING'), count(*), count(*)
        FROM customer""",
    "next_key": """
        SELECT CAST(coalesce(max(o_orderkey) + 1, 100) AS BIGINT) AS next_key
        FROM orders WHERE o_orderkey >= 100""",
    "generate_rows": """
        SELECT CAST(9000000001 + o_orderkey AS VARCHAR) AS recid,
               CAST(9000000001 + o_orderkey AS VARCHAR) AS xml_id,
               strftime(DATE '2026-01-15' + CAST(o_orderkey % 30 AS INTEGER), '%Y%m%d') AS business_date,
               CAST(2 AS INTEGER) AS dates
        FROM orders""",
}
