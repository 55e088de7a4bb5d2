"""DuckDB SQL for the registered queries, written from the semantics, not from the Spark code."""

from __future__ import annotations

from checks.feeds import (
    CLEAN,
    CUTS,
    DIRTY,
    EVENTS,
    LATE_LINE,
    LINEITEM_COLUMNS,
    ORDERS,
    lineitem_fields,
    select_list,
)

FLOOR = "TIMESTAMP '1940-12-25 05:30:00'"


def feed_sql(fields: dict[str, str], source: str) -> str:
    return f"SELECT {', '.join(select_list(fields))} FROM {source}"


def latest_sql(rows: str, keys: str, ties: str = "", delete: str = "operation_flag = 'D'") -> str:
    tie = f", {ties}" if ties else ""
    return (
        f"SELECT * FROM ({rows}) QUALIFY row_number() OVER (PARTITION BY {keys} ORDER BY "
        f"recordstamp DESC NULLS LAST, CASE WHEN {delete} THEN 'ZZ' ELSE operation_flag END "
        f"DESC NULLS LAST{tie}) = 1"
    )


LINE_TIES = "n DESC, p DESC, q DESC"


def line_feed(flag: str = CLEAN) -> str:
    return feed_sql(lineitem_fields(flag), "lineitem")


def line_state(flag: str = CLEAN, columns: str = "k, n, p, q, quantity, price") -> str:
    latest = latest_sql(line_feed(flag), "k", LINE_TIES)
    return f"SELECT {columns} FROM ({latest}) WHERE coalesce(operation_flag, 'I') <> 'D'"


def fold_sql(flag: str, late: bool = False, batches=range(len(CUTS)), first: str = "feed") -> str:
    """The merge applied batch after batch, as a chain of table expressions."""
    names = ", ".join(LINEITEM_COLUMNS)
    steps = [
        f"feed AS MATERIALIZED ({line_feed(flag)})",
        f"t0 AS (SELECT {names} FROM feed WHERE false)",
    ]
    for i, batch in enumerate(batches, 1):
        arrived = "true"
        if CUTS[batch]:
            arrived = f"recordstamp < TIMESTAMP '{CUTS[batch]}'"
            if late:
                arrived += f" AND n <> {LATE_LINE}"
        fresh = (
            f"SELECT * FROM {first if i == 1 else 'feed'} WHERE {arrived} AND k IS NOT NULL AND recordstamp >= "
            f"(SELECT coalesce(max(recordstamp), {FLOOR}) FROM t{i - 1})"
        )
        s, t = f"s{i}", f"t{i - 1}"
        mine = ", ".join(f"{t}.{c}" for c in LINEITEM_COLUMNS)
        steps.append(f"{s} AS MATERIALIZED ({latest_sql(fresh, 'k', LINE_TIES)})")
        steps.append(
            f"t{i} AS MATERIALIZED ("
            f"SELECT {mine} FROM {t} LEFT JOIN {s} ON {t}.k = {s}.k WHERE {s}.k IS NULL "
            f"OR {s}.operation_flag IS NULL OR {s}.operation_flag NOT IN ('D', 'I', 'U', 'L') "
            f"UNION ALL SELECT {names} FROM {s} WHERE coalesce(operation_flag, 'I') <> 'D' "
            f"AND NOT EXISTS (SELECT 1 FROM {t} WHERE {t}.k = {s}.k) "
            f"UNION ALL SELECT {names} FROM {s} WHERE operation_flag IN ('I', 'U', 'L') "
            f"AND EXISTS (SELECT 1 FROM {t} WHERE {t}.k = {s}.k))"
        )
    return f"WITH {', '.join(steps)} SELECT {names} FROM t{len(batches)}"


DICTIONARY = """
SELECT concat('/', l_returnflag, '/', l_linestatus, '/T', CAST(l_suppkey AS VARCHAR)) AS tabname,
       CASE WHEN l_linenumber = 7 THEN '.INCLUDE' WHEN l_linenumber = 6 THEN NULL
            WHEN l_linenumber = 5 THEN concat('/NS/F', CAST(l_partkey AS VARCHAR))
            ELSE concat('F', CAST(l_partkey AS VARCHAR)) END AS fieldname,
       CASE WHEN l_discount >= 0.05 THEN 'X' ELSE '' END AS keyflag,
       l_linenumber AS position
FROM lineitem
"""


def normal(name: str) -> str:
    return (
        f"replace(CASE WHEN {name} LIKE '/%' THEN substr({name}, 2) ELSE {name} END, '/', '_')"
    )


SALES = """
SELECT r_name AS region, count(*) AS orders,
       CAST(sum(CAST(o_totalprice AS DECIMAL(18, 2))) AS DOUBLE) AS total
FROM orders JOIN customer ON o_custkey = c_custkey
JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
GROUP BY r_name
"""
BY_STATUS = """
SELECT o_orderstatus AS status, count(*) AS orders,
       CAST(sum(CAST(o_totalprice AS DECIMAL(18, 2))) AS DOUBLE) AS total
FROM orders GROUP BY o_orderstatus
"""


def bucket_counts(column: str, source: str, grain: str) -> str:
    return (
        f"SELECT CAST(date_trunc('{grain}', {column}) AS TIMESTAMP) AS bucket, "
        f"count(*) AS row_count FROM {source} GROUP BY 1"
    )


def stored_counts(column: str, source: str, fmt: str) -> str:
    return (
        f"SELECT strftime({column}, '{fmt}') AS tm_part, count(*) AS row_count "
        f"FROM {source} GROUP BY 1"
    )


def oracles() -> dict[str, str]:
    dirty = line_feed(DIRTY)
    events = feed_sql(EVENTS, "events")
    orders = feed_sql(ORDERS, "orders")
    names = ", ".join(LINEITEM_COLUMNS)
    orders_state = latest_sql(orders, "custkey", "orderkey DESC")
    events_state = latest_sql(events, "user_id")
    live = "coalesce(operation_flag, 'I') <> 'D'"
    yearly = {
        **lineitem_fields(DIRTY),
        "recordstamp": "CAST(date_trunc('year', l_shipdate) AS TIMESTAMP)",
        "shipped": "l_shipdate",
    }
    drop = "operation_flag = 'D' OR is_deleted"
    bucket = (
        "CASE WHEN p_size >= 5 AND p_size < 45 "
        "THEN 5 + 10 * CAST(floor((p_size - 5) / 10.0) AS BIGINT) END"
    )
    return {
        "current_state_lineitem": line_state(),
        "current_state_dirty_flags": line_state(DIRTY),
        "current_state_by_aggregate": line_state(DIRTY),
        "current_state_events": (
            f"SELECT event_id, user_id, value, props FROM ({events_state}) WHERE {live}"),
        "current_state_delete_when": (
            "SELECT k, n, p, q, quantity, price FROM ("
            + latest_sql(line_feed(), "k", LINE_TIES, drop)
            + f") WHERE {live} AND NOT is_deleted"),
        "runtime_view": line_state(DIRTY),
        "latest_per_key_ties": latest_sql(
            feed_sql(yearly, "lineitem"), "k", "n DESC, p DESC, q DESC, shipped DESC"),
        "flag_rank_order": (
            "SELECT operation_flag, CASE WHEN operation_flag = 'D' THEN 'ZZ' ELSE operation_flag "
            f"END AS flag_rank, count(*) AS row_count FROM ({dirty}) GROUP BY 1, 2"),
        "cdc_projection": f"SELECT {names} FROM ({dirty})",
        "view_projection": f"SELECT k, n, p, q, quantity, price FROM ({dirty})",
        "keys_not_null": (
            f"SELECT * FROM (SELECT * REPLACE (nullif(n, 3) AS n) FROM ({dirty})) "
            "WHERE k IS NOT NULL AND n IS NOT NULL"),
        "not_deleted": f"SELECT * FROM ({dirty}) WHERE {live}",
        "watermark": f"SELECT coalesce(max(recordstamp), {FLOOR}) AS watermark FROM ({dirty})",
        "watermark_empty_target": (
            f"SELECT coalesce(max(recordstamp), {FLOOR}) AS watermark FROM ({dirty}) "
            "WHERE quantity < 0"),
        "new_records": (
            f"SELECT * FROM ({dirty}) WHERE recordstamp >= (SELECT coalesce(max(recordstamp), "
            f"{FLOOR}) FROM ({line_state(DIRTY, names)}) WHERE recordstamp < '2000-01-01')"),
        "initial_population": fold_sql(DIRTY, batches=[len(CUTS) - 1]),
        "merge_one_batch": fold_sql(CLEAN, batches=[0, len(CUTS) - 1]),
        "merge_three_batches": fold_sql(CLEAN),
        "merge_three_batches_partitioned": fold_sql(CLEAN),
        "merge_null_and_unknown_flags": fold_sql(DIRTY),
        "merge_fold_outer": fold_sql(DIRTY),
        "merge_fold_anti": fold_sql(DIRTY),
        "merge_late_rows_dropped": fold_sql(CLEAN, late=True),
        "merge_late_rows_compared": line_state(CLEAN, names),
        "merge_three_batches_bucketed": fold_sql(CLEAN),
        "merge_dirty_flags_bucketed": fold_sql(DIRTY),
        "merge_three_batches_filtered": fold_sql(CLEAN),
        "merge_added_column": fold_sql(
            CLEAN, batches=[0, len(CUTS) - 1],
            first="(SELECT * REPLACE (CAST(NULL AS DOUBLE) AS price) FROM feed)"),
        "current_state_on_read": line_state(),
        "merge_on_read_dirty_flags": fold_sql(DIRTY),
        "stream_merge_final_state": line_state(CLEAN, names),
        "stream_dirty_flags": line_state(DIRTY, names),
        "stream_merge_compared": line_state(CLEAN, names),
        "stream_buried_tombstones": (
            f"WITH l AS ({latest_sql(line_feed(), 'k', LINE_TIES)}) "
            "SELECT operation_flag = 'D' AS deleted, count(*) AS row_count FROM l "
            "WHERE operation_flag <> 'D' OR recordstamp >= (SELECT max(recordstamp) FROM l) "
            "- INTERVAL 365 DAY GROUP BY 1"),
        "scan_feed_stream": dirty,
        "multi_stream_run": (
            f"SELECT 'lineitem_feed' AS table_name, count(*) AS row_count FROM ({line_state()}) "
            f"UNION ALL SELECT 'orders_feed', count(*) FROM ({orders_state}) WHERE {live} "
            f"UNION ALL SELECT 'events_feed', count(*) FROM ({events_state}) WHERE {live} "
            "UNION ALL SELECT 'broken_feed failed', 0"),
        "multi_table_hourly": (
            f"SELECT 'lines' AS table_name, count(*) AS row_count FROM ({line_state()})"),
        "primary_key_lists": (
            "SELECT tabname, string_agg(fieldname, ',' ORDER BY position, fieldname) AS keys FROM ("
            f"SELECT {normal('tabname')} AS tabname, {normal('fieldname')} AS fieldname, "
            f"min(position) AS position FROM ({DICTIONARY}) WHERE keyflag = 'X' "
            "AND fieldname <> '.INCLUDE' GROUP BY 1, 2) GROUP BY 1"),
        "normalize_names": (
            f"SELECT tabname, {normal('tabname')} AS table_name, fieldname, "
            f"{normal('fieldname')} AS field_name FROM ({DICTIONARY})"),
        "primary_keys": (
            f"SELECT {normal('tabname')} AS tabname, {normal('fieldname')} AS fieldname, "
            f"CAST(min(position) AS BIGINT) AS position FROM ({DICTIONARY}) WHERE keyflag = 'X' "
            "AND fieldname <> '.INCLUDE' GROUP BY 1, 2"),
        "partition_day_counts": bucket_counts("o_orderdate", "orders", "day"),
        "partition_month_counts": bucket_counts("o_orderdate", "orders", "month"),
        "partition_year_counts": bucket_counts("o_orderdate", "orders", "year"),
        "partition_hour_counts": bucket_counts("ts", "events", "hour"),
        "partition_int_range_counts": (
            f"SELECT CAST({bucket} AS BIGINT) AS bucket, count(*) AS row_count "
            "FROM part GROUP BY 1"),
        "stored_partition_month": stored_counts("o_orderdate", "orders", "%Y-%m"),
        "stored_partition_hour": stored_counts("ts", "events", "%Y-%m-%d-%H"),
        "stored_partition_int_range": (
            f"SELECT CAST({bucket} AS VARCHAR) AS tm_part, count(*) AS row_count "
            "FROM part GROUP BY 1"),
        "pruned_partition_read": (
            "SELECT * FROM orders WHERE o_orderdate >= TIMESTAMP '1996-03-15' "
            "AND o_orderdate <= TIMESTAMP '1997-02-03'"),
        "clustered_roundtrip": line_feed(),
        "create_view": BY_STATUS,
        "schema_only": (
            "SELECT 'created' AS table_name, CAST(0 AS BIGINT) AS row_count "
            f"UNION ALL SELECT 'refreshed', count(*) FROM ({BY_STATUS})"),
        "refresh_table": BY_STATUS,
        "refresh_positional": (
            "SELECT n_regionkey AS region, n_name AS label, CAST(n_nationkey AS BIGINT) AS id "
            "FROM nation"),
        "refresh_graph_regional_sales": SALES,
        "materialize_recreated": BY_STATUS,
        "run_script": "SELECT upper(c_mktsegment) AS segment, count(*) AS row_count "
                      "FROM customer GROUP BY 1",
        "param_query": (
            "SELECT o_orderpriority AS priority, count(*) AS row_count FROM orders "
            "WHERE o_orderstatus IN ('O', 'P') AND o_totalprice >= 1000.0 GROUP BY 1"),
        "load_csv": "SELECT c_custkey, c_name, CAST(c_nationkey AS BIGINT) AS c_nationkey, "
                    "c_acctbal, c_mktsegment FROM customer",
        "load_json": "SELECT p_partkey, p_name, p_brand, p_type, CAST(p_size AS BIGINT) AS "
                     "p_size, p_retailprice FROM part",
        "load_parquet": "SELECT * FROM lineitem",
        "load_append": "SELECT * FROM orders UNION ALL SELECT * FROM orders",
        "load_only_if_empty": "SELECT * FROM orders",
        "load_truncate": "SELECT * FROM orders",
        "load_skip_and_continue": (
            "SELECT 'skipped' AS table_name, count(*) AS row_count FROM orders "
            "UNION ALL SELECT 'loaded', count(*) FROM part"),
        "copy_table": "SELECT * FROM documents",
        "copy_dataset_counts": (
            "SELECT 'conversations' AS table_name, count(*) AS row_count FROM conversations "
            "UNION ALL SELECT 'labels', count(*) FROM labels "
            "UNION ALL SELECT 'pages', count(*) FROM pages"),
        "extract_roundtrip": "SELECT * FROM supplier",
        "mapped_read": (
            "SELECT c_name, CAST(c_custkey AS VARCHAR) AS c_custkey, c_acctbal, "
            "CAST(c_nationkey AS BIGINT) AS c_nationkey, CAST(NULL AS VARCHAR) AS source "
            "FROM customer"),
        "mapped_read_all_text": (
            "SELECT CAST(s_suppkey AS VARCHAR) AS s_suppkey, s_name, "
            "CAST(s_nationkey AS BIGINT) AS s_nationkey FROM supplier"),
        "multi_table_run": (
            f"SELECT 'lines' AS table_name, count(*) AS row_count FROM ({line_state()}) "
            f"UNION ALL SELECT 'orders_feed', count(*) FROM ({orders_state}) WHERE {live} "
            f"UNION ALL SELECT 'events_feed', count(*) FROM ({events_state}) WHERE {live}"),
        "scan_feed": f"SELECT *, 'path' AS via FROM ({dirty}) UNION ALL SELECT *, 'name' FROM ({dirty})",
        "copy_dataset_content": (
            "SELECT 'labels' AS table_name, doc_id AS id, CAST(quality AS VARCHAR) AS content FROM labels "
            "UNION ALL SELECT 'pages', page_id, html FROM pages "
            "UNION ALL SELECT 'conversations', conv_id, text FROM conversations"),
        "multi_table_lines": line_state(CLEAN, names),
        "multi_table_events": (
            f"SELECT event_id, user_id, value, props FROM ({events_state}) WHERE {live}"),
        "materialize_skipped": BY_STATUS,
        "merge_zoned_stamp": fold_sql(CLEAN),
        "current_state_zoned_stamp": line_state(),
        "early_years_by_name": (
            "SELECT o_orderkey, o_totalprice, CASE WHEN o_orderkey % 3 = 0 THEN o_orderdate "
            "- INTERVAL 1990 YEAR ELSE o_orderdate END AS day FROM orders"),
        "multi_table_orders": (
            f"SELECT custkey, orderkey, status, price, recordstamp FROM ({orders_state}) "
            f"WHERE {live}"),
    }
