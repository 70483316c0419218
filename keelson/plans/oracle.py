"""DuckDB SQL for each registered query: the same question written
independently, over the pre-registered driver views."""

ORACLE = {
    "row_count": "SELECT count(*) AS row_count FROM lineitem",
    "head_ordered": "SELECT * FROM nation ORDER BY n_nationkey LIMIT 10",
    "avg_by_group": """
        SELECT o_orderpriority, round(avg(o_totalprice), 2) AS avg_totalprice
        FROM orders GROUP BY o_orderpriority
        ORDER BY o_orderpriority DESC NULLS LAST LIMIT 10""",
    "nested_avg": """
        SELECT c_nationkey, avg(a) AS avg_acctbal FROM (
            SELECT c_nationkey, c_mktsegment, avg(c_acctbal) AS a
            FROM customer GROUP BY c_nationkey, c_mktsegment) s
        GROUP BY c_nationkey ORDER BY avg_acctbal DESC NULLS LAST, c_nationkey LIMIT 10""",
    "top_n_rows": """
        SELECT * FROM orders ORDER BY o_totalprice DESC NULLS LAST, o_orderkey LIMIT 10""",
    "top_one": "SELECT * FROM part ORDER BY p_retailprice DESC NULLS LAST, p_partkey LIMIT 1",
    "top_sum": """
        SELECT l_suppkey, sum(l_quantity) AS total_quantity FROM lineitem
        GROUP BY l_suppkey ORDER BY total_quantity DESC NULLS LAST, l_suppkey LIMIT 3""",
    "revenue_by": """
        SELECT l_returnflag,
               CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2)) * CAST(l_quantity AS DECIMAL(18,2)))
                    AS DOUBLE) AS total_revenue
        FROM lineitem GROUP BY l_returnflag ORDER BY total_revenue DESC NULLS LAST""",
    "top_revenue": """
        SELECT l_suppkey AS supplier,
               CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2)) * CAST(l_quantity AS DECIMAL(18,2)))
                    AS DOUBLE) AS total_spent
        FROM lineitem GROUP BY l_suppkey ORDER BY total_spent DESC NULLS LAST, supplier LIMIT 10""",
    "pair_count_join": """
        SELECT CAST(count(*) AS DECIMAL(38,0)) AS pair_count
        FROM customer p1 JOIN customer p2 ON p1.c_nationkey = p2.c_nationkey""",
    "pair_count": """
        SELECT CAST(count(*) AS DECIMAL(38,0)) AS pair_count
        FROM customer p1 JOIN customer p2 ON p1.c_nationkey = p2.c_nationkey""",
    "match_count_like": """
        SELECT source, count(*) AS match_count FROM documents
        WHERE text LIKE '%the%' AND lang = 'en'
        GROUP BY source ORDER BY match_count DESC, source""",
    "match_count_ci": """
        SELECT source, count(*) AS match_count FROM documents
        WHERE lower(text) LIKE '%ein%' AND lang IN ('de', 'fr')
        GROUP BY source ORDER BY match_count DESC, source""",
    "json_avg": """
        SELECT event_type, avg(TRY_CAST(json_extract_string(props, '$.k') AS INTEGER)) AS avg_k,
               count(TRY_CAST(json_extract_string(props, '$.k') AS INTEGER)) AS n_k
        FROM events GROUP BY event_type""",
    "trailing_avg": """
        SELECT round(avg(value), 2) AS avg_value, count(*) AS n_rows FROM events
        WHERE ts >= (SELECT max(ts) FROM events) - INTERVAL 1 DAY""",
    "profile_outlier": """
        WITH f AS (
            SELECT event_id, user_id, ts, value, CAST(value AS DECIMAL(10,2)) AS a,
                   count(CAST(value AS DECIMAL(10,2))) OVER w AS n,
                   sum(CAST(value AS DECIMAL(10,2))) OVER w AS s,
                   stddev_samp(CAST(value AS DECIMAL(10,2))) OVER w AS sd
            FROM events
            WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id
                         ROWS BETWEEN 50 PRECEDING AND 1 PRECEDING))
        SELECT event_id, user_id, ts, value, CAST(n AS INTEGER) AS prior_n,
               CAST(CASE WHEN n > 0 THEN s END AS DOUBLE) AS prior_sum,
               round(CASE WHEN n > 1 THEN sd ELSE 0.0 END, 4) AS prior_stdev,
               coalesce(n >= 3 AND a * n > 3 * s AND a > 50, false) AS is_outlier
        FROM f""",
    "velocity_score": """
        WITH v AS (
            SELECT e1.event_id, e1.user_id, e1.ts, e1.value, count(*) AS velocity
            FROM events e1 JOIN events e2
              ON e1.user_id = e2.user_id
             AND e2.ts >= e1.ts - INTERVAL 1 HOUR AND e2.ts <= e1.ts
             AND (e2.ts < e1.ts OR e2.event_id <= e1.event_id)
            GROUP BY e1.event_id, e1.user_id, e1.ts, e1.value)
        SELECT event_id, user_id, ts, velocity,
               CAST((CASE WHEN velocity > 5 THEN 40 ELSE 0 END)
                  + (CASE WHEN CAST(value AS DECIMAL(10,2)) > 400 THEN 50 ELSE 0 END) AS INTEGER) AS score,
               (CASE WHEN velocity > 5 THEN 40 ELSE 0 END)
                  + (CASE WHEN CAST(value AS DECIMAL(10,2)) > 400 THEN 50 ELSE 0 END) > 70 AS alert
        FROM v""",
    "window_counts": """
        SELECT date_trunc('day', ts) AS window_start,
               date_trunc('day', ts) + INTERVAL 1 DAY AS window_end,
               user_id, count(*) AS error_count
        FROM events WHERE event_type = 'error'
        GROUP BY 1, 2, user_id HAVING count(*) > 1""",
    "cdc_decode": """
        SELECT 'c' AS op, o_orderkey AS id, o_custkey AS user_id,
               CAST(o_totalprice AS DECIMAL(10,2)) AS amount FROM orders""",
    "window_counts_stream": """
        SELECT date_trunc('day', ts) AS window_start,
               date_trunc('day', ts) + INTERVAL 1 DAY AS window_end,
               user_id, count(*) AS error_count
        FROM events WHERE event_type = 'error'
        GROUP BY 1, 2, user_id HAVING count(*) > 1""",
    "running_counts_stream": """
        SELECT user_id, count(*) AS match_count FROM events WHERE event_type = 'error'
        GROUP BY user_id ORDER BY match_count DESC, user_id""",
    "summary_merge": "SELECT event_type, count(*) AS n FROM events GROUP BY event_type",
    "cube_counts": """
        SELECT o_orderstatus, o_orderpriority, count(*) AS n,
               GROUPING(o_orderstatus, o_orderpriority) AS level
        FROM orders GROUP BY CUBE (o_orderstatus, o_orderpriority)""",
    "token_search": r"""
        SELECT doc_id FROM documents
        WHERE list_contains(regexp_split_to_array(lower(text), '[^\p{L}\p{N}]+'), 'the')""",
    "csv_roundtrip": "SELECT * FROM customer",
    "ingest_table": "SELECT * FROM events",
    "skew_report": """
        WITH k AS (SELECT l_suppkey, count(*) AS n FROM lineitem GROUP BY l_suppkey)
        SELECT count(*) AS n_keys, sum(n) AS n_rows, min(n) AS min_rows, max(n) AS max_rows,
               round(avg(n), 6) AS avg_rows, round(max(n) / avg(n), 6) AS skew_ratio,
               round(max(n) / sum(n), 6) AS top_share
        FROM k""",
}

ORACLE["cdc_velocity_alerts"] = """
    WITH v AS (
        SELECT e1.o_orderkey AS id, e1.o_custkey AS user_id, e1.o_totalprice, count(*) AS velocity
        FROM orders e1 JOIN orders e2
          ON e1.o_custkey = e2.o_custkey
         AND e2.o_orderdate >= e1.o_orderdate - INTERVAL 30 DAY AND e2.o_orderdate <= e1.o_orderdate
         AND (e2.o_orderdate < e1.o_orderdate OR e2.o_orderkey <= e1.o_orderkey)
        GROUP BY e1.o_orderkey, e1.o_custkey, e1.o_totalprice)
    SELECT id, user_id, CAST(o_totalprice AS DECIMAL(10,2)) AS amount, velocity, 90 AS score
    FROM v WHERE velocity > 1 AND CAST(o_totalprice AS DECIMAL(10,2)) > 400000"""
ORACLE["cdc_profile_alerts"] = """
    WITH f AS (
        SELECT o_orderkey AS id, o_custkey AS user_id, CAST(o_totalprice AS DECIMAL(10,2)) AS a,
               count(*) OVER w AS n, sum(CAST(o_totalprice AS DECIMAL(10,2))) OVER w AS s
        FROM orders
        WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey
                     ROWS BETWEEN 50 PRECEDING AND 1 PRECEDING))
    SELECT id, user_id, a AS amount, CAST(n AS INTEGER) AS prior_n, CAST(s AS DOUBLE) AS prior_sum
    FROM f WHERE n >= 3 AND a * n > 3 * s AND a > 500"""

ORACLE["profile_sigma"] = """
    WITH f AS (
        SELECT event_id, user_id, ts, value, CAST(value AS DECIMAL(10,2)) AS a,
               count(CAST(value AS DECIMAL(10,2))) OVER w AS n,
               avg(CAST(value AS DECIMAL(10,2))) OVER w AS m,
               stddev_samp(CAST(value AS DECIMAL(10,2))) OVER w AS sd
        FROM events
        WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id
                     ROWS BETWEEN 50 PRECEDING AND 1 PRECEDING))
    SELECT event_id, user_id, ts, value,
           coalesce(n >= 3 AND CAST(a AS DOUBLE) > m + 3 * sd AND a > 50, false) AS is_outlier
    FROM f"""
ORACLE["trailing_avg_key"] = """
    SELECT round(avg(value), 2) AS avg_value, count(*) AS n_rows FROM events
    WHERE event_type = 'purchase' AND ts >= (SELECT max(ts) FROM events) - INTERVAL 3 DAY"""
ORACLE["cube_level"] = """
    SELECT o_orderpriority, count(*) AS n FROM orders GROUP BY o_orderpriority"""
ORACLE["token_search_all"] = r"""
    SELECT doc_id FROM documents
    WHERE list_has_all(regexp_split_to_array(lower(text), '[^\p{L}\p{N}]+'), ['the', 'of'])"""
ORACLE["join_count"] = """
    SELECT CAST(count(*) AS DECIMAL(38,0)) AS pair_count
    FROM customer c JOIN supplier s ON c.c_nationkey = s.s_nationkey"""

ORACLE["velocity_alerts_day"] = """
    WITH v AS (
        SELECT e1.event_id, e1.user_id, e1.ts, e1.value, count(*) AS velocity
        FROM events e1 JOIN events e2
          ON e1.user_id = e2.user_id
         AND e2.ts >= e1.ts - INTERVAL 1 DAY AND e2.ts <= e1.ts
         AND (e2.ts < e1.ts OR e2.event_id <= e1.event_id)
        GROUP BY e1.event_id, e1.user_id, e1.ts, e1.value)
    SELECT event_id, user_id, ts, velocity,
           CAST((CASE WHEN velocity > 5 THEN 40 ELSE 0 END)
              + (CASE WHEN CAST(value AS DECIMAL(10,2)) > 100 THEN 50 ELSE 0 END) AS INTEGER) AS score,
           (CASE WHEN velocity > 5 THEN 40 ELSE 0 END)
              + (CASE WHEN CAST(value AS DECIMAL(10,2)) > 100 THEN 50 ELSE 0 END) > 70 AS alert
    FROM v"""

ORACLE["velocity_burst"] = """
    SELECT e1.event_id, e1.user_id, e1.ts, count(*) AS velocity
    FROM events e1 JOIN events e2
      ON e1.user_id = e2.user_id
     AND e2.ts >= e1.ts - INTERVAL 30 DAY AND e2.ts <= e1.ts
     AND (e2.ts < e1.ts OR e2.event_id <= e1.event_id)
    GROUP BY e1.event_id, e1.user_id, e1.ts"""

# The streaming forms of the fraud rules answer the same questions as the
# batch forms, so they share the oracle.
ORACLE["profile_stream"] = ORACLE["profile_outlier"]
ORACLE["velocity_stream"] = ORACLE["velocity_score"]
ORACLE["velocity_stream_tails"] = ORACLE["velocity_score"]

# The same questions over several micro-batches, or split as for hot users.
ORACLE["profile_stream_batches"] = ORACLE["profile_chunked"] = ORACLE["profile_outlier"]
ORACLE["velocity_stream_batches"] = ORACLE["velocity_chunked"] = ORACLE["velocity_score"]

ORACLE["cdc_agents_both"] = f"""
    SELECT 'velocity' AS agent, id, user_id, amount FROM ({ORACLE["cdc_velocity_alerts"]})
    UNION ALL SELECT 'profile', id, user_id, amount FROM ({ORACLE["cdc_profile_alerts"]})"""
ORACLE["cdc_undecodable"] = """
    SELECT o_orderkey AS id,
           CASE WHEN o_orderkey % 5 <> 0 THEN CAST(o_totalprice AS DECIMAL(10,2)) END AS amount
    FROM orders"""
ORACLE["crash_windows_append"] = """
    WITH w AS (
        SELECT date_trunc('day', ts) AS window_start, user_id AS u, count(*) AS crash_count
        FROM events WHERE event_type = 'error' GROUP BY 1, 2)
    SELECT window_start, window_start + INTERVAL 1 DAY AS window_end, concat('user_', u) AS user_id, crash_count
    FROM w, (SELECT max(ts) AS newest FROM events)
    WHERE crash_count > 1 AND window_start + INTERVAL 1 DAY <= newest - INTERVAL 30 SECOND"""
ORACLE["restart_stream"] = "SELECT event_type, count(*) AS n FROM events GROUP BY event_type"
ORACLE["progress_rows"] = "SELECT CAST(4 AS BIGINT) AS batches, count(*) AS input_rows FROM events"
ORACLE["sql_view_revenue"] = """
    SELECT l_returnflag, CAST(sum(CAST(l_extendedprice AS DECIMAL(12,2)) * CAST(l_quantity AS DECIMAL(8,2))) AS DOUBLE)
               AS revenue, count(*) AS n_rows
    FROM lineitem GROUP BY l_returnflag"""
ORACLE["save_table_roundtrip"] = "SELECT * FROM orders"

ORACLE["summary_compacted"] = ORACLE["summary_merge"]
ORACLE["token_search_stream"] = ORACLE["token_search"]
ORACLE["late_repair"] = """
    SELECT date_trunc('day', ts) AS window_start, date_trunc('day', ts) + INTERVAL 1 DAY AS window_end,
           user_id, count(*) AS error_count
    FROM events, (SELECT max(ts) FILTER (WHERE event_type = 'error') AS newest FROM events)
    WHERE event_type = 'error' AND date_trunc('day', ts) + INTERVAL 1 DAY <= newest - INTERVAL 30 SECOND
    GROUP BY 1, 2, user_id HAVING count(*) > 1"""
ORACLE["cube_route"] = """
    SELECT 'two' AS question, o_orderstatus AS status, o_orderpriority AS priority, count(*) AS n,
           CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS total FROM orders GROUP BY ALL
    UNION ALL SELECT 'one', NULL, o_orderpriority, count(*), CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE)
    FROM orders WHERE o_orderstatus = 'F' GROUP BY ALL
    UNION ALL SELECT 'none', NULL, NULL, count(*), CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) FROM orders"""
ORACLE["velocity_state_list"] = ORACLE["velocity_score"]
ORACLE["profile_state_list"] = f"""
    SELECT event_id, user_id, ts, value, prior_n, prior_sum, is_outlier FROM ({ORACLE["profile_outlier"]})"""
ORACLE["trailing_avg_panes"] = ORACLE["trailing_avg"]
ORACLE["progress_log"] = "SELECT count(*) AS input_rows FROM events"
ORACLE["skew_top_keys"] = """
    SELECT o_custkey, count(*) AS n_rows FROM orders GROUP BY o_custkey
    HAVING count(*) >= 0.001 * (SELECT count(*) FROM orders)"""
