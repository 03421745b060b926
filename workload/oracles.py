"""The same results in DuckDB SQL, computed from the driver's numbers and never from text."""

from __future__ import annotations

PRELUDE = """
WITH snap AS (
  SELECT event_id, 'U' || user_id AS codigo, event_type AS acao,
         CASE WHEN user_id % 2 = 0 THEN 'ON' ELSE 'PN' END AS tipo,
         CASE WHEN event_id % 97 = 0 THEN NULL ELSE CAST(round(value * 10000) AS BIGINT) END AS qt_teorica,
         CASE WHEN event_id % 89 = 0 THEN NULL ELSE value END AS pc_participacao,
         strftime(ts, '%Y%m%d') AS dt_ptcm,
         CAST(extract(hour FROM ts) AS INTEGER) AS capture_hour
  FROM events),
dates AS (
  SELECT dt_ptcm, lag(dt_ptcm, 2) OVER (ORDER BY dt_ptcm) AS dt_d2
  FROM (SELECT DISTINCT dt_ptcm FROM snap) AS u),
pick AS (SELECT dt_ptcm AS d0, dt_d2 AS d2 FROM dates ORDER BY dt_ptcm DESC LIMIT 1),
d0 AS (SELECT * FROM snap WHERE dt_ptcm = (SELECT d0 FROM pick)),
d2 AS (SELECT * FROM snap WHERE dt_ptcm = (SELECT d2 FROM pick)),
edge AS (
  SELECT CASE WHEN acao <> 'error' THEN codigo END AS codigo, acao, qt_teorica, pc_participacao, dt_ptcm
  FROM snap),
month_snap AS (
  SELECT 'P' || l_partkey AS codigo, l_returnflag AS acao,
         CAST(round(l_extendedprice) AS BIGINT) AS qt_teorica, l_discount AS pc_participacao,
         strftime(l_shipdate, '%Y%m') || '01' AS dt_ptcm
  FROM lineitem),
months AS (
  SELECT dt_ptcm, lag(dt_ptcm, 2) OVER (ORDER BY dt_ptcm) AS dt_d2
  FROM (SELECT DISTINCT dt_ptcm FROM month_snap) AS u)
"""

SNAP_ROWS = "SELECT codigo, acao, tipo, qt_teorica, pc_participacao, dt_ptcm FROM snap"

COMPARISON = """
SELECT d0.codigo AS codigo, d0.acao AS acao, d0.dt_ptcm AS dt_ptcm,
       d0.qt_teorica - d2.qt_teorica AS diferenca_qt_teorica,
       round(d0.pc_participacao - d2.pc_participacao, 6) AS diferenca_pc_participacao
FROM d0 LEFT JOIN d2 ON d0.codigo = d2.codigo AND d0.acao = d2.acao
"""

COMPARISON_TABLE = """
SELECT d0.codigo AS codigo, d0.acao AS acao, d0.dt_ptcm AS data_atual,
       d0.qt_teorica - d2.qt_teorica AS diff_qt_teorica,
       round(d0.pc_participacao - d2.pc_participacao, 6) AS diff_pc_participacao
FROM d0 LEFT JOIN d2 ON d0.codigo = d2.codigo AND d0.acao = d2.acao
"""

SUMMARY = """
SELECT codigo, acao, dt_ptcm, CAST(sum(qt_teorica) AS BIGINT) AS soma_qt_teorica,
       round(avg(pc_participacao), 6) AS media_pc_participacao, count(*) AS qtd_registros
FROM {rows} GROUP BY codigo, acao, dt_ptcm
"""

ALL_DATES = """
SELECT a.codigo AS codigo, a.acao AS acao, a.dt_ptcm AS dt_ptcm, d.dt_d2 AS dt_d2,
       a.qt_teorica - b.qt_teorica AS diferenca_qt_teorica,
       round(a.pc_participacao - b.pc_participacao, 6) AS diferenca_pc_participacao
FROM {rows} AS a JOIN {dates} AS d ON a.dt_ptcm = d.dt_ptcm
LEFT JOIN {rows} AS b ON b.dt_ptcm = d.dt_d2 AND b.codigo = a.codigo AND b.acao = a.acao
"""

SELECTS = {
    "read_snapshot": SNAP_ROWS + " WHERE dt_ptcm = '20240115'",
    "read_snapshot_missing": SNAP_ROWS,
    "list_partitions": "SELECT DISTINCT dt_ptcm FROM snap",
    "list_table_partitions": "SELECT DISTINCT dt_ptcm FROM snap",
    "read_mixed_headers": SNAP_ROWS,
    "pick_partitions": "SELECT d0, d2 FROM pick",
    "pick_partitions_few": "SELECT max(dt_ptcm) AS d0, '' AS d2 FROM snap",
    "refined_roundtrip": SNAP_ROWS,
    "empty_roundtrip": SNAP_ROWS,
    "dynamic_overwrite": """
        SELECT codigo, acao, dt_ptcm,
               count(*) + CASE WHEN dt_ptcm = (SELECT d0 FROM pick) AND acao <> 'view'
                               THEN 100 ELSE 0 END AS qtd_registros
        FROM snap GROUP BY codigo, acao, dt_ptcm""",
    "replace_date": """
        SELECT codigo, acao, dt_ptcm,
               count(*) + CASE WHEN dt_ptcm = (SELECT d0 FROM pick) THEN 100 ELSE 0 END AS qtd_registros
        FROM snap WHERE NOT (dt_ptcm = (SELECT d0 FROM pick) AND acao = 'view')
        GROUP BY codigo, acao, dt_ptcm""",
    "append_capture": """
        SELECT dt_ptcm, CASE WHEN capture_hour < 12 THEN 1 ELSE 2 END AS capture_ts,
               count(*) AS n_rows
        FROM snap GROUP BY 1, 2""",
    "header_audit": """
        SELECT dt_ptcm, CASE WHEN acao = 'error' THEN 'Qtde. Teórica / Theoretical Qty' ELSE '' END
                 AS missing, count(*) AS n_rows
        FROM snap GROUP BY 1, 2""",
    "backfill_bad_file": SUMMARY.format(rows="snap"),
    "stream_bad_file": SNAP_ROWS,
    "captures_listed": """
        SELECT DISTINCT dt_ptcm,
               epoch(strptime(dt_ptcm, '%Y%m%d')) + CASE WHEN k = 0 THEN 43200 ELSE 82800.5 END AS capture_ts
        FROM snap, (VALUES (0), (1)) AS two(k) WHERE k = 1 OR capture_hour < 12""",
    "captures_extract": """
        SELECT 'd0' AS side, codigo, acao, tipo, qt_teorica, pc_participacao, dt_ptcm FROM d0
        UNION ALL
        SELECT 'd2', codigo, acao, tipo, qt_teorica, pc_participacao, dt_ptcm FROM d2""",
    "captures_backfill": ALL_DATES.format(rows="snap", dates="dates"),
    "rename_columns": "SELECT codigo, acao, tipo FROM snap",
    "rename_columns_missing": "SELECT codigo, event_id AS extra FROM snap",
    "parse_grouped_long": "SELECT event_id, qt_teorica FROM snap",
    "parse_decimal_comma": "SELECT event_id, pc_participacao FROM snap",
    "strip_cells": "SELECT o_orderkey, o_orderpriority AS cell FROM orders",
    "positional_schema": """
        SELECT p_partkey,
               CASE WHEN n > 0 THEN p_name END AS c1,
               CASE WHEN n > 0 THEN p_brand || 'a' END AS c2,
               CASE WHEN n > 0 THEN p_brand || 'b' END AS c3,
               CASE WHEN n > 3 THEN p_brand || 'c' END AS c4,
               CASE WHEN n > 3 THEN p_brand || 'd' END AS c5
        FROM (SELECT *, CASE WHEN p_partkey % 5 = 1 THEN 0
                             WHEN p_partkey % 3 = 0 THEN 3 ELSE 5 END AS n FROM part) AS p""",
    "partition_date_filter": """
        SELECT event_id, CASE WHEN acao <> 'error' THEN dt_ptcm END AS dt_ptcm FROM snap""",
    "preview": "SELECT codigo, acao, dt_ptcm FROM snap ORDER BY event_id LIMIT 5",
    "html_rows": """
        SELECT page_id, CAST(i - 1 AS INTEGER) AS row_pos,
               array_to_string(list_transform(
                 regexp_extract_all(rw, '(?s)<a(?:\\s[^>]*)?>(.*?)</a>', 1),
                 lambda z: trim(replace(z, '&amp;', '&'))), '|') AS cells
        FROM (SELECT page_id, unnest(l) AS rw, generate_subscripts(l, 1) AS i
              FROM (SELECT page_id,
                           regexp_extract_all(html, '(?s)<li(?:\\s[^>]*)?>(.*?)</li>', 1) AS l
                    FROM pages) AS t) AS u""",
    "html_tbody_rows": """
        SELECT c_custkey, 0 AS row_pos, 0 AS n_cells, '' AS cells FROM customer
        UNION ALL
        SELECT c_custkey, 1, 3, c_custkey || '|' || c_name || '|a & b' FROM customer""",
    "html_nested_tables": """
        SELECT c_custkey, 0 AS row_pos, c_custkey || '|before after|' || c_name AS cells FROM customer
        UNION ALL SELECT c_custkey, 1, c_name || '|deep|behind' FROM customer
        UNION ALL SELECT c_custkey, 2, c_custkey || '|<' || c_name || '>' FROM customer
        UNION ALL SELECT c_custkey, 3, 'last' FROM customer""",
    "html_pages_ordered": """
        SELECT c_nationkey AS capture, c_custkey AS page, 2 * n - 1 + pos AS row_no,
               3 * pos AS n_cells
        FROM (SELECT *, row_number() OVER (PARTITION BY c_nationkey ORDER BY c_custkey) AS n
              FROM customer) AS c
        CROSS JOIN (VALUES (0), (1)) AS r(pos)""",
    "compare_snapshots": COMPARISON,
    "compare_spread": COMPARISON,
    "compare_edge_rows": ALL_DATES.format(rows="edge", dates="dates"),
    "compare_no_d2": """
        SELECT codigo, acao, dt_ptcm, CAST(NULL AS BIGINT) AS diferenca_qt_teorica,
               CAST(NULL AS DOUBLE) AS diferenca_pc_participacao
        FROM d0""",
    "summarise_snapshot": SUMMARY.format(rows="d0"),
    "conform_agrupamento": SUMMARY.format(rows="d0"),
    "conform_comparacao": COMPARISON_TABLE,
    "run_metrics": """
        SELECT count(*) AS n_rows, count(*) FILTER (WHERE qt_teorica IS NULL) AS bad_qt,
               count(*) FILTER (WHERE pc_participacao IS NULL) AS bad_pc
        FROM snap""",
    "latest_capture": """
        SELECT s.event_id AS event_id, s.dt_ptcm AS dt_ptcm, s.capture_hour AS capture_hour
        FROM snap AS s
        JOIN (SELECT dt_ptcm, max(capture_hour) AS h FROM snap GROUP BY dt_ptcm) AS m
          ON s.dt_ptcm = m.dt_ptcm AND s.capture_hour = m.h""",
    "job_capture": SNAP_ROWS,
    "job_extract": """
        SELECT 'd0' AS side, codigo, acao, tipo, qt_teorica, pc_participacao, dt_ptcm FROM d0
        UNION ALL
        SELECT 'd2', codigo, acao, tipo, qt_teorica, pc_participacao, dt_ptcm FROM d2""",
    "job_transform": """
        SELECT (SELECT count(*) FROM (SELECT DISTINCT codigo, acao FROM d0) AS g) AS n_summary,
               (SELECT count(*) FROM d0 LEFT JOIN d2
                  ON d0.codigo = d2.codigo AND d0.acao = d2.acao) AS n_comparison""",
    "run_latest": COMPARISON_TABLE,
    "sql_over_registered": """
        SELECT acao, dt_ptcm, CAST(sum(qt_teorica) AS BIGINT) AS total, count(*) AS n_rows
        FROM d0 GROUP BY acao, dt_ptcm""",
    "sql_over_both_tables": f"""
        SELECT s.acao AS acao, s.dt_ptcm AS dt_ptcm, CAST(sum(s.qt_teorica) AS BIGINT) AS total,
               count(*) AS n_rows, any_value(c.n_compared) AS n_compared,
               any_value(c.diff_total) AS diff_total
        FROM snap AS s
        LEFT JOIN (SELECT acao, data_atual, count(*) AS n_compared,
                          CAST(sum(diff_qt_teorica) AS BIGINT) AS diff_total
                   FROM ({COMPARISON_TABLE.strip()}) AS t GROUP BY acao, data_atual) AS c
          ON c.acao = s.acao AND c.data_atual = s.dt_ptcm
        GROUP BY s.acao, s.dt_ptcm""",
    "load_after_interruption": SUMMARY.format(rows="snap"),
    "load_replacing_date": SUMMARY.format(
        rows="(SELECT * FROM snap WHERE NOT (dt_ptcm = (SELECT d0 FROM pick) AND acao = 'view')) AS kept"
    ),
    "publish_broken_off": SUMMARY.format(rows="snap"),
    "publish_replacing_dates": SUMMARY.format(
        rows="(SELECT * FROM snap WHERE NOT (dt_ptcm = (SELECT d0 FROM pick) AND acao = 'view')) AS kept"
    ),
    "backfill_registered": SUMMARY.format(rows="snap"),
    "update_comparison": ALL_DATES.format(rows="snap", dates="dates"),
    "update_summary": SUMMARY.format(rows="snap"),
    "compare_all_dates": ALL_DATES.format(rows="snap", dates="dates"),
    "summarise_all_dates": SUMMARY.format(rows="snap"),
    "compare_all_months": ALL_DATES.format(rows="month_snap", dates="months"),
    "summarise_all_months": SUMMARY.format(rows="month_snap"),
    "stream_ingest": SNAP_ROWS,
    "landed_files": SNAP_ROWS,
    "capture_report": """
        SELECT * FROM (
        WITH d AS (SELECT dt_ptcm, count(*) AS n, CAST(right(dt_ptcm, 2) AS INTEGER) % 3 AS k
                   FROM snap GROUP BY dt_ptcm),
        c AS (SELECT dt_ptcm, 1.0::DOUBLE AS capture_ts, n, n AS n_pages, n AS last_page FROM d
              UNION ALL
              SELECT dt_ptcm, 2.0, n,
                     CASE k WHEN 0 THEN n // 2 WHEN 1 THEN n - (n >= 1)::INT - (n >= 3)::INT - (n >= 4)::INT ELSE n END,
                     CASE k WHEN 0 THEN n // 2 ELSE n END FROM d)
        SELECT dt_ptcm, capture_ts, CAST(n_pages AS BIGINT) AS n_pages, last_page, n AS announced,
               CAST(n - n_pages AS BIGINT) AS n_missing, n = n_pages AS complete FROM c) AS t""",
    "capture_gaps": """
        SELECT * FROM (
        WITH d AS (SELECT dt_ptcm, count(*) AS n, CAST(right(dt_ptcm, 2) AS INTEGER) % 3 AS k
                   FROM snap GROUP BY dt_ptcm)
        SELECT dt_ptcm, 2.0::DOUBLE AS capture_ts, n // 2 + 1 AS from_page, n AS to_page FROM d WHERE k = 0
        UNION ALL SELECT dt_ptcm, 2.0, 1, 1 FROM d WHERE k = 1
        UNION ALL SELECT dt_ptcm, 2.0, 3, 4 FROM d WHERE k = 1) AS t""",
    "latest_complete_capture": """
        SELECT dt_ptcm, CASE WHEN CAST(right(dt_ptcm, 2) AS INTEGER) % 3 = 2 THEN 2 ELSE 1 END
                 AS capture_ts, event_id
        FROM snap""",
    "run_history": """
        SELECT * FROM (
        WITH kept AS (
            SELECT * FROM snap WHERE CAST(right(dt_ptcm, 2) AS INTEGER) % 7 <> 0
                OR CAST(substr(codigo, 2) AS BIGINT) % 4 = 0),
        r AS (SELECT dt_ptcm, count(*) AS n_rows, count(*) FILTER (qt_teorica IS NULL) AS bad_qt,
                     count(*) FILTER (pc_participacao IS NULL) AS bad_pc FROM kept GROUP BY dt_ptcm),
        u AS (SELECT *, median(n_rows) OVER (ORDER BY dt_ptcm ROWS BETWEEN 5 PRECEDING AND 1 PRECEDING)
                AS usual FROM r)
        SELECT *, CASE WHEN n_rows < 0.5 * usual THEN 'few rows'
                       WHEN greatest(bad_qt, bad_pc) > 0.5 * n_rows THEN 'unreadable' ELSE 'ok' END AS verdict
        FROM u) AS t""",
}

ORACLES = {key: f"{PRELUDE.strip()}\n{select.strip()}" for key, select in SELECTS.items()}
