"""DuckDB SQL for every registered query: an independent statement of the result.

The fixture views are the same text Spark runs (``fixtures``);
everything after them is written here directly in SQL.  Engine notes:
DuckDB's ``regexp_extract`` returns '' on no match (hence ``nullif``),
``regexp_replace`` replaces only the first match unless given 'g', RE2
classes are ASCII (Unicode classes spelled out), and ``floor`` of a
double stays double (cast to BIGINT).
"""

from __future__ import annotations

import fixtures as X

PART_CHARS = r"[^\p{L}\p{M}\p{Nd}\p{Pc}-]"
FLOAT_RE = r"^\s*[+-]?((\d+(\.\d*)?|\.\d+)([eE][+-]?\d+)?|(?i:nan|inf|infinity))\s*$"

PKMC_COLS = ("partnumber, supply_area, num_reg_circ, deposit_type, deposit_position, container, "
             "description, pack_standard, qty_per_box, qty_max_box, total_theoretical_qty, "
             "qty_for_restock, rack")

CTE = {
    "pkmc": rf"""
pkmc_raw AS ({X.duck('pkmc_raw')}),
pkmc_b01 AS (
  SELECT upper(regexp_replace(partnumber, '{PART_CHARS}', '', 'g')) AS partnumber,
         supply_area, num_reg_circ, deposit_type, deposit_position, container, description,
         pack_standard, qty_per_box,
         COALESCE(TRY_CAST(regexp_replace(qty_max_box, '\D+', '', 'g') AS BIGINT), 0) AS qty_max_box,
         p_partkey
  FROM pkmc_raw WHERE deposit_type = 'B01'),
pkmc AS (
  SELECT *, qty_per_box * qty_max_box AS total_theoretical_qty,
         qty_per_box * (qty_max_box - 1) AS qty_for_restock,
         nullif(regexp_extract(supply_area, 'P\d+[A-Z]?', 0), '') AS rack
  FROM pkmc_b01 WHERE nullif(regexp_extract(supply_area, 'P\d+[A-Z]?', 0), '') IS NOT NULL)""",
    "pkmc_t": rf"""
stock AS ({X.duck('stock')}),
pkmc_t AS (SELECT p.*, s.lb_balance FROM pkmc p
           LEFT JOIN stock s ON s.partnumber = p.partnumber AND s.supply_area = p.supply_area)""",
    "pk05": rf"""
pk05_raw AS ({X.duck('pk05_raw')}),
pk05_all AS (SELECT supply_area, deposit, responsible, discharge_point, description,
                    nullif(regexp_extract(description, 'T\d+', 0), '') AS takt FROM pk05_raw),
pk05 AS (SELECT * FROM pk05_all
         WHERE deposit = 'LB01' AND takt IS NOT NULL AND starts_with(takt, 'T'))""",
    "fx4pd": rf"""
fx4pd_raw AS ({X.duck('fx4pd_raw')}),
fx4pd_s AS (SELECT replace(knr_fx4pd, ' ', '') AS knr_fx4pd, replace(partnumber, ' ', '') AS partnumber,
                   replace(qty_usage, ' ', '') AS qty_usage, replace(qty_unit, ' ', '') AS qty_unit
            FROM fx4pd_raw),
fx4pd AS (SELECT knr_fx4pd, partnumber, TRY_CAST(qty_usage AS DOUBLE) AS qty_usage,
                 COALESCE(CASE WHEN regexp_full_match(qty_unit, '\s*[+-]?\d+\s*')
                               THEN TRY_CAST(qty_unit AS INTEGER) END, 0) AS qty_unit
          FROM fx4pd_s
          WHERE regexp_matches(qty_usage, '{FLOAT_RE}') AND TRY_CAST(qty_usage AS DOUBLE) IS NOT NULL)""",
    "assembly": rf"""
assembly_flat AS ({X.duck('assembly_flat')}),
assembly AS (SELECT knr, model, CAST(lfdnr_sequence AS VARCHAR) AS lfdnr_sequence, werk, spj,
                    regexp_replace(lane, 'lane_', '') AS lane, takt, werk || spj || knr AS knr_fx4pd
             FROM assembly_flat)""",
    "forecast": """
forecast AS (
  SELECT f.knr_fx4pd, f.partnumber, f.qty_usage, f.qty_unit, k.num_reg_circ, a.takt, k.rack,
         k.lb_balance, k.total_theoretical_qty, k.qty_for_restock, k.qty_per_box, k.qty_max_box
  FROM fx4pd f JOIN pkmc_t k ON k.partnumber = f.partnumber
               JOIN pk05 a ON a.supply_area = k.supply_area)""",
    "restock": """
restock AS (
  SELECT k.partnumber, k.num_reg_circ, a.takt, k.rack, k.lb_balance, k.total_theoretical_qty,
         k.qty_for_restock, k.qty_per_box, k.qty_max_box,
         k.total_theoretical_qty - k.lb_balance AS qty_for_request,
         CAST(floor((k.total_theoretical_qty - k.lb_balance)
                    / nullif(CAST(k.qty_per_box AS DOUBLE), 0)) AS BIGINT) AS qty_boxes_to_request
  FROM pkmc_t k JOIN pk05 a ON a.supply_area = k.supply_area
  WHERE k.lb_balance <= k.qty_for_restock)""",
    "consume_rows": """
consume_rows AS (
  SELECT fc.partnumber, fc.knr_fx4pd, fc.takt, fc.qty_usage,
         k.lb_balance - COALESCE(fc.qty_usage, 0) AS lb_balance
  FROM forecast fc
  JOIN assembly al ON fc.knr_fx4pd = al.knr_fx4pd AND fc.takt = al.takt
  JOIN pkmc_t k ON k.partnumber = fc.partnumber)""",
}

NEEDS = {
    "pkmc": [], "pkmc_t": ["pkmc"], "pk05": [], "fx4pd": [], "assembly": [],
    "forecast": ["fx4pd", "pkmc_t", "pk05"], "restock": ["pkmc_t", "pk05"],
    "consume_rows": ["forecast", "assembly", "pkmc_t"],
}


def with_ctes(names: list[str], body: str) -> str:
    order: list[str] = []

    def visit(n: str) -> None:
        for d in NEEDS[n]:
            visit(d)
        if n not in order:
            order.append(n)

    for n in names:
        visit(n)
    return "WITH " + ",\n".join(CTE[n].strip() for n in order) + "\n" + body


ORACLE: dict[str, str] = {
    "pkmc_clean": with_ctes(["pkmc"], f"SELECT {PKMC_COLS} FROM pkmc"),
    "pk05_clean": with_ctes(["pk05"], "SELECT * FROM pk05"),
    "fx4pd_clean": with_ctes(["fx4pd"], "SELECT * FROM fx4pd"),
    "pkmc_index": with_ctes(["pkmc"], f"""
SELECT row_number() OVER (ORDER BY partnumber NULLS FIRST, supply_area NULLS FIRST,
         num_reg_circ NULLS FIRST, deposit_type NULLS FIRST, deposit_position NULLS FIRST,
         container NULLS FIRST, description NULLS FIRST, pack_standard NULLS FIRST,
         qty_per_box NULLS FIRST, qty_max_box NULLS FIRST, total_theoretical_qty NULLS FIRST,
         qty_for_restock NULLS FIRST, rack NULLS FIRST) - 1 AS id, {PKMC_COLS}
FROM pkmc"""),
    "pk05_index": with_ctes(["pk05"], """
SELECT * FROM (
  SELECT row_number() OVER (ORDER BY supply_area NULLS FIRST, deposit NULLS FIRST,
           responsible NULLS FIRST, discharge_point NULLS FIRST, description NULLS FIRST,
           takt NULLS FIRST) - 1 AS id, *
  FROM pk05_all)
WHERE deposit = 'LB01' AND takt IS NOT NULL AND starts_with(takt, 'T')"""),
    "assembly_flatten": with_ctes(["assembly"], "SELECT * FROM assembly"),
    "reception_buffer": with_ctes(["assembly"],
                                  "SELECT knr, model, lfdnr_sequence FROM assembly WHERE lane = 'reception'"),
    "forecast_join": with_ctes(["forecast"], "SELECT * FROM forecast"),
    "restock_candidates": with_ctes(["restock"], "SELECT * FROM restock"),
    "kanban_calls": with_ctes(["restock"], """
SELECT partnumber, num_reg_circ, takt, rack, unnest(generate_series(1, qty_boxes_to_request)) AS call_no
FROM restock WHERE qty_boxes_to_request >= 1"""),
    "consume_rows": with_ctes(["consume_rows"], "SELECT * FROM consume_rows"),
    "consume_apply_last": with_ctes(["consume_rows"], f"""
, latest AS (
  SELECT partnumber, lb_balance FROM (
    SELECT partnumber, lb_balance,
           row_number() OVER (PARTITION BY partnumber
                              ORDER BY knr_fx4pd DESC NULLS LAST, takt DESC NULLS LAST,
                                       qty_usage DESC NULLS LAST, lb_balance DESC NULLS LAST) AS rn
    FROM consume_rows) WHERE rn = 1)
SELECT {PKMC_COLS.replace('partnumber,', 'k.partnumber,', 1)},
       CASE WHEN l.partnumber IS NOT NULL THEN l.lb_balance ELSE k.lb_balance END AS lb_balance
FROM pkmc_t k LEFT JOIN latest l ON l.partnumber = k.partnumber"""),
    "consume_apply_sum": with_ctes(["forecast", "assembly"], f"""
, present AS (
  SELECT DISTINCT fc.knr_fx4pd, fc.partnumber FROM forecast fc
  JOIN assembly al ON fc.knr_fx4pd = al.knr_fx4pd AND fc.takt = al.takt),
usage AS (SELECT knr_fx4pd, partnumber, sum(COALESCE(qty_usage, 0)) AS usage
          FROM fx4pd GROUP BY knr_fx4pd, partnumber),
consumed AS (SELECT p.partnumber, sum(u.usage) AS consumed FROM present p
             JOIN usage u ON u.knr_fx4pd = p.knr_fx4pd AND u.partnumber = p.partnumber
             GROUP BY p.partnumber)
SELECT {PKMC_COLS.replace('partnumber,', 'k.partnumber,', 1)},
       CASE WHEN c.consumed IS NOT NULL THEN k.lb_balance - c.consumed ELSE k.lb_balance END
         AS lb_balance
FROM pkmc_t k LEFT JOIN consumed c ON c.partnumber = k.partnumber"""),
}

_CUTOFF = "TIMESTAMP '2024-01-16 00:00:00'"


def _last_state(where: str) -> str:
    return f"""
  SELECT user_id, event_id AS last_event_id, ts AS last_ts, event_type AS last_type,
         value AS last_value FROM (
    SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn
    FROM events WHERE {where}) WHERE rn = 1"""


_SPOOL = """
spool AS (
  SELECT CAST(ts AS DATE) AS list_day, event_id AS idx,
         CASE WHEN event_type = 'view' THEN list_extract(['   ', chr(9), chr(160)], CAST(event_id % 3 + 1 AS BIGINT))
              ELSE upper(event_type) || '_' || CAST(user_id AS VARCHAR) END AS name,
         strftime(ts, '%H:%M:%S') AS hour
  FROM events),
starts AS (SELECT list_day, min(idx) AS s FROM spool WHERE trim(name, ' ' || chr(9) || chr(160)) <> ''
           GROUP BY list_day),
present AS (SELECT DISTINCT list_day, idx FROM spool),
ends AS (
  SELECT p.list_day, min(p.idx) AS e FROM present p JOIN starts st ON st.list_day = p.list_day
  WHERE p.idx >= st.s AND NOT EXISTS (
    SELECT 1 FROM present q WHERE q.list_day = p.list_day AND q.idx = p.idx + 1)
  GROUP BY p.list_day),
hits AS (
  SELECT r.* FROM spool r JOIN starts st ON st.list_day = r.list_day
                          JOIN ends en ON en.list_day = r.list_day
  WHERE r.idx BETWEEN st.s AND en.e AND contains(lower(r.name), 'purchase'))"""

ORACLE.update({
    "restock_one_call": with_ctes(["restock"], """
SELECT partnumber, num_reg_circ, array_to_string(list_sort(list_distinct(list(takt))), ',') AS takt,
       rack, min(lb_balance) AS lb_balance, min(total_theoretical_qty) AS total_theoretical_qty,
       min(qty_for_restock) AS qty_for_restock, min(qty_per_box) AS qty_per_box,
       min(qty_max_box) AS qty_max_box,
       min(total_theoretical_qty) - min(lb_balance) AS qty_for_request,
       CAST(floor((min(total_theoretical_qty) - min(lb_balance))
                  / nullif(CAST(min(qty_per_box) AS DOUBLE), 0)) AS BIGINT) AS qty_boxes_to_request
FROM restock GROUP BY partnumber, num_reg_circ, rack"""),
    "fx4pd_preview": with_ctes(["fx4pd"], """
SELECT * FROM fx4pd
ORDER BY knr_fx4pd NULLS FIRST, partnumber NULLS FIRST, qty_usage NULLS FIRST, qty_unit NULLS FIRST
LIMIT 5000"""),
    "forecast_preview": with_ctes(["forecast"], """
SELECT * FROM forecast
ORDER BY knr_fx4pd NULLS FIRST, partnumber NULLS FIRST, qty_usage NULLS FIRST, qty_unit NULLS FIRST,
         num_reg_circ NULLS FIRST, takt NULLS FIRST, rack NULLS FIRST, lb_balance NULLS FIRST,
         total_theoretical_qty NULLS FIRST, qty_for_restock NULLS FIRST, qty_per_box NULLS FIRST,
         qty_max_box NULLS FIRST
LIMIT 5000"""),
    "row_counts": with_ctes(["forecast", "assembly"], """
SELECT 'fx4pd' AS table_name, count(*) AS rows FROM fx4pd
UNION ALL SELECT 'forecast', count(*) FROM forecast
UNION ALL SELECT 'pkmc', count(*) FROM pkmc
UNION ALL SELECT 'pk05', count(*) FROM pk05
UNION ALL SELECT 'assembly_line', count(*) FROM assembly"""),
    "last_event_per_user": """
SELECT event_id, ts, user_id, event_type, value, props FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn
  FROM events) WHERE rn = 1""",
    "upsert_user_state": f"""
WITH stored_last AS ({_last_state(f"ts < {_CUTOFF}")}),
stored AS (
  SELECT s.*, f.first_seen FROM stored_last s
  JOIN (SELECT user_id, min(ts) AS first_seen FROM events WHERE ts < {_CUTOFF} GROUP BY user_id) f
    ON f.user_id = s.user_id),
src AS ({_last_state(f"ts >= {_CUTOFF}")})
SELECT COALESCE(s.user_id, t.user_id) AS user_id,
       CASE WHEN s.user_id IS NOT NULL THEN s.last_event_id ELSE t.last_event_id END AS last_event_id,
       CASE WHEN s.user_id IS NOT NULL THEN s.last_ts ELSE t.last_ts END AS last_ts,
       CASE WHEN s.user_id IS NOT NULL THEN s.last_type ELSE t.last_type END AS last_type,
       CASE WHEN s.user_id IS NOT NULL THEN s.last_value ELSE t.last_value END AS last_value,
       t.first_seen
FROM stored t FULL OUTER JOIN src s ON s.user_id = t.user_id""",
    "update_customer_balance": """
WITH latest AS (
  SELECT c_custkey, c_acctbal FROM (
    SELECT o_custkey AS c_custkey, o_totalprice AS c_acctbal,
           row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn
    FROM orders WHERE o_custkey IS NOT NULL) WHERE rn = 1)
SELECT c.c_custkey, c.c_name, c.c_nationkey,
       CASE WHEN l.c_custkey IS NOT NULL THEN l.c_acctbal ELSE c.c_acctbal END AS c_acctbal,
       c.c_mktsegment
FROM customer c LEFT JOIN latest l ON l.c_custkey = c.c_custkey""",
    "first_match": f"""
WITH {_SPOOL.strip()}
SELECT strftime(list_day, '%Y-%m-%d') AS list_day, idx AS "index", lower(name) AS name, hour FROM (
  SELECT *, row_number() OVER (PARTITION BY list_day ORDER BY idx) AS rn FROM hits) WHERE rn = 1""",
    "pending_orders": f"""
WITH transfer_orders AS ({X.duck('transfer_orders')})
SELECT order_no, warehouse, storage_type, is_open, strftime(created, '%Y-%m-%d') AS created,
       strftime(created, '%d.%m.%Y') AS created_text FROM transfer_orders
WHERE warehouse = 'ANC' AND storage_type = 'B01' AND is_open
  AND created BETWEEN DATE '1996-06-01' AND DATE '1996-06-30'""",
})
ORACLE["consume_rows_colocated"] = ORACLE["consume_rows"]
ORACLE["fx4pd_csv"] = ORACLE["fx4pd_clean"]
ORACLE["pkmc_xlsx"] = ORACLE["pkmc_clean"]
ORACLE["assembly_files"] = ORACLE["assembly_flatten"]
ORACLE["assembly_stream_upsert"] = ORACLE["assembly_flatten"]
ORACLE["consume_once_stream"] = ORACLE["consume_apply_sum"]

ORACLE["restock_rejects"] = with_ctes(["restock"], "SELECT * FROM restock WHERE qty_boxes_to_request IS NULL")
ORACLE["forecast_normalized"] = with_ctes(["fx4pd", "pkmc_t", "pk05"], f"""
SELECT upper(regexp_replace(f.partnumber, '{PART_CHARS}', '', 'g')) AS partnumber,
       f.knr_fx4pd, f.qty_usage, f.qty_unit, k.num_reg_circ, a.takt, k.rack, k.lb_balance,
       k.total_theoretical_qty, k.qty_for_restock, k.qty_per_box, k.qty_max_box
FROM fx4pd f
JOIN pkmc_t k ON upper(regexp_replace(k.partnumber, '{PART_CHARS}', '', 'g'))
               = upper(regexp_replace(f.partnumber, '{PART_CHARS}', '', 'g'))
JOIN pk05 a ON a.supply_area = k.supply_area""")
ORACLE["store_consume"] = ORACLE["consume_apply_sum"]
ORACLE["pkmc_file_order_index"] = with_ctes(["pkmc"], f"""
SELECT row_number() OVER (ORDER BY p_partkey) - 1 AS id, {PKMC_COLS} FROM pkmc""")

# lines that share a part (its last two characters) and area: the last line of the export wins
_SHARED = CTE["pkmc"].replace("pkmc_raw AS (", "pkmc_src AS (", 1).replace("pkmc_b01 AS (", r"""
pkmc_raw AS (SELECT * REPLACE (right(regexp_replace(partnumber, '\W', '', 'g'), 2) AS partnumber) FROM pkmc_src),
pkmc_b01 AS (""".strip() + "\n", 1)
ORACLE["pkmc_reload"] = f"""
WITH {_SHARED.strip()}
SELECT {PKMC_COLS} FROM (
  SELECT *, row_number() OVER (PARTITION BY partnumber, supply_area ORDER BY p_partkey DESC) AS rn FROM pkmc)
WHERE rn = 1"""
ORACLE["set_balances"] = with_ctes(["pkmc_t"], f"""
SELECT {', '.join('k.' + c.strip() for c in PKMC_COLS.split(','))}, b.lb_balance
FROM pkmc k LEFT JOIN (SELECT partnumber, max(lb_balance) AS lb_balance FROM stock GROUP BY partnumber) b
  ON b.partnumber = k.partnumber""")
# the demand as it is stored: one line per car and part
_DEMAND = """
demand AS (SELECT knr_fx4pd, partnumber, sum(qty_usage) AS qty_usage, max(qty_unit) AS qty_unit
           FROM fx4pd GROUP BY knr_fx4pd, partnumber)"""
ORACLE["write_result"] = with_ctes(["fx4pd", "pkmc_t", "pk05", "assembly"], f"""
, {_DEMAND.strip()},
present AS (
  SELECT d.knr_fx4pd, d.partnumber, a.takt FROM demand d JOIN pkmc_t k ON k.partnumber = d.partnumber
  JOIN pk05 a ON a.supply_area = k.supply_area
  JOIN assembly al ON al.knr_fx4pd = d.knr_fx4pd AND al.takt = a.takt)
SELECT 0 AS step, 'fx4pd' AS table_name, count(*) AS "rows" FROM demand
UNION ALL SELECT 1, 'fx4pd', count(*) FROM demand
UNION ALL SELECT 2, 'pkmc', count(*) FROM stock
UNION ALL SELECT 3, 'pkmc', count(*) FROM present p JOIN pkmc_t k ON k.partnumber = p.partnumber
UNION ALL SELECT 4, 'pkmc', count(DISTINCT partnumber) FROM present""")
_FIRST_AND_SECOND = """
lines AS (SELECT flag, replace(knr_fx4pd, ' ', '') AS knr_fx4pd, replace(partnumber, ' ', '') AS partnumber,
                 TRY_CAST(replace(qty_usage, ' ', '') AS DOUBLE) AS qty_usage,
                 COALESCE(CASE WHEN regexp_full_match(replace(qty_unit, ' ', ''), '[+-]?\\d+')
                               THEN TRY_CAST(replace(qty_unit, ' ', '') AS INTEGER) END, 0) AS qty_unit
          FROM fx4pd_raw WHERE TRY_CAST(replace(qty_usage, ' ', '') AS DOUBLE) IS NOT NULL),
first_file AS (SELECT knr_fx4pd, partnumber, sum(qty_usage) AS qty_usage, max(qty_unit) AS qty_unit
               FROM lines WHERE flag <> 'N' GROUP BY knr_fx4pd, partnumber),
second_file AS (SELECT knr_fx4pd, partnumber, sum(qty_usage) AS qty_usage, max(qty_unit) AS qty_unit
                FROM lines WHERE {second} GROUP BY knr_fx4pd, partnumber)"""
ORACLE["merge_report"] = f"""
WITH fx4pd_raw AS ({X.duck('fx4pd_raw')}),
{_FIRST_AND_SECOND.format(second="flag <> 'R'").strip()},
shared AS (SELECT count(*) AS n FROM first_file JOIN second_file USING (knr_fx4pd, partnumber)),
f AS (SELECT count(*) AS n FROM first_file), s AS (SELECT count(*) AS n FROM second_file),
{CTE['pkmc'].strip()},
low AS (SELECT DISTINCT partnumber FROM ({X.duck('stock')}) WHERE lb_balance < 100)
SELECT 0 AS step, 'fx4pd' AS table_name, f.n AS given, f.n AS inserted, 0 AS updated, 0 AS unchanged FROM f
UNION ALL SELECT 1, 'fx4pd', s.n, s.n - shared.n, shared.n, f.n - shared.n FROM f, s, shared
UNION ALL SELECT 2, 'pkmc', count(*), count(*), 0, 0 FROM pkmc
UNION ALL SELECT 3, 'pkmc', (SELECT count(*) FROM low), 0, count(*) FILTER (WHERE partnumber IN (FROM low)),
          count(*) FILTER (WHERE partnumber NOT IN (FROM low)) FROM pkmc"""
ORACLE["forecast_incremental"] = f"""
WITH fx4pd_raw AS ({X.duck('fx4pd_raw')}),
{_FIRST_AND_SECOND.format(second="flag = 'N'").strip()},
demand AS (SELECT * FROM second_file UNION ALL
           SELECT * FROM first_file ANTI JOIN second_file USING (knr_fx4pd, partnumber)),
{CTE['pkmc'].strip().replace("pkmc_raw AS (", "pkmc_src AS (", 1).replace("pkmc_b01 AS (",
    "pkmc_raw AS (SELECT * REPLACE (CASE WHEN qty_max_box = '8' THEN '9' ELSE qty_max_box END AS qty_max_box) "
    "FROM pkmc_src)," + chr(10) + "pkmc_b01 AS (", 1)},
{CTE['pkmc_t'].strip()},
{CTE['pk05'].strip()}
SELECT f.knr_fx4pd, f.partnumber, f.qty_usage, f.qty_unit, k.num_reg_circ, a.takt, k.rack, k.lb_balance,
       k.total_theoretical_qty, k.qty_for_restock, k.qty_per_box, k.qty_max_box
FROM demand f JOIN pkmc_t k ON k.partnumber = f.partnumber
JOIN pk05 a ON a.supply_area = k.supply_area WHERE a.takt <> 'T3'"""
ORACLE["pk05_reload"] = f"""
WITH pk05_src AS ({X.duck('pk05_raw')}),
pk05_raw AS (SELECT DISTINCT supply_area, deposit, CAST(NULL AS VARCHAR) AS responsible,
                    nullif(discharge_point, 'DP7') AS discharge_point, description FROM pk05_src),
{CTE['pk05'].split('),', 1)[1].strip()}
SELECT * FROM pk05"""
ORACLE["fx4pd_rejects"] = f"""
WITH fx4pd_raw AS ({X.duck('fx4pd_raw')}),
cut AS (SELECT *, line = '5' AND flag = 'R' AS short FROM fx4pd_raw)
SELECT replace(knr_fx4pd, ' ', '') AS knr_fx4pd, replace(partnumber, ' ', '') AS partnumber,
       CASE WHEN NOT short THEN replace(qty_usage, ' ', '') END AS qty_usage,
       CASE WHEN NOT short THEN replace(qty_unit, ' ', '') END AS qty_unit,
       CASE WHEN short THEN 'line cut short' ELSE 'usage is no number' END AS reason
FROM cut WHERE short OR NOT regexp_matches(replace(qty_usage, ' ', ''), '{FLOAT_RE}')"""
ORACLE["snapshot_quarantine"] = with_ctes(["assembly"], f"""
, bad AS ({X.duck('bad_docs')})
SELECT 'cars' AS what, knr_fx4pd AS value FROM assembly
UNION ALL SELECT CASE WHEN starts_with(value, '{{') THEN 'not JSON' ELSE 'not an object' END, value FROM bad""")
# a later poll of some cars, and an older one of all that lands last: the later one holds
_MOVED = f"""
moved_flat AS ({X.duck('assembly_moved')}),
moved AS (SELECT knr, model, CAST(lfdnr_sequence AS VARCHAR) AS lfdnr_sequence, werk, spj,
                 regexp_replace(lane, 'lane_', '') AS lane, takt, werk || spj || knr AS knr_fx4pd FROM moved_flat)"""
ORACLE["assembly_stream_buckets"] = with_ctes(["assembly"], f"""
, {_MOVED.strip()}
SELECT * FROM moved UNION ALL SELECT * FROM assembly WHERE knr NOT IN (SELECT knr FROM moved)""")
ORACLE["consume_once_moves"] = with_ctes(["forecast", "assembly"], f"""
, {_MOVED.strip()},
seen AS (SELECT knr_fx4pd, takt FROM assembly UNION SELECT knr_fx4pd, takt FROM moved),
present AS (SELECT DISTINCT fc.knr_fx4pd, fc.takt, fc.partnumber FROM forecast fc
            JOIN seen s ON fc.knr_fx4pd = s.knr_fx4pd AND fc.takt = s.takt),
usage AS (SELECT knr_fx4pd, partnumber, sum(COALESCE(qty_usage, 0)) AS usage
          FROM fx4pd GROUP BY knr_fx4pd, partnumber),
consumed AS (SELECT p.partnumber, sum(u.usage) AS consumed FROM present p
             JOIN usage u ON u.knr_fx4pd = p.knr_fx4pd AND u.partnumber = p.partnumber
             GROUP BY p.partnumber)
SELECT {PKMC_COLS.replace('partnumber,', 'k.partnumber,', 1)},
       CASE WHEN c.consumed IS NOT NULL THEN k.lb_balance - c.consumed ELSE k.lb_balance END AS lb_balance
FROM pkmc_t k LEFT JOIN consumed c ON c.partnumber = k.partnumber""")
ORACLE["parquet_scan"] = "SELECT o_orderkey, o_totalprice FROM orders WHERE o_totalprice > 100000"
ORACLE["sql_select"] = """
SELECT n_name, count(*) AS customers, max(c_acctbal) AS highest
FROM customer JOIN nation ON c_nationkey = n_nationkey WHERE c_acctbal > 0 GROUP BY n_name"""
ORACLE["forecast_collated"] = with_ctes(["fx4pd", "pkmc_t", "pk05"], """
SELECT upper(f.partnumber) AS partnumber, f.knr_fx4pd, f.qty_usage, f.qty_unit, k.num_reg_circ, a.takt, k.rack,
       k.lb_balance, k.total_theoretical_qty, k.qty_for_restock, k.qty_per_box, k.qty_max_box
FROM fx4pd f JOIN pkmc_t k ON lower(k.partnumber) = lower(f.partnumber)
JOIN pk05 a ON a.supply_area = k.supply_area""")
