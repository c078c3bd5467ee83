"""DuckDB SQL for the engine-against-engine check.

``FIXTURE_CTES`` derives the same study tables as ``ceasekit.sources.fixtures``
(and the silver/gold tables as the plans do) from the pre-registered driver
views; :func:`with_ctes` prepends the CTEs a query needs, in dependency order.
"""

from __future__ import annotations

import re


def _case(index: str, values) -> str:
    parts = []
    for i, v in enumerate(values):
        lit = "NULL" if v is None else (str(v) if isinstance(v, int) else "'" + v.replace("'", "''") + "'")
        parts.append(f"WHEN {index} = {i} THEN {lit}")
    return "CASE " + " ".join(parts) + " END"


def _fixture_ctes() -> dict[str, str]:
    from ceasekit.sources.fixtures import CRM_NAMES, FIXTURE_EXCLUDED_REASONS, SALES_CHANNELS, SPEEDS, TECHNOLOGIES
    excl = ", ".join("'" + r + "'" for r in FIXTURE_EXCLUDED_REASONS)
    key = "'|'"
    ctes = {
        "cease": """
SELECT CAST(o_custkey AS VARCHAR) AS unique_customer_identifier,
       CAST(o_orderdate AS DATE) AS cease_placed_date,
       CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE CAST(o_orderdate AS DATE) + 30 END AS cease_completed_date,
       CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE o_orderpriority END AS reason_description_insight
FROM orders WHERE o_orderstatus = 'F' AND o_totalprice >= 435000""",
        "ci_base": """
SELECT c.c_custkey, c.c_nationkey, c.c_acctbal, c.c_mktsegment, f.first_ts,
       CAST(date_trunc('month', f.first_ts) AS DATE) AS m0,
       COALESCE(fc.m1c, (SELECT CAST(date_trunc('month', max(o_orderdate)) AS DATE) FROM orders)) AS m1
FROM customer c
JOIN (SELECT o_custkey, min(o_orderdate) AS first_ts FROM orders GROUP BY o_custkey) f ON c.c_custkey = f.o_custkey
LEFT JOIN (SELECT unique_customer_identifier, CAST(date_trunc('month', min(cease_placed_date)) AS DATE) AS m1c
           FROM cease GROUP BY 1) fc ON CAST(c.c_custkey AS VARCHAR) = fc.unique_customer_identifier""",
        "ci_months": """
SELECT *, CAST(unnest(generate_series(CAST(m0 AS TIMESTAMP), CAST(m1 AS TIMESTAMP), INTERVAL 1 MONTH)) AS DATE) AS dv
FROM ci_base""",
        "customer_info": f"""
SELECT CAST(c_custkey AS VARCHAR) AS unique_customer_identifier,
       dv AS datevalue,
       c_mktsegment AS contract_status,
       CAST(c_custkey % 4 AS INTEGER) AS contract_dd_cancels,
       CAST(c_custkey % 2 AS INTEGER) AS dd_cancel_60_day,
       CASE WHEN c_custkey % 13 = 0 THEN NULL ELSE CAST(((year(dv) - year(m0)) * 12 + month(dv) - month(m0)) * 30 - 170 + c_custkey % 7 AS DOUBLE) END AS ooc_days,
       {_case('c_nationkey % 4', TECHNOLOGIES)} AS technology,
       CAST({_case('c_custkey % 6', SPEEDS)} AS INTEGER) AS speed,
       CASE WHEN c_custkey % 11 = 0 THEN NULL ELSE c_acctbal / 90 END AS line_speed,
       {_case('c_nationkey % 9', SALES_CHANNELS)} AS sales_channel,
       {_case('c_custkey % 10', CRM_NAMES)} AS crm_package_name,
       CAST(date_diff('day', CAST(first_ts AS DATE), dv) AS INTEGER) AS tenure_days
FROM ci_months""",
        "calls": """
SELECT CAST(o_custkey AS VARCHAR) AS unique_customer_identifier, CAST(o_orderdate AS DATE) AS event_date
FROM orders WHERE o_orderstatus = 'O'""",
        "usage": """
SELECT CAST(o.o_custkey AS VARCHAR) AS unique_customer_identifier, CAST(l.l_shipdate AS DATE) AS calendar_date,
       l.l_extendedprice AS usage_download_mbs, l.l_quantity AS usage_upload_mbs
FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey""",
        "obs_b": """
SELECT CAST(c_custkey AS VARCHAR) AS unique_customer_identifier,
       CASE WHEN c_custkey % 2 = 1 THEN DATE '2024-02-01' ELSE DATE '2024-01-01' END AS behav_win,
       CAST(CASE WHEN CAST(c_custkey AS VARCHAR) IN (SELECT unique_customer_identifier FROM cease) THEN 1 ELSE 0 END AS INTEGER) AS churned
FROM customer""",
        "usage_b": """
SELECT CAST(user_id AS VARCHAR) AS unique_customer_identifier,
       CAST(ts AS DATE) + CASE WHEN user_id % 2 = 1 THEN 31 ELSE 0 END AS calendar_date,
       value AS usage_download_mbs,
       CAST(json_extract_string(props, '$.k') AS DOUBLE) AS usage_upload_mbs
FROM events""",
        # ---- silver: observation set (fixture config: excluded reasons, seed 42, buffer 3)
        "info_scalars": """
SELECT max(datevalue) AS max_month, min(datevalue) AS min_month,
       CAST(max(datevalue) - INTERVAL 3 MONTH AS DATE) AS cutoff FROM customer_info""",
        "live_ids": """
SELECT i.unique_customer_identifier, max(i.datevalue) AS last_customer_month
FROM customer_info i
WHERE i.unique_customer_identifier NOT IN (SELECT unique_customer_identifier FROM cease)
GROUP BY 1
HAVING max(i.datevalue) = (SELECT max_month FROM info_scalars)""",
        "eligible": """
SELECT DISTINCT i.unique_customer_identifier, i.datevalue
FROM customer_info i JOIN live_ids l USING (unique_customer_identifier)
WHERE i.datevalue <= (SELECT cutoff FROM info_scalars)""",
        "sampled": f"""
SELECT unique_customer_identifier,
       arg_min(datevalue, CAST(('0x' || substr(md5(concat_ws({key}, unique_customer_identifier, CAST(datevalue AS VARCHAR), '42')), 1, 15)) AS BIGINT)) AS behav_win
FROM eligible GROUP BY 1""",
        "live_baseline": """
SELECT s.unique_customer_identifier, s.behav_win, 0 AS churned, i.contract_status, i.contract_dd_cancels,
       i.dd_cancel_60_day, i.ooc_days, i.technology, i.speed, i.line_speed, i.sales_channel,
       i.crm_package_name, i.tenure_days
FROM sampled s JOIN customer_info i
  ON s.unique_customer_identifier = i.unique_customer_identifier AND s.behav_win = i.datevalue""",
        "churn_months": """
SELECT unique_customer_identifier, cease_placed_date, reason_description_insight,
       CAST(date_trunc('month', cease_placed_date) AS DATE) AS cease_month,
       CAST(date_trunc('month', cease_placed_date) - INTERVAL 1 MONTH AS DATE) AS behav_win
FROM cease""",
        "churn_reason": """
SELECT unique_customer_identifier, behav_win, cease_month, min(reason_description_insight) AS reason_description_insight
FROM churn_months GROUP BY 1, 2, 3""",
        "churned_baseline": """
SELECT r.unique_customer_identifier, r.behav_win, 1 AS churned, r.reason_description_insight,
       i.contract_status, i.contract_dd_cancels, i.dd_cancel_60_day, i.ooc_days, i.technology, i.speed,
       i.line_speed, i.sales_channel, i.crm_package_name, i.tenure_days
FROM churn_reason r JOIN customer_info i
  ON r.unique_customer_identifier = i.unique_customer_identifier AND r.behav_win = i.datevalue""",
        "churned_kept": f"""
SELECT * EXCLUDE (rn) FROM (
  SELECT *, row_number() OVER (PARTITION BY unique_customer_identifier ORDER BY behav_win) AS rn
  FROM churned_baseline
  WHERE behav_win <> (SELECT min_month FROM info_scalars)
    AND reason_description_insight NOT IN ({excl})) WHERE rn = 1""",
        "raw_info": """
SELECT unique_customer_identifier, behav_win, churned, contract_status, contract_dd_cancels, dd_cancel_60_day,
       ooc_days, technology, speed, line_speed, sales_channel, crm_package_name, tenure_days FROM live_baseline
UNION ALL
SELECT unique_customer_identifier, behav_win, churned, contract_status, contract_dd_cancels, dd_cancel_60_day,
       ooc_days, technology, speed, line_speed, sales_channel, crm_package_name, tenure_days FROM churned_kept""",
        "usage_behav_month": """
SELECT u.*, r.behav_win
FROM usage u JOIN raw_info r
  ON u.unique_customer_identifier = r.unique_customer_identifier
 AND CAST(date_trunc('month', u.calendar_date) AS DATE) = r.behav_win""",
    }
    return ctes


_CTES: dict[str, str] | None = None


def ctes() -> dict[str, str]:
    global _CTES
    if _CTES is None:
        _CTES = _fixture_ctes()
    return _CTES


def _deps(name: str, defs: dict[str, str]) -> list[str]:
    body = defs[name]
    return [d for d in defs if d != name and re.search(rf"\b{re.escape(d)}\b", body)]


def register(name: str, sql: str) -> None:
    """Add a derived CTE (e.g. gold) usable by later queries."""
    ctes()[name] = sql


def with_ctes(select_sql: str) -> str:
    """Prefix ``select_sql`` with every CTE it (transitively) references."""
    defs = ctes()
    order: list[str] = []

    def visit(n: str, seen: tuple = ()):
        if n in order:
            return
        for d in _deps(n, defs):
            if d not in seen:
                visit(d, seen + (n,))
        order.append(n)

    for n in defs:
        if re.search(rf"\b{re.escape(n)}\b", select_sql):
            visit(n)
    if not order:
        return select_sql
    return "WITH RECURSIVE " + ",\n".join(f"{n} AS ({defs[n]}\n)" for n in order) + "\n" + select_sql
