"""DuckDB SQL fragments (one named CTE each) and the per-query composer.

``compose(select_sql)`` prepends, in definition order, every fragment the statement refers to
(transitively), so each oracle query is one self-contained ``WITH ... SELECT`` over the
driver's pre-registered views.
"""

from __future__ import annotations

import re

AS_OF = "DATE '2001-12-31'"

FRAGMENTS: dict[str, str] = {}


def frag(name: str, sql: str) -> None:
    FRAGMENTS[name] = sql.strip()


def _refs(sql: str) -> list[str]:
    return [n for n in FRAGMENTS if re.search(rf"\b{re.escape(n)}\b", sql)]


def compose(select_sql: str) -> str:
    needed: set[str] = set()
    stack = _refs(select_sql)
    while stack:
        n = stack.pop()
        if n in needed:
            continue
        needed.add(n)
        stack.extend(r for r in _refs(FRAGMENTS[n]) if r != n)
    ordered = [n for n in FRAGMENTS if n in needed]
    stmt = select_sql.strip()
    if not ordered:
        return stmt
    body = ",\n".join(f"{n} AS (\n{FRAGMENTS[n]}\n)" for n in ordered)
    own_with = re.match(r"(?is)^with\s+", stmt)
    if own_with:  # merge the statement's own CTEs after the shared fragments
        return f"WITH {body},\n{stmt[own_with.end():]}"
    return f"WITH {body}\n{stmt}"


# --------------------------------------------------------------------------------------
# Fixture mapping: driver tables -> native credit tables
# --------------------------------------------------------------------------------------
_PRODUCT = """CASE o_orderpriority WHEN '1-URGENT' THEN 'personal_loan' WHEN '2-HIGH' THEN 'vehicle_financing'
         WHEN '3-MEDIUM' THEN 'credit_card' ELSE 'payroll_loan' END"""

frag("src_customers", """
SELECT c.c_custkey AS customer_id, c.c_name AS name, 'h' || CAST(c.c_custkey AS VARCHAR) AS cpf_hash,
       CASE c.c_custkey % 5 WHEN 0 THEN DATE '2000-06-15' WHEN 1 THEN DATE '1993-02-28'
            WHEN 2 THEN DATE '1983-11-01' WHEN 3 THEN DATE '1970-07-31' ELSE DATE '1950-01-01' END AS birth_date,
       CASE c.c_custkey % 5 WHEN 0 THEN '18-25' WHEN 1 THEN '26-35' WHEN 2 THEN '36-45'
            WHEN 3 THEN '46-60' ELSE '60+' END AS age_group,
       CASE c.c_mktsegment WHEN 'AUTOMOBILE' THEN 'paid_search' WHEN 'BUILDING' THEN 'organic'
            WHEN 'FURNITURE' THEN 'social_media' WHEN 'HOUSEHOLD' THEN 'partner' ELSE 'referral' END
            AS acquisition_channel,
       r.r_name AS state, n.n_name AS city,
       greatest(c.c_acctbal, CAST(0.0 AS DOUBLE)) AS income_declared,
       DATE '1995-01-01' + CAST(c.c_custkey % 2000 AS INTEGER) AS signup_date,
       CASE c.c_nationkey % 4 WHEN 0 THEN 'starter' WHEN 1 THEN 'regular' WHEN 2 THEN 'premium'
            ELSE 'vip' END AS customer_segment,
       c.c_custkey % 20 <> 0 AS is_active,
       CAST(1 + c.c_custkey % 4 AS INTEGER) AS products_count
FROM customer c
JOIN nation n ON c.c_nationkey = n.n_nationkey
JOIN region r ON n.n_regionkey = r.r_regionkey
""")

frag("src_contracts", f"""
SELECT o_orderkey AS contract_id, o_custkey AS customer_id,
       {_PRODUCT} AS product_type,
       CAST(o_orderdate AS DATE) AS contract_date,
       CAST(o_orderdate AS DATE) + CAST(30 * (6 + o_orderkey % 55) AS INTEGER) AS maturity_date,
       o_totalprice AS principal_amount,
       CAST(15 + o_orderkey % 105 AS DOUBLE) / CAST(1000.0 AS DOUBLE) AS interest_rate,
       CAST(6 + o_orderkey % 55 AS INTEGER) AS installments_total,
       CAST((o_orderkey * 7) % (7 + o_orderkey % 55) AS INTEGER) AS installments_paid,
       CASE WHEN o_custkey % 10 = 3 AND o_orderkey % 10 < 9 THEN 'defaulted'
            WHEN o_custkey % 10 <> 3 AND o_orderkey % 20 = 0 THEN 'defaulted'
            WHEN (o_orderkey * 7) % (7 + o_orderkey % 55) = 6 + o_orderkey % 55 THEN 'settled'
            WHEN o_orderkey % 20 = 1 THEN 'renegotiated'
            ELSE 'active' END AS status,
       CASE WHEN o_orderpriority = '2-HIGH' THEN 'vehicle' WHEN o_orderkey % 9 = 0 THEN 'property'
            ELSE 'none' END AS collateral
FROM (SELECT * REPLACE (CASE WHEN o_custkey % 25 = 7 THEN o_custkey - 1 ELSE o_custkey END AS o_custkey) FROM orders)
""")

frag("src_payment_base", """
SELECT CAST(l.l_orderkey AS VARCHAR) || '-' || CAST(l.l_linenumber AS VARCHAR) || '-'
       || CAST(l.l_partkey AS VARCHAR) || '-' || CAST(l.l_suppkey AS VARCHAR) || '-'
       || CAST(CAST(l.l_quantity AS INTEGER) AS VARCHAR) AS payment_id,
       ct.contract_id, ct.customer_id, ct.status AS contract_status,
       CAST(l.l_shipdate AS DATE) AS due_date,
       CASE WHEN l.pstatus IN ('paid_on_time', 'paid_late') THEN CAST(l.l_shipdate AS DATE) + l.days_late END
            AS payment_date,
       l.l_extendedprice AS amount_due,
       CASE WHEN l.pstatus IN ('paid_on_time', 'paid_late') THEN l.l_extendedprice END AS amount_paid,
       l.days_late,
       CASE l.l_suppkey % 4 WHEN 0 THEN 'pix' WHEN 1 THEN 'boleto' WHEN 2 THEN 'debit' ELSE 'auto_debit' END
            AS payment_method,
       l.pstatus AS status,
       l.l_partkey + 3 * l.l_linenumber + l.l_suppkey AS q
FROM (
    SELECT s.*,
           CAST(CASE s.pstatus WHEN 'defaulted' THEN 31 + s.l_partkey % 149
                     WHEN 'paid_late' THEN 1 + s.l_partkey % 29
                     WHEN 'pending' THEN 0
                     ELSE -(s.l_partkey % 6) END AS INTEGER) AS days_late
    FROM (
        SELECT li.*,
               CASE WHEN l_returnflag = 'R' AND l_discount >= 0.075 THEN 'defaulted'
                    WHEN l_returnflag = 'A' AND l_discount >= 0.065 THEN 'paid_late'
                    WHEN l_returnflag = 'N' AND l_discount >= 0.085 THEN 'pending'
                    ELSE 'paid_on_time' END AS pstatus
        FROM lineitem li
    ) s
) l
JOIN src_contracts ct ON l.l_orderkey = ct.contract_id
""")

frag("src_payments", """
SELECT payment_id, contract_id, customer_id, due_date, payment_date, amount_due, amount_paid,
       days_late, payment_method, status
FROM src_payment_base
""")

frag("src_collections", """
SELECT payment_id AS collection_id, contract_id, customer_id,
       due_date + d AS trigger_date,
       d AS days_overdue_at_trigger,
       CASE q % 5 WHEN 0 THEN 'sms' WHEN 1 THEN 'email' WHEN 2 THEN 'whatsapp' WHEN 3 THEN 'phone'
            ELSE 'letter' END AS channel_used,
       outcome,
       CASE WHEN outcome IN ('paid', 'renegotiated')
            THEN CAST(floor(amount_due * 40) AS DOUBLE) / CAST(100.0 AS DOUBLE) END AS recovery_amount,
       CASE WHEN outcome IN ('paid', 'renegotiated') THEN CAST(1 + q % 119 AS INTEGER) END AS resolution_days
FROM (
    SELECT b.*,
           CASE WHEN q % 12 = 0 THEN NULL
                WHEN q % 180 < (CASE WHEN d <= 7 THEN 120 WHEN d <= 30 THEN 90 ELSE 36 END)
                     THEN CASE WHEN q % 3 = 0 THEN 'renegotiated' ELSE 'paid' END
                WHEN q % 3 = 0 THEN 'legal_action'
                ELSE 'no_contact' END AS outcome
    FROM (
        SELECT pb.*,
               CAST(1 + (3 * q) % (CASE WHEN q % 4 = 0 THEN 7 WHEN q % 4 = 1 THEN 30 ELSE 179 END) AS INTEGER) AS d
        FROM src_payment_base pb
        WHERE contract_status = 'defaulted'
    ) b
) x
""")

frag("src_app_events", """
SELECT event_id,
       CASE WHEN event_id % 50 = 0 THEN -1 - event_id ELSE user_id * 10 + event_id % 3 END AS customer_id,
       ts + to_months(CAST(event_id % 6 AS INTEGER)) AS event_date,
       CASE event_type WHEN 'view' THEN 'login' WHEN 'purchase' THEN 'make_payment'
            WHEN 'click' THEN CASE WHEN event_id % 2 = 0 THEN 'view_offer' ELSE 'accept_offer' END
            WHEN 'signup' THEN CASE WHEN event_id % 2 = 0 THEN 'check_balance' ELSE 'view_contract' END
            ELSE 'contact_support' END AS event_type,
       CASE event_id % 3 WHEN 0 THEN 'app_ios' WHEN 1 THEN 'app_android' ELSE 'web' END AS channel,
       CAST(10 + event_id % 1790 AS INTEGER) AS session_duration_seconds
FROM events
""")

frag("src_proposals", f"""
SELECT o_orderkey AS proposal_id, o_custkey AS customer_id,
       CAST(o_orderdate AS DATE) - 10 AS proposal_date,
       {_PRODUCT} AS product_type,
       o_totalprice AS requested_amount,
       CASE WHEN o_orderkey % 20 < 11 THEN CAST(floor(o_totalprice * 85) AS DOUBLE) / CAST(100.0 AS DOUBLE) END
            AS approved_amount,
       CAST(18 + o_orderkey % 103 AS DOUBLE) / CAST(1000.0 AS DOUBLE) AS interest_rate_offered,
       CASE WHEN o_orderkey % 20 < 11 THEN 'approved' WHEN o_orderkey % 20 < 17 THEN 'rejected'
            WHEN o_orderkey % 20 < 19 THEN 'pending' ELSE 'cancelled' END AS decision,
       CASE WHEN o_orderkey % 20 >= 11 AND o_orderkey % 20 < 17 THEN
            CASE o_orderkey % 5 WHEN 0 THEN 'score' WHEN 1 THEN 'income' WHEN 2 THEN 'documentation'
                 WHEN 3 THEN 'bureau' ELSE 'capacity' END END AS rejection_reason,
       CASE WHEN o_orderkey % 19 = 0 THEN NULL ELSE CAST(250 + (o_orderkey * 13) % 650 AS INTEGER) END
            AS bureau_score
FROM orders
""")

# --------------------------------------------------------------------------------------
# Staging (I1–I6): the native columns and what is derived from them.  Bands are read from a
# list by the number of limits that a value is above.
# --------------------------------------------------------------------------------------
def _is(column: str, value: str) -> str:
    """True where the column has the value, false otherwise (null included)."""
    return f"({column} IS NOT DISTINCT FROM '{value}')"


def _band(column: str, limits: list[int], labels: list[str]) -> str:
    above = " + ".join(f"({column} > {x})::INTEGER" for x in limits)
    return f"{labels!r}[1 + {above}]"


frag("stg_customers", f"""
SELECT src.*, (year({AS_OF}) - year(birth_date))::INTEGER AS age,
       income_declared IS NOT DISTINCT FROM 0 AS has_zero_income,
       coalesce(products_count, 0) > 1 AS is_multi_product
FROM src_customers src
""")

frag("stg_contracts", f"""
SELECT src.*, (maturity_date - {AS_OF})::INTEGER AS days_to_maturity,
       round(installments_paid / nullif(installments_total::DOUBLE, 0), 4) AS completion_rate,
       {_is('status', 'defaulted')} AS is_defaulted, {_is('status', 'active')} AS is_active_contract,
       {_is('status', 'settled')} AS is_settled,
       collateral IS NOT NULL AND NOT {_is('collateral', 'none')} AS has_collateral
FROM src_contracts src
""")

frag("stg_payments", f"""
SELECT src.*, coalesce(days_late, 0) > 0 AS is_late, {_is('status', 'defaulted')} AS is_defaulted,
       coalesce({_band('days_late', [0, 30, 60, 90],
                       ['on_time', '1-30_days', '31-60_days', '61-90_days', '90+_days'])}, '90+_days')
           AS lateness_bucket,
       make_date(year(due_date), month(due_date), 1) AS due_month,
       year(due_date)::INTEGER AS due_year, month(due_date)::INTEGER AS due_month_num
FROM src_payments src
""")

frag("stg_app_events", f"""
SELECT src.*, event_date::DATE AS event_day,
       make_date(year(event_date), month(event_date), 1) AS event_month,
       hour(event_date)::INTEGER AS event_hour, dayofweek(event_date)::INTEGER AS day_of_week,
       year(event_date)::INTEGER AS event_year,
       {_is('event_type', 'make_payment')} AS is_payment_event, {_is('event_type', 'login')} AS is_login_event,
       coalesce(list_contains(['view_offer', 'accept_offer', 'reject_offer'], event_type), false) AS is_offer_event
FROM src_app_events src
""")

frag("stg_proposals", f"""
SELECT src.*, {_is('decision', 'approved')} AS is_approved, {_is('decision', 'rejected')} AS is_rejected,
       bureau_score IS NULL AS is_missing_bureau,
       CASE WHEN {_is('decision', 'approved')} AND requested_amount > 0
            THEN round(approved_amount / requested_amount, 4) END AS approval_ratio,
       coalesce({_band('bureau_score', [299, 499, 699, 849],
                       ['very_low', 'low', 'medium', 'high', 'very_high'])}, 'unknown') AS bureau_score_band,
       make_date(year(proposal_date), month(proposal_date), 1) AS proposal_month
FROM src_proposals src
""")

frag("stg_collections", f"""
SELECT src.*, {_is('outcome', 'paid')} OR {_is('outcome', 'renegotiated')} AS is_recovered,
       outcome IS NULL AS is_missing_outcome,
       CASE WHEN days_overdue_at_trigger BETWEEN 1 AND 90
            THEN {_band('days_overdue_at_trigger', [3, 30], ['early_1_3d', 'early_4_30d', 'mid_31_90d'])}
            ELSE 'late_90plus' END AS overdue_bucket,
       make_date(year(trigger_date), month(trigger_date), 1) AS trigger_month
FROM src_collections src
""")


def oracle_queries() -> dict[str, str]:
    """Query name -> self-contained DuckDB statement."""
    from riskmart.oracle import models_sql, reports_sql  # noqa: F401  (register fragments)

    out: dict[str, str] = {}
    for name in ["stg_customers", "stg_contracts", "stg_payments", "stg_app_events",
                 "stg_proposals", "stg_collections"]:
        out[name] = compose(f"SELECT * FROM {name}")
    out.update(models_sql.queries())
    out.update(reports_sql.queries())
    return out
