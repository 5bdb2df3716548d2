"""Staging views (I1–I6): typed casts plus row-level derived columns.

Pure projections — no shuffle.  They stay lazy (views); downstream models fuse them into their
own scans, so Catalyst prunes columns and pushes filters straight into the Parquet reader.
Each view is one ``selectExpr`` (Spark SQL expressions, parsed once in the JVM).  The audit
columns ``_loaded_at`` / ``_source`` are added by the writer, not here.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame

from riskmart.functions import model


def _date_sql(as_of) -> str:
    if as_of is None:
        return "current_date()"
    if isinstance(as_of, dt.datetime):
        as_of = as_of.date()
    if isinstance(as_of, str):
        as_of = dt.date.fromisoformat(as_of)
    return f"DATE'{as_of.isoformat()}'"


@model
def stg_customers(raw: DataFrame, as_of=None) -> DataFrame:
    return raw.selectExpr(
        "customer_id", "name", "cpf_hash",
        "CAST(birth_date AS DATE) AS birth_date",
        "age_group", "acquisition_channel", "state", "city",
        "CAST(income_declared AS DOUBLE) AS income_declared",
        "CAST(signup_date AS DATE) AS signup_date",
        "customer_segment",
        "CAST(is_active AS BOOLEAN) AS is_active",
        "CAST(products_count AS INT) AS products_count",
        # year-boundary difference (not completed years)
        f"year({_date_sql(as_of)}) - year(CAST(birth_date AS DATE)) AS age",
        "coalesce(income_declared = 0, false) AS has_zero_income",
        "coalesce(products_count >= 2, false) AS is_multi_product",
    )


@model
def stg_contracts(raw: DataFrame, as_of=None) -> DataFrame:
    return raw.selectExpr(
        "contract_id", "customer_id", "product_type",
        "CAST(contract_date AS DATE) AS contract_date",
        "CAST(maturity_date AS DATE) AS maturity_date",
        "CAST(principal_amount AS DOUBLE) AS principal_amount",
        "CAST(interest_rate AS DOUBLE) AS interest_rate",
        "CAST(installments_total AS INT) AS installments_total",
        "CAST(installments_paid AS INT) AS installments_paid",
        "status", "collateral",
        f"datediff(CAST(maturity_date AS DATE), {_date_sql(as_of)}) AS days_to_maturity",
        "rm_rnd(rm_safe_div(CAST(installments_paid AS DOUBLE), CAST(installments_total AS DOUBLE)), 4)"
        " AS completion_rate",
        "coalesce(status = 'defaulted', false) AS is_defaulted",
        "coalesce(status = 'active', false) AS is_active_contract",
        "coalesce(status = 'settled', false) AS is_settled",
        "coalesce(collateral != 'none', false) AS has_collateral",
    )


@model
def stg_payments(raw: DataFrame) -> DataFrame:
    return raw.selectExpr(
        "payment_id", "contract_id", "customer_id",
        "CAST(due_date AS DATE) AS due_date",
        "CAST(payment_date AS DATE) AS payment_date",
        "CAST(amount_due AS DOUBLE) AS amount_due",
        "CAST(amount_paid AS DOUBLE) AS amount_paid",
        "CAST(days_late AS INT) AS days_late",
        "payment_method", "status",
        "coalesce(days_late > 0, false) AS is_late",
        "coalesce(status = 'defaulted', false) AS is_defaulted",
        """CASE WHEN days_late <= 0 THEN 'on_time'
                WHEN days_late BETWEEN 1 AND 30 THEN '1-30_days'
                WHEN days_late BETWEEN 31 AND 60 THEN '31-60_days'
                WHEN days_late BETWEEN 61 AND 90 THEN '61-90_days'
                ELSE '90+_days' END AS lateness_bucket""",
        "trunc(CAST(due_date AS DATE), 'month') AS due_month",
        "year(CAST(due_date AS DATE)) AS due_year",
        "month(CAST(due_date AS DATE)) AS due_month_num",
    )


@model
def stg_app_events(raw: DataFrame) -> DataFrame:
    return raw.selectExpr(
        "event_id", "customer_id", "event_date", "event_type", "channel",
        "CAST(session_duration_seconds AS INT) AS session_duration_seconds",
        "CAST(event_date AS DATE) AS event_day",
        "trunc(CAST(event_date AS DATE), 'month') AS event_month",
        "hour(event_date) AS event_hour",
        "dayofweek(CAST(event_date AS DATE)) - 1 AS day_of_week",  # Sunday = 0
        "year(CAST(event_date AS DATE)) AS event_year",
        "coalesce(event_type = 'make_payment', false) AS is_payment_event",
        "coalesce(event_type = 'login', false) AS is_login_event",
        "coalesce(event_type IN ('view_offer', 'accept_offer', 'reject_offer'), false) AS is_offer_event",
    )


@model
def stg_proposals(raw: DataFrame) -> DataFrame:
    return raw.selectExpr(
        "proposal_id", "customer_id",
        "CAST(proposal_date AS DATE) AS proposal_date",
        "product_type",
        "CAST(requested_amount AS DOUBLE) AS requested_amount",
        "CAST(approved_amount AS DOUBLE) AS approved_amount",
        "CAST(interest_rate_offered AS DOUBLE) AS interest_rate_offered",
        "decision", "rejection_reason",
        "CAST(bureau_score AS INT) AS bureau_score",
        "coalesce(decision = 'approved', false) AS is_approved",
        "coalesce(decision = 'rejected', false) AS is_rejected",
        "bureau_score IS NULL AS is_missing_bureau",
        """CASE WHEN decision = 'approved' AND requested_amount > 0
                THEN rm_rnd(rm_safe_div(approved_amount, requested_amount), 4) END
                AS approval_ratio""",
        """CASE WHEN bureau_score IS NULL THEN 'unknown'
                WHEN bureau_score < 300 THEN 'very_low'
                WHEN bureau_score BETWEEN 300 AND 499 THEN 'low'
                WHEN bureau_score BETWEEN 500 AND 699 THEN 'medium'
                WHEN bureau_score BETWEEN 700 AND 849 THEN 'high'
                ELSE 'very_high' END AS bureau_score_band""",
        "trunc(CAST(proposal_date AS DATE), 'month') AS proposal_month",
    )


@model
def stg_collections(raw: DataFrame) -> DataFrame:
    return raw.selectExpr(
        "collection_id", "contract_id", "customer_id",
        "CAST(trigger_date AS DATE) AS trigger_date",
        "CAST(days_overdue_at_trigger AS INT) AS days_overdue_at_trigger",
        "channel_used", "outcome",
        "CAST(recovery_amount AS DOUBLE) AS recovery_amount",
        "CAST(resolution_days AS INT) AS resolution_days",
        "coalesce(outcome IN ('paid', 'renegotiated'), false) AS is_recovered",
        "outcome IS NULL AS is_missing_outcome",
        """CASE WHEN days_overdue_at_trigger BETWEEN 1 AND 3 THEN 'early_1_3d'
                WHEN days_overdue_at_trigger BETWEEN 4 AND 30 THEN 'early_4_30d'
                WHEN days_overdue_at_trigger BETWEEN 31 AND 90 THEN 'mid_31_90d'
                ELSE 'late_90plus' END AS overdue_bucket""",
        "trunc(CAST(trigger_date AS DATE), 'month') AS trigger_month",
    )


def build_staging(sources: dict[str, DataFrame], as_of=None) -> dict[str, DataFrame]:
    return {
        "stg_customers": stg_customers(sources["customers"], as_of),
        "stg_contracts": stg_contracts(sources["contracts"], as_of),
        "stg_payments": stg_payments(sources["payments"]),
        "stg_app_events": stg_app_events(sources["app_events"]),
        "stg_proposals": stg_proposals(sources["proposals"]),
        "stg_collections": stg_collections(sources["collections"]),
    }
