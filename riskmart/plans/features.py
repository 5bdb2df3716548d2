"""ML feature tables (L1–L7): one row per customer.

Each source is filtered to its point-in-time window *before* aggregating (the filters reach
the Parquet scan), aggregated to the customer grain, and the small per-customer aggregates
are left-joined to the customer dimension — all joins on ``customer_id``.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskmart.functions import model, dec_avg, dec_sum, int_avg, lit_date, rnd, safe_div

# Reference parameters: cut-off, label window end, "recent" start and event window.
CUTOFF = dt.date(2024, 6, 30)
LABEL_END = dt.date(2024, 9, 30)
RECENT_START = dt.date(2024, 4, 1)
EVENT_START = dt.date(2024, 4, 1)
EVENT_END = dt.date(2024, 6, 30)

DEFAULT_NUMERIC = [
    "late_count_hist", "total_payments_hist", "max_days_late_hist", "avg_days_late_hist", "late_rate_hist",
    "late_count_90d", "payment_ratio_hist", "total_contracts_hist", "total_debt_hist", "avg_completion_rate",
    "contracts_defaulted_hist", "has_collateral", "events_90d", "logins_90d", "bureau_score",
    "income_declared", "products_count",
]
ALERT_NUMERIC = [
    "overall_default_rate", "avg_days_late", "app_engagement_score", "days_since_last_login",
    "products_count", "income_declared", "best_payment_streak", "total_contracts",
]
CATEGORICAL = ["acquisition_channel", "age_group", "customer_segment"]


def _count_when(cond) -> F.Column:
    return F.count(F.when(cond, 1))


@model
def default_features(stg: dict[str, DataFrame], cutoff=CUTOFF, label_end=LABEL_END,
                     recent_start=RECENT_START, event_start=EVENT_START, event_end=EVENT_END) -> DataFrame:
    """Point-in-time features at ``cutoff`` and the label "any payment due in
    (cutoff, label_end] with days_late >= 30" (L1–L6), numerics with nulls filled by 0."""
    cutoff, label_end = lit_date(cutoff), lit_date(label_end)
    # one pass over payments (the largest table) for both the history features and the label;
    # nothing after label_end matters, and that filter reaches the scan
    pays = stg["stg_payments"].where(F.col("due_date") <= label_end)
    hist = F.col("due_date") <= cutoff
    late = hist & F.col("is_late")
    pay_hist = pays.groupBy("customer_id").agg(
        F.count(F.when(hist, 1)).alias("total_payments_hist"),
        _count_when(late).alias("late_count_hist"),
        F.max(F.when(hist, F.col("days_late"))).alias("max_days_late_hist"),
        int_avg(F.when(hist, F.col("days_late"))).alias("avg_days_late_hist"),
        dec_sum(F.when(hist, F.col("amount_paid"))).alias("total_paid_hist"),
        dec_sum(F.when(hist, F.col("amount_due"))).alias("total_due_hist"),
        _count_when((F.col("due_date") >= lit_date(recent_start)) & late).alias("late_count_90d"),
        rnd(safe_div(_count_when(late), F.count(F.when(hist, 1))), 4).alias("late_rate_hist"),
        F.max(F.when((F.col("due_date") > cutoff) & (F.col("due_date") <= label_end) & (F.col("days_late") >= 30), 1)
              .otherwise(0)).alias("defaulted_after"),
    )
    con_hist = stg["stg_contracts"].where(F.col("contract_date") <= cutoff).groupBy("customer_id").agg(
        F.count(F.lit(1)).alias("total_contracts_hist"),
        dec_sum("principal_amount").alias("total_debt_hist"),
        dec_avg("completion_rate", 4).alias("avg_completion_rate"),
        _count_when(F.col("is_defaulted")).alias("contracts_defaulted_hist"),
        F.max(F.when(F.col("has_collateral"), 1).otherwise(0)).alias("has_collateral"),
    )
    # timestamp BETWEEN date AND date: the upper bound is midnight of the end day
    ev_lo = F.lit(dt.datetime.combine(event_start, dt.time())).cast("timestamp_ntz")
    ev_hi = F.lit(dt.datetime.combine(event_end, dt.time())).cast("timestamp_ntz")
    ev = stg["stg_app_events"].where(F.col("event_date").between(ev_lo, ev_hi)).groupBy("customer_id").agg(
        F.count(F.lit(1)).alias("events_90d"),
        _count_when(F.col("event_type") == "login").alias("logins_90d"),
    )
    bureau = stg["stg_proposals"].groupBy("customer_id").agg(F.max("bureau_score").alias("bureau_score"))
    c = stg["stg_customers"].select("customer_id", "acquisition_channel", "age_group",
                                    F.coalesce("income_declared", F.lit(0.0)).alias("income_declared"),
                                    "products_count", "customer_segment")
    j = (c.join(pay_hist, "customer_id", "left").join(con_hist, "customer_id", "left")
          .join(ev, "customer_id", "left").join(bureau, "customer_id", "left"))
    due = F.coalesce(F.col("total_due_hist"), F.lit(0.0))
    out = j.select(
        "customer_id", "acquisition_channel", "age_group", "income_declared", "products_count", "customer_segment",
        F.coalesce("late_count_hist", F.lit(0)).alias("late_count_hist"),
        F.coalesce("total_payments_hist", F.lit(0)).alias("total_payments_hist"),
        F.coalesce("max_days_late_hist", F.lit(0)).alias("max_days_late_hist"),
        F.coalesce("avg_days_late_hist", F.lit(0.0)).alias("avg_days_late_hist"),
        F.coalesce("late_rate_hist", F.lit(0.0)).alias("late_rate_hist"),
        F.coalesce("late_count_90d", F.lit(0)).alias("late_count_90d"),
        F.when(due > 0, F.col("total_paid_hist") / F.col("total_due_hist")).otherwise(F.lit(1.0))
         .alias("payment_ratio_hist"),
        F.coalesce("total_contracts_hist", F.lit(0)).alias("total_contracts_hist"),
        F.coalesce("total_debt_hist", F.lit(0.0)).alias("total_debt_hist"),
        F.coalesce("avg_completion_rate", F.lit(0.0)).alias("avg_completion_rate"),
        F.coalesce("contracts_defaulted_hist", F.lit(0)).alias("contracts_defaulted_hist"),
        F.coalesce("has_collateral", F.lit(0)).alias("has_collateral"),
        F.coalesce("events_90d", F.lit(0)).alias("events_90d"),
        F.coalesce("logins_90d", F.lit(0)).alias("logins_90d"),
        F.coalesce("bureau_score", F.lit(600)).alias("bureau_score"),
        F.coalesce("defaulted_after", F.lit(0)).alias("target"),
    )
    # the training frame's fillna(0): numeric columns only
    return out.fillna(0)


@model
def alert_features(score: DataFrame, stg_customers: DataFrame) -> DataFrame:
    """Second feature set (L7): the score mart plus declared income; label ``alert_30d``."""
    c = stg_customers.select("customer_id", F.col("income_declared").alias("_income"))
    return (score.where(F.col("customer_id").isNotNull()).join(c, "customer_id", "left").select(
        "customer_id", "alert_30d",
        F.coalesce("overall_default_rate", F.lit(0.0)).alias("overall_default_rate"),
        F.coalesce("avg_days_late", F.lit(0.0)).alias("avg_days_late"),
        F.coalesce("app_engagement_score", F.lit(0.0)).alias("app_engagement_score"),
        F.coalesce("days_since_last_login", F.lit(30)).alias("days_since_last_login"),
        F.coalesce("products_count", F.lit(1)).alias("products_count"),
        F.coalesce("best_payment_streak", F.lit(0.0)).alias("best_payment_streak"),
        F.coalesce("total_contracts", F.lit(0)).alias("total_contracts"),
        F.coalesce("_income", F.lit(0.0)).alias("income_declared"),
        "acquisition_channel", "age_group", "customer_segment"))
