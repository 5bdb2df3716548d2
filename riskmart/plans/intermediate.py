"""Intermediate tables.

Shape of every model: aggregate each fact table first, then join the small aggregates.  Payments
are brought to one row per contract and month before they meet their contract, and both models
that need the product read that table.  All per-customer aggregates hash-partition on
``customer_id``, so the joins that follow reuse that partitioning.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskmart.functions import (model, dec_avg, flag, from_units, int_avg, lit_date, pct, rnd, safe_div, sum_flag,
                                to_units, units_sum, wide_sum)


def _count_when(cond) -> F.Column:
    return F.sum(F.when(cond, 1).otherwise(0)).cast("long")


@model
def customer_contract_facts(contracts: DataFrame) -> DataFrame:
    """Per-customer contract aggregates used by the credit profile and the acquisition model.

    Sums are exact integer units (cents, 1e-4) with their counts, so every average derived from
    them is the same exact sum / count either model would compute on its own."""
    # first per customer and product, with plain buffers; then the few products of a customer
    by_product = contracts.groupBy("customer_id", "product_type").agg(
        F.count(F.lit(1)).alias("total_contracts"),
        _count_when(F.col("is_active_contract")).alias("active_contracts"),
        _count_when(F.col("is_defaulted")).alias("defaulted_contracts"),
        units_sum("principal_amount").alias("principal_units"),
        units_sum(F.when(F.col("is_settled"), F.col("principal_amount")).otherwise(F.lit(0.0))).alias("settled_units"),
        units_sum("interest_rate", 4).alias("rate_units"),
        F.count("interest_rate").alias("rate_n"),
        units_sum("completion_rate", 4).alias("completion_units"),
        F.count("completion_rate").alias("completion_n"),
        F.sum("installments_total").alias("term_sum"),
        F.count("installments_total").alias("term_n"),
        F.max("contract_date").alias("last_contract_date"),
    )
    added = [c for c in by_product.columns if c not in ("customer_id", "product_type", "last_contract_date")]
    products = F.array_sort(F.collect_list("product_type"))  # leaves nulls out
    return by_product.groupBy("customer_id").agg(
        *[F.sum(c).alias(c) for c in added], F.max("last_contract_date").alias("last_contract_date"),
        F.when(F.size(products) > 0, F.array_join(products, ", ")).alias("product_types"))


@model
def customer_payment_facts(payments: DataFrame, as_of=None) -> DataFrame:
    """Per-customer payment aggregates used by the credit profile and the acquisition model."""
    as_of = lit_date(as_of)
    in_window = F.col("due_month") >= F.trunc(F.add_months(as_of, -12), "month")
    return payments.groupBy("customer_id").agg(
        F.count(F.lit(1)).alias("total_payments"),
        sum_flag("is_defaulted").alias("defaulted_payments"),
        units_sum(F.coalesce(F.col("amount_paid"), F.lit(0.0))).alias("paid_units"),
        units_sum(F.coalesce(F.col("amount_due"), F.lit(0.0))).alias("due_units"),
        F.sum(F.coalesce(F.col("days_late"), F.lit(0))).alias("days_late_sum"),
        _count_when(in_window & ~F.col("is_defaulted")).alias("on_time_last_12m"),
        _count_when(in_window).alias("total_last_12m"),
    )


@model
def int_customer_credit_profile(customers: DataFrame, contracts: DataFrame, payments: DataFrame,
                                as_of=None, contract_facts: DataFrame | None = None,
                                payment_facts: DataFrame | None = None) -> DataFrame:
    """Credit profile per customer.  ``contract_facts`` / ``payment_facts`` may be passed
    pre-computed (the pipeline shares them with ``int_acquisition_quality``)."""
    cf = contract_facts if contract_facts is not None else customer_contract_facts(contracts)
    pf = payment_facts if payment_facts is not None else customer_payment_facts(payments, as_of)
    contract_agg = cf.select(
        "customer_id", "total_contracts", "active_contracts", "defaulted_contracts",
        from_units("principal_units").alias("total_debt"),
        from_units("settled_units").alias("settled_debt"),
        rnd(safe_div(from_units("rate_units", 4), "rate_n"), 4).alias("avg_interest_rate"),
        "last_contract_date", "product_types")
    payment_agg = pf.select(
        "customer_id", "total_payments", "defaulted_payments",
        from_units("paid_units").alias("total_paid"),
        rnd(safe_div("days_late_sum", "total_payments"), 1).alias("avg_days_late"),
        "on_time_last_12m", "total_last_12m")
    c = customers.select("customer_id", "customer_segment", "acquisition_channel", "age_group",
                         "products_count", "is_multi_product", "income_declared")
    j = c.join(contract_agg, "customer_id", "left").join(payment_agg, "customer_id", "left")
    total_contracts = F.coalesce(F.col("total_contracts"), F.lit(0))
    total_12m = F.coalesce(F.col("total_last_12m"), F.lit(0))
    return j.select(
        "customer_id", "customer_segment", "acquisition_channel", "age_group", "products_count",
        "is_multi_product", "income_declared",
        total_contracts.cast("long").alias("total_contracts"),
        F.coalesce("active_contracts", F.lit(0)).cast("long").alias("active_contracts"),
        F.coalesce("defaulted_contracts", F.lit(0)).cast("long").alias("defaulted_contracts"),
        F.coalesce("total_debt", F.lit(0.0)).alias("total_debt"),
        F.coalesce("settled_debt", F.lit(0.0)).alias("settled_debt"),
        "avg_interest_rate", "last_contract_date", "product_types",
        F.coalesce("total_payments", F.lit(0)).cast("long").alias("total_payments"),
        F.coalesce("defaulted_payments", F.lit(0)).cast("long").alias("defaulted_payments"),
        F.coalesce("total_paid", F.lit(0.0)).alias("total_paid"),
        F.coalesce("avg_days_late", F.lit(0.0)).alias("avg_days_late"),
        F.when(total_contracts == 0, F.lit(None).cast("double"))
         .otherwise(rnd(safe_div(F.coalesce("defaulted_contracts", F.lit(0)), F.col("total_contracts")), 4))
         .alias("overall_default_rate"),
        F.when(total_12m == 0, F.lit(0.0))
         .otherwise(rnd(safe_div("on_time_last_12m", "total_last_12m") * F.lit(12.0), 1))
         .alias("best_payment_streak"),
    )


@model
def int_customer_digital_behavior(customers: DataFrame, events: DataFrame) -> DataFrame:
    # days first (combined before the shuffle), then one exchange by customer that the months, the
    # previous month and the join all reuse
    days = events.groupBy("customer_id", "event_month", "event_day").agg(
        F.count(F.lit(1)).alias("n"),
        sum_flag("is_login_event").alias("logins"),
        sum_flag("is_payment_event").alias("payments"),
        sum_flag("is_offer_event").alias("offers"),
        F.sum("session_duration_seconds").alias("seconds"),
        F.count("session_duration_seconds").alias("timed"),
    ).repartition("customer_id")
    monthly = days.groupBy("customer_id", "event_month").agg(
        F.sum("n").alias("events_total"),
        F.sum("logins").alias("logins_count"),
        F.sum("payments").alias("payment_events"),
        F.sum("offers").alias("offer_events"),
        F.count("event_day").alias("active_days"),
        rnd(safe_div(F.sum("seconds"), F.sum("timed")), 0).alias("avg_session_seconds"),
        F.max("event_day").alias("last_event_day"),
    )
    # previous *active* month of the same customer (months without events are skipped);
    # partitioned by customer, so a window holds at most one row per calendar month
    w = Window.partitionBy("customer_id").orderBy("event_month")
    monthly = monthly.withColumn("prev_month_events", F.lag("events_total").over(w))
    score = F.least(
        F.lit(100.0),
        rnd(F.col("logins_count") * 5.0 + F.col("payment_events") * 15.0 + F.col("active_days") * 3.0
            + F.least(F.col("avg_session_seconds"), F.lit(600.0)) / F.lit(600.0) * F.lit(20.0), 0))
    prev = F.col("prev_month_events")
    total = F.col("events_total")
    trend = (F.when(prev.isNull(), "new")
             .when(total * 10 > prev * 11, "growing")      # total > 1.1 * prev, exact in integers
             .when(total * 2 < prev, "declining")          # total < 0.5 * prev
             .otherwise("stable"))
    scored = monthly.select(
        "customer_id", "event_month", "logins_count", "payment_events", "offer_events", "active_days",
        "avg_session_seconds", "last_event_day", "events_total", "prev_month_events",
        F.datediff(F.last_day("event_month"), F.col("last_event_day")).alias("days_since_last_login"),
        score.alias("app_engagement_score"),
        trend.alias("trend_30d"),
    )
    c = customers.select("customer_id", "customer_segment", "acquisition_channel")
    return scored.join(c, "customer_id", "left")


@model
def contract_months(payments: DataFrame, contracts: DataFrame) -> DataFrame:
    """One row per contract and month of its payments, with the contract's product and principal.

    ``int_payment_performance`` and ``fct_portfolio_health`` both add it up, so the payments are
    shuffled by contract once.  Money is in cents."""
    # column that a measure needs -> measures; a table with fewer columns gets fewer measures
    measures = {
        "is_defaulted": [sum_flag("is_defaulted").alias("n_defaulted")],
        "is_late": [sum_flag("is_late").alias("n_late")],
        "amount_due": [units_sum(F.coalesce(F.col("amount_due"), F.lit(0.0))).alias("due_units")],
        "amount_paid": [units_sum(F.coalesce(F.col("amount_paid"), F.lit(0.0))).alias("paid_units")],
        "days_late": [F.sum(F.when(F.col("days_late") > 0, F.col("days_late"))).alias("days_sum"),
                      _count_when(F.col("days_late") > 0).alias("days_n")],
        "lateness_bucket": [F.max(F.when(F.col("lateness_bucket") == "90+_days", 1).otherwise(0)).alias("any_90plus")],
    }
    by_month = payments.groupBy("contract_id", "due_month", "due_year", "due_month_num").agg(
        F.count(F.lit(1)).alias("n_rows"),
        *[m for need, found in measures.items() if need in payments.columns for m in found])
    c = contracts.select(F.col("contract_id").alias("known_contract"), "product_type", *[
        to_units(x).alias("principal_units") for x in ("principal_amount",) if x in contracts.columns])
    return by_month.join(c, by_month["contract_id"] == c["known_contract"], "left")


@model
def int_payment_performance(payments: DataFrame, contracts: DataFrame,
                            months: DataFrame | None = None) -> DataFrame:
    """``months`` may be the ready ``contract_months`` table."""
    months = contract_months(payments, contracts) if months is None else months
    paid, due = wide_sum("paid_units"), wide_sum("due_units")
    monthly = months.groupBy("due_month", "due_year", "due_month_num", "product_type").agg(
        F.sum("n_rows").alias("total_payments"),
        F.sum("n_defaulted").alias("defaulted_count"),
        F.sum("n_late").alias("late_count"),
        due.alias("total_amount_due"),
        paid.alias("total_amount_paid"),
        rnd(safe_div(F.sum("days_sum"), F.sum("days_n")), 1).alias("avg_days_late"),
        pct(F.sum("n_defaulted"), F.sum("n_rows"), 2).alias("default_rate_pct"),
        pct(paid, due, 2).alias("recovery_rate_pct"),
    )
    # a few dozen months x 4 products: the window below works on the already-aggregated table
    w = Window.partitionBy("due_year", "product_type")
    rate = F.col("default_rate_pct")
    year_avg = (from_units(F.sum(to_units(rate, 2)).over(w), 2)
                / F.nullif(F.count(rate).over(w).cast("double"), F.lit(0.0)))
    return monthly.select(
        "*",
        rnd(safe_div(rate, year_avg), 3).alias("seasonal_index"),
        flag(F.col("due_month_num").isin(1, 2)).alias("is_high_season"),
    )


@model
def int_acquisition_quality(customers: DataFrame, contracts: DataFrame, payments: DataFrame,
                            proposals: DataFrame, contract_facts: DataFrame | None = None,
                            payment_facts: DataFrame | None = None) -> DataFrame:
    proposal_agg = proposals.groupBy("customer_id").agg(
        F.count(F.lit(1)).alias("total_proposals"),
        sum_flag("is_approved").alias("approved_proposals"),
    )
    cf = contract_facts if contract_facts is not None else customer_contract_facts(contracts)
    pf = payment_facts if payment_facts is not None else customer_payment_facts(payments)
    contract_agg = cf.select(
        "customer_id", "total_contracts", "defaulted_contracts",
        F.col("principal_units").alias("total_principal"),  # cents
        rnd(safe_div(from_units("completion_units", 4), "completion_n"), 4).alias("avg_completion_rate"),
        rnd(safe_div("term_sum", "term_n"), 1).alias("avg_term_months"))
    payment_agg = pf.select("customer_id", F.col("paid_units").alias("total_paid"))  # cents
    c = customers.select("customer_id", "acquisition_channel", "income_declared")
    zero_units = F.lit(0).cast("long")  # money below is in cents
    cl = (c.join(proposal_agg, "customer_id", "left")
           .join(contract_agg, "customer_id", "left")
           .join(payment_agg, "customer_id", "left")
           .select("customer_id", "acquisition_channel", "income_declared",
                   F.coalesce("total_proposals", F.lit(0)).alias("total_proposals"),
                   F.coalesce("approved_proposals", F.lit(0)).alias("approved_proposals"),
                   F.coalesce("total_contracts", F.lit(0)).alias("total_contracts"),
                   F.coalesce("defaulted_contracts", F.lit(0)).alias("defaulted_contracts"),
                   F.coalesce("total_principal", zero_units).alias("total_principal"),
                   "avg_completion_rate", "avg_term_months",
                   F.coalesce("total_paid", zero_units).alias("total_paid")))
    payback = F.when(F.col("avg_term_months").isNotNull(),
                     F.col("avg_term_months") * F.coalesce(F.col("avg_completion_rate"), F.lit(0.0)))
    return cl.groupBy("acquisition_channel").agg(
        # rows are one per customer already (a tested key), so plain counts do
        F.count("customer_id").alias("total_customers"),
        pct(F.sum("approved_proposals"), F.sum("total_proposals"), 2).alias("approval_rate_pct"),
        pct(F.sum("defaulted_contracts"), F.sum("total_contracts"), 2).alias("default_rate_pct"),
        rnd(safe_div(wide_sum("total_principal"), F.sum("total_contracts")), 2).alias("avg_ticket"),
        rnd(safe_div(wide_sum("total_paid"), F.count(F.when(F.col("total_contracts") > 0, F.col("customer_id")))), 2)
         .alias("avg_ltv"),
        rnd(dec_avg(payback, 5), 1).alias("avg_payback_months"),
        rnd(dec_avg("income_declared", 2), 2).alias("avg_income"),
    )


def build_intermediate(stg: dict[str, DataFrame], as_of=None) -> dict[str, DataFrame]:
    """The four intermediate models as lazy DataFrames (each computes its own facts)."""
    return {
        "int_customer_credit_profile": int_customer_credit_profile(
            stg["stg_customers"], stg["stg_contracts"], stg["stg_payments"], as_of),
        "int_customer_digital_behavior": int_customer_digital_behavior(stg["stg_customers"], stg["stg_app_events"]),
        "int_payment_performance": int_payment_performance(stg["stg_payments"], stg["stg_contracts"]),
        "int_acquisition_quality": int_acquisition_quality(
            stg["stg_customers"], stg["stg_contracts"], stg["stg_payments"], stg["stg_proposals"]),
    }
