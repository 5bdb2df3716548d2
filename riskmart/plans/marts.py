"""Marts (I11–I15).

Global orderings (income percentile, LTV quartile, R/F/M quartiles) use the distributed
ranking operator instead of a single-partition window.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskmart.functions import model, dec_avg, dec_sum, flag, int_avg, lit_date, pct, rnd, sum_flag, wide_sum
from riskmart.operators.ranking import dist_ntile, dist_percent_rank
from riskmart.plans.intermediate import contract_months
from riskmart.session import checkpoint_table

# Age-group score of the profile component.
AGE_SCORES = {"18-25": 75, "26-35": 80, "36-45": 65, "46-60": 70, "60+": 72}
AGE_SCORE_OTHER = 50


@model
def latest_behavior(behavior: DataFrame) -> DataFrame:
    """Latest active month per customer: the months join back on (customer, month), one row per pair."""
    latest = behavior.groupBy("customer_id").agg(F.max("event_month").alias("event_month"))
    return behavior.join(latest, ["customer_id", "event_month"], "left_semi").select(
        "customer_id", "app_engagement_score", "days_since_last_login", "trend_30d")


@model
def fct_credit_score(profile: DataFrame, behavior: DataFrame, customers: DataFrame) -> DataFrame:
    income = dist_percent_rank(customers.select("customer_id", "income_declared"), "income_declared", "_prank",
                               id_col="customer_id").select(
        "customer_id", (F.col("_prank") * F.lit(100.0)).alias("income_pct"))
    # profile carries the customer's age_group already (it is built from the same customers)
    j = (profile.join(latest_behavior(behavior), "customer_id", "left")
                .join(income, "customer_id", "left"))
    age = F.col("age_group")
    age_score = F.lit(AGE_SCORE_OTHER)
    for group, points in reversed(list(AGE_SCORES.items())):
        age_score = F.when(age == group, F.lit(points)).otherwise(age_score)
    j = j.select(
        "customer_id", "customer_segment", "acquisition_channel", "age_group", "products_count",
        "is_multi_product", "total_contracts", "overall_default_rate", "avg_days_late",
        "best_payment_streak", "total_debt", "total_paid",
        F.coalesce(F.col("app_engagement_score"), F.lit(0.0)).alias("app_engagement_score"),
        F.coalesce(F.col("days_since_last_login"), F.lit(30)).alias("days_since_last_login"),
        F.coalesce(F.col("trend_30d"), F.lit("stable")).alias("trend_30d"),
        F.coalesce(F.col("income_pct"), F.lit(0.0)).alias("income_pct"),
        age_score.alias("age_score"),
    )
    comp = j.select(
        "*",
        rnd((F.lit(1.0) - F.coalesce(F.col("overall_default_rate"), F.lit(0.0))) * F.lit(400.0), 0)
         .alias("component_payment"),
        rnd(F.col("app_engagement_score") * F.lit(2.5), 0).alias("component_digital"),
        rnd((F.col("age_score") * F.lit(0.5) + F.col("income_pct") * F.lit(0.5)) * F.lit(2.0), 0)
         .alias("component_profile"),
        rnd(F.least(F.col("products_count"), F.lit(4)) / F.lit(4.0) * F.lit(150.0), 0)
         .alias("component_diversification"),
    )
    raw = (F.col("component_payment") + F.col("component_digital") + F.col("component_profile")
           + F.col("component_diversification"))
    comp = comp.withColumn("_raw", raw)
    raw = F.col("_raw")
    tier = (F.when(raw >= 800, "very_low").when(raw >= 600, "low").when(raw >= 400, "medium")
            .when(raw >= 200, "high").otherwise("very_high"))
    return comp.select(
        "customer_id", "customer_segment", "acquisition_channel", "age_group", "products_count",
        "is_multi_product", "total_contracts", "overall_default_rate", "avg_days_late",
        "best_payment_streak", "app_engagement_score", "days_since_last_login", "trend_30d",
        "income_pct", "total_debt", "total_paid",
        "component_payment", "component_digital", "component_profile", "component_diversification",
        F.least(F.lit(1000.0), F.greatest(F.lit(0.0), raw)).alias("credit_score"),
        tier.alias("risk_tier"),  # tiers use the unclamped sum
        flag((raw < 400) & (F.col("app_engagement_score") < 30)).alias("alert_30d"),
    )


@model
def fct_customer_ltv(profile: DataFrame, acquisition: DataFrame) -> DataFrame:
    # one row per acquisition channel: bounded by the channel domain
    channel = acquisition.select(
        "acquisition_channel",
        F.col("avg_ltv").alias("channel_avg_ltv"),
        F.col("default_rate_pct").alias("channel_default_rate"),
        F.col("avg_ticket").alias("channel_avg_ticket"))
    net = F.col("total_paid") - F.col("total_debt")
    calc = (profile.select("customer_id", "customer_segment", "acquisition_channel", "total_debt", "total_paid",
                           "total_contracts", "active_contracts", "avg_interest_rate")
            .join(channel, "acquisition_channel", "left")
            .select("customer_id", "customer_segment", "acquisition_channel", "total_contracts",
                    "active_contracts", "total_debt", "total_paid", "avg_interest_rate",
                    rnd(net, 2).alias("realized_ltv"),
                    rnd(net * F.lit(1.2), 2).alias("projected_ltv_12m"),
                    "channel_avg_ltv", "channel_default_rate", "channel_avg_ticket"))
    # written once: the quartile borders and the result both read it
    calc = checkpoint_table(calc, "riskmart-ltv")
    q = calc.withColumn("ltv_quartile", dist_ntile(calc, 4, "realized_ltv", "customer_id"))
    seg = (F.when(F.col("ltv_quartile") == 1, "low").when(F.col("ltv_quartile") == 2, "medium")
           .when(F.col("ltv_quartile") == 3, "high").when(F.col("ltv_quartile") == 4, "champion"))
    return q.select(
        "customer_id", "customer_segment", "acquisition_channel", "total_contracts", "active_contracts",
        "total_debt", "total_paid", "avg_interest_rate", "realized_ltv", "projected_ltv_12m",
        "channel_avg_ltv", "channel_default_rate", "channel_avg_ticket", "ltv_quartile",
        seg.alias("ltv_segment"),
        rnd(F.col("realized_ltv") - F.coalesce(F.col("channel_avg_ltv"), F.lit(0.0)), 2).alias("ltv_vs_channel_avg"),
    )


@model
def fct_portfolio_health(payments: DataFrame, contracts: DataFrame, months: DataFrame | None = None) -> DataFrame:
    """``months`` may be the ready ``contract_months`` table."""
    per_contract = contract_months(payments, contracts) if months is None else months
    # a contract has one row per month: plain sums replace four count(distinct ...)
    cid = F.col("known_contract")
    contracts_n = F.count(cid)
    monthly = per_contract.groupBy(F.col("due_month").alias("mes"), "due_month_num", "due_year").agg(
        contracts_n.alias("total_active_contracts"),
        # exposure counts the principal once per payment row (the fixed rule's fan-out)
        rnd(wide_sum(F.col("principal_units") * F.col("n_rows")), 2).alias("total_exposure"),
        wide_sum("due_units").alias("total_amount_due"),
        pct(F.sum("n_defaulted"), F.sum("n_rows"), 2).alias("default_rate"),
        pct(F.count(F.when(F.col("any_90plus") == 1, cid)), contracts_n, 2).alias("npl_ratio"),
        pct(F.count(F.when(F.col("product_type") == "personal_loan", cid)), contracts_n, 1)
         .alias("pct_personal_loan"),
        pct(F.count(F.when(F.col("product_type") == "vehicle_financing", cid)), contracts_n, 1)
         .alias("pct_vehicle_financing"),
    )
    # one row per calendar month: a global window over this table is bounded by the calendar
    w = Window.orderBy("mes")
    return monthly.select(
        "*",
        flag(F.col("due_month_num").isin(1, 2)).alias("is_peak_month"),
        rnd(F.col("default_rate") - F.lag("default_rate").over(w), 2).alias("default_rate_mom_delta"),
    )


@model
def fct_collection_efficiency(collections: DataFrame) -> DataFrame:
    d = F.col("days_overdue_at_trigger")
    bucket = (F.when(d.between(1, 7), "early").when(d.between(8, 30), "mid")
              .when(d.between(31, 90), "late").otherwise("bad"))
    rec = F.coalesce(F.col("recovery_amount"), F.lit(0.0))
    agg = collections.withColumn("trigger_bucket", bucket).groupBy("channel_used", "trigger_bucket").agg(
        F.count(F.lit(1)).alias("total_actions"),
        sum_flag("is_recovered").alias("recovered_count"),
        sum_flag("is_missing_outcome").alias("missing_outcome_count"),
        pct(sum_flag("is_recovered"), F.count(F.lit(1)), 2).alias("recovery_rate_pct"),
        rnd(int_avg(F.when(F.col("is_recovered"), F.col("resolution_days"))), 1).alias("avg_resolution_days"),
        rnd(dec_sum(rec), 2).alias("total_recovered_amount"),
        rnd(dec_avg(rec), 2).alias("avg_recovery_amount"),
        rnd(int_avg(d), 1).alias("avg_days_overdue"),
    )
    # channel x bucket rows: bounded by the two value domains; ties broken by bucket name
    w = Window.partitionBy("channel_used").orderBy(F.col("recovery_rate_pct").desc_nulls_last(),
                                                   F.col("trigger_bucket").asc())
    best = (agg.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") == 1)
               .select("channel_used", F.col("trigger_bucket").alias("best_trigger_bucket"),
                       F.col("recovery_rate_pct").alias("best_recovery_rate")))
    return (agg.join(best, "channel_used", "left")
               .withColumn("is_best_window", flag(F.col("trigger_bucket") == F.col("best_trigger_bucket"))))


def rfm_segment(code):
    """Segment rule over the three-digit RFM code; the rule order matters (first match wins)."""
    return (F.when(code.isin("444", "443", "434", "344"), "champion")
            .when(code.like("3%3%") | code.like("4%3%") | code.like("3%4%"), "loyal")
            .when(code.like("2%") | code.isin("314", "313", "312", "311"), "at_risk")
            .when(code.like("1%"), "lost")
            .otherwise("promising"))


@model
def fct_risk_segments(payments: DataFrame, customers: DataFrame, as_of=None,
                      recent_is_best: bool = False) -> DataFrame:
    as_of = lit_date(as_of)
    p = payments.where(F.col("payment_date").isNotNull() | (F.col("status") == "defaulted"))
    agg = p.groupBy("customer_id").agg(
        F.datediff(as_of, F.max(F.coalesce(F.col("payment_date"), F.col("due_date")))).alias("days_since_last_payment"),
        pct(F.sum(F.when(~F.col("is_late") & ~F.col("is_defaulted"), 1).otherwise(0)), F.count(F.lit(1)), 1)
         .alias("on_time_rate_pct"),
        rnd(dec_avg(F.coalesce(F.col("amount_paid"), F.lit(0.0))), 2).alias("avg_amount_paid"),
        F.count(F.lit(1)).alias("total_payments"),
        sum_flag("is_defaulted").alias("total_defaults"),
    )
    # one row per customer, written once: the borders of the three quartiles are found concurrently
    agg = checkpoint_table(agg, "riskmart-rfm")
    passes = {"_r": ("days_since_last_payment", False), "f_score": ("on_time_rate_pct", True),
              "m_score": ("avg_amount_paid", True)}
    with ThreadPoolExecutor(max_workers=3) as pool:
        tiles = pool.map(lambda p: dist_ntile(agg, 4, p[0], "customer_id", p[1]), passes.values())
        m = agg.withColumns(dict(zip(passes, tiles)))
    # by default R keeps the fixed direction: 5 - ntile over recency DESC gives 4 to the oldest payers
    r = F.col("_r") if recent_is_best else F.lit(5) - F.col("_r")
    scored = m.withColumn("r_score", r.cast("int"))
    code = F.concat(F.col("r_score").cast("string"), F.col("f_score").cast("string"), F.col("m_score").cast("string"))
    scored = scored.withColumn("rfm_score", code).withColumn(
        "rfm_total", F.col("r_score") + F.col("f_score") + F.col("m_score"))
    scored = scored.withColumn("segment", rfm_segment(F.col("rfm_score")))
    c = customers.select("customer_id", "customer_segment", "acquisition_channel", "age_group", "products_count")
    return scored.join(c, "customer_id", "left").select(
        "customer_id", "customer_segment", "acquisition_channel", "age_group", "products_count",
        "days_since_last_payment", "on_time_rate_pct", "avg_amount_paid", "total_payments", "total_defaults",
        "r_score", "f_score", "m_score", "rfm_score", "rfm_total", "segment",
    )
