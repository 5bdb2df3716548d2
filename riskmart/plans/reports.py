"""Named report queries (K1–K36) over the marts, intermediate and staging tables.

Every report reads whole tables; Catalyst prunes each scan to the handful of columns used and
pushes the filters into the reader.  Shares of a total (``count * 100 / sum(count) over ()``)
are computed on the already-grouped table, whose size is fixed by a value domain (tiers,
segments, buckets), so that window is tiny.  Every report with more than one row is ordered; names
or ids break ties, so that the order and ``limit`` are deterministic.  Result column names and
band labels are fixed values.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskmart.functions import model, dec_avg, int_avg, lit_date, rnd, safe_div, to_units, wide_sum

# Reference parameters (the fixture family passes its own values, see ``sources.fixtures``).
SINCE = dt.date(2023, 1, 1)
# Labels of peak and other months.
PERIODS = {True: "Jan/Fev (Pico)", False: "Normal"}
MIN_MONTH_CONTRACTS = 1000


def _count_when(cond: Column) -> Column:
    return F.sum(F.when(cond, 1).otherwise(0)).cast("long")


def _share(count_col: str = "n") -> Column:
    """round(count * 100 / total, 1) over a domain-bounded grouped table."""
    return rnd(F.col(count_col).cast("double") * F.lit(100.0) / F.sum(count_col).over(Window.partitionBy()), 1)


# ---- index page --------------------------------------------------------------------------
@model
def portfolio_kpis(stg_contracts: DataFrame) -> DataFrame:
    c = stg_contracts.where(F.col("status") == "active")
    return c.agg(
        rnd(wide_sum(to_units("principal_amount")) / F.lit(1e9), 2).alias("carteira_bi"),
        F.countDistinct("customer_id").alias("total_contratos"),
        rnd(dec_avg("interest_rate", 4) * F.lit(100.0), 2).alias("taxa_media_pct"),
    )


@model
def default_rate(portfolio: DataFrame, since=SINCE) -> DataFrame:
    p = portfolio.where(F.col("mes") >= lit_date(since))
    rate, peak = F.col("default_rate"), F.col("is_peak_month")
    return p.agg(
        rnd(dec_avg(rate, 2), 2).alias("inadimplencia_media"),
        rnd(F.max(F.when(peak, rate)), 2).alias("inadimplencia_pico"),
        rnd(dec_avg(F.when(~peak, rate), 2), 2).alias("inadimplencia_offpeak"),
    )


@model
def active_customers(stg_customers: DataFrame) -> DataFrame:
    return stg_customers.where(F.col("is_active")).agg(F.count(F.lit(1)).alias("clientes_ativos"))


@model
def ltv_summary(ltv: DataFrame) -> DataFrame:
    seg, v = F.col("ltv_segment"), F.col("realized_ltv")
    return ltv.agg(
        rnd(dec_avg(F.when(seg == "champion", v), 2), 0).alias("ltv_champion"),
        rnd(dec_avg(F.when(seg == "high", v), 2), 0).alias("ltv_high"),
        F.count(F.when(seg == "champion", 1)).alias("n_champions"),
    )


@model
def monthly_default(portfolio: DataFrame, since=SINCE) -> DataFrame:
    out = portfolio.where(F.col("mes") >= lit_date(since)).select(
        F.col("mes").cast("string").alias("mes"), "default_rate", "npl_ratio", "is_peak_month",
        F.when(F.col("is_peak_month"), F.col("default_rate")).alias("peak_rate"))
    return out.orderBy("mes")


@model
def product_risk(performance: DataFrame) -> DataFrame:
    out = performance.groupBy("product_type").agg(
        rnd(dec_avg("default_rate_pct", 2), 2).alias("default_rate"),
        rnd(dec_avg("recovery_rate_pct", 2), 2).alias("recovery_rate"),
        F.sum("total_payments").alias("total_pagamentos"))
    return out.orderBy(F.col("default_rate").desc(), "product_type")


@model
def exposure_monthly(portfolio: DataFrame, since=SINCE) -> DataFrame:
    out = portfolio.where(F.col("mes") >= lit_date(since)).select(
        F.col("mes").cast("string").alias("mes"),
        rnd(F.col("total_exposure") / F.lit(1e6), 1).alias("exposicao_mm"),
        "total_active_contracts", "is_peak_month")
    return out.orderBy("mes")


# ---- predictions page ----------------------------------------------------------------------
@model
def score_dist_detail(score: DataFrame, k: int = 500) -> DataFrame:
    return (score.orderBy(F.col("credit_score").asc(), F.col("customer_id").asc()).limit(k)
            .select("risk_tier", "credit_score", "alert_30d", "overall_default_rate", "app_engagement_score"))


@model
def score_buckets(score: DataFrame) -> DataFrame:
    bucket = (F.floor(F.col("credit_score") / F.lit(50.0)) * F.lit(50)).cast("double")
    out = score.groupBy(bucket.alias("score_bucket")).agg(
        F.count(F.lit(1)).alias("clientes"), _count_when(F.col("alert_30d")).alias("em_alerta"))
    return out.orderBy("score_bucket")


@model
def optimal_collection(collection: DataFrame, k: int = 10) -> DataFrame:
    return (collection.orderBy(F.col("recovery_rate_pct").desc(), "channel_used", "trigger_bucket").limit(k)
            .select(F.col("trigger_bucket").alias("janela"), F.col("channel_used").alias("canal"),
                    F.col("recovery_rate_pct").alias("recuperacao_pct"),
                    F.col("avg_resolution_days").alias("dias_resolucao"), F.col("total_actions").alias("volume")))


# ---- risk page -----------------------------------------------------------------------------
@model
def score_distribution(score: DataFrame) -> DataFrame:
    s = F.col("credit_score")
    band = (F.when(s < 200, "0-200").when(s < 400, "200-400").when(s < 600, "400-600")
            .when(s < 800, "600-800").otherwise("800-1000"))
    g = score.groupBy(band.alias("faixa")).agg(F.count(F.lit(1)).alias("n"))
    out = g.select("faixa", F.col("n").alias("clientes"), _share().alias("pct"))
    return out.orderBy("faixa")


@model
def risk_tier_summary(score: DataFrame) -> DataFrame:
    g = score.groupBy("risk_tier").agg(
        F.count(F.lit(1)).alias("n"),
        rnd(int_avg("credit_score"), 0).alias("score_medio"),
        _count_when(F.col("alert_30d")).alias("em_alerta"))
    out = g.select("risk_tier", F.col("n").alias("n_clientes"), _share().alias("pct"), "score_medio", "em_alerta")
    return out.orderBy(F.col("score_medio").desc(), "risk_tier")


@model
def channel_risk(acquisition: DataFrame) -> DataFrame:
    out = acquisition.select(
        "acquisition_channel", rnd("default_rate_pct", 2).alias("inadimplencia"),
        rnd("avg_ltv", 0).alias("ltv_medio"), "total_customers", rnd("approval_rate_pct", 1).alias("taxa_aprovacao"))
    return out.orderBy(F.col("inadimplencia").desc(), "acquisition_channel")


@model
def alerts_detail(score: DataFrame, k: int = 100) -> DataFrame:
    return (score.where(F.col("alert_30d")).orderBy(F.col("credit_score").asc(), F.col("customer_id").asc()).limit(k)
            .select("customer_id", "risk_tier", "credit_score", "app_engagement_score", "overall_default_rate",
                    "acquisition_channel", "age_group", "avg_days_late"))


@model
def vintage_analysis(stg_contracts: DataFrame) -> DataFrame:
    cohort = F.date_trunc("quarter", F.col("contract_date")).cast("string")
    out = stg_contracts.groupBy(cohort.alias("coorte_trimestre"), "product_type").agg(
        F.count(F.lit(1)).alias("contratos"),
        rnd(safe_div(_count_when(F.col("is_defaulted")) * F.lit(100.0), F.count(F.lit(1))), 2).alias("default_rate"))
    return out.orderBy("coorte_trimestre", "product_type")


@model
def collection_eff(collection: DataFrame) -> DataFrame:
    out = collection.select(
        F.col("channel_used").alias("canal"), F.col("trigger_bucket").alias("janela"),
        F.col("recovery_rate_pct").alias("recuperacao_pct"), F.col("avg_resolution_days").alias("dias_resolucao"),
        F.col("total_actions").alias("acoes"), F.col("is_best_window").alias("melhor_janela"))
    return out.orderBy(F.col("recuperacao_pct").desc(), "canal", "janela")


# ---- segments page -------------------------------------------------------------------------
@model
def rfm_overview(segments: DataFrame) -> DataFrame:
    g = segments.groupBy("segment").agg(
        F.count(F.lit(1)).alias("n"),
        rnd(dec_avg("on_time_rate_pct", 1), 1).alias("pontualidade_media"),
        rnd(dec_avg("avg_amount_paid", 2), 0).alias("ticket_medio"),
        rnd(int_avg(F.col("r_score") + F.col("f_score") + F.col("m_score")), 1).alias("rfm_total_medio"))
    out = g.select("segment", F.col("n").alias("clientes"), _share().alias("pct"), "pontualidade_media",
                    "ticket_medio", "rfm_total_medio")
    return out.orderBy(F.col("rfm_total_medio").desc(), "segment")


@model
def ltv_by_segment_channel(ltv: DataFrame, k: int = 20) -> DataFrame:
    g = ltv.groupBy("ltv_segment", "acquisition_channel").agg(
        F.count(F.lit(1)).alias("clientes"),
        rnd(dec_avg("realized_ltv", 2), 0).alias("ltv_medio"),
        rnd(dec_avg("projected_ltv_12m", 2), 0).alias("ltv_projetado_12m"))
    return g.orderBy(F.col("ltv_medio").desc(), "ltv_segment", "acquisition_channel").limit(k)


@model
def ltv_segment_summary(ltv: DataFrame) -> DataFrame:
    out = ltv.groupBy("ltv_segment").agg(
        F.count(F.lit(1)).alias("clientes"),
        rnd(dec_avg("realized_ltv", 2), 0).alias("ltv_realizado"),
        rnd(dec_avg("projected_ltv_12m", 2), 0).alias("ltv_projetado"),
        rnd(int_avg("total_contracts"), 1).alias("contratos_medio"))
    return out.orderBy(F.col("ltv_realizado").desc(), "ltv_segment")


@model
def digital_by_segment(segments: DataFrame, behavior: DataFrame) -> DataFrame:
    # behaviour rows of the latest month overall
    latest = behavior.agg(F.max("event_month").alias("_m"))
    db = (behavior.join(latest, F.col("event_month") == F.col("_m"))
          .select("customer_id", "app_engagement_score", "logins_count", "payment_events", "trend_30d"))
    j = segments.select("customer_id", "segment").join(db, "customer_id", "left")
    out = j.groupBy("segment").agg(
        rnd(int_avg("app_engagement_score"), 1).alias("engajamento_medio"),
        rnd(int_avg("logins_count"), 1).alias("logins_mensais"),
        rnd(int_avg("payment_events"), 1).alias("pagamentos_app"),
        F.count(F.when(F.col("trend_30d") == "declining", 1)).alias("tendencia_queda"))
    return out.orderBy(F.col("engajamento_medio").desc(), "segment")


# ---- dashboard -----------------------------------------------------------------------------
@model
def header_kpis(score: DataFrame, portfolio: DataFrame, min_contracts: int = MIN_MONTH_CONTRACTS) -> DataFrame:
    """Four scalar KPIs in one pass over a tagged union of the two marts (no join needed)."""
    s = score.select(F.col("customer_id"), F.col("alert_30d"), F.lit(None).cast("date").alias("mes"),
                     F.lit(None).cast("double").alias("total_exposure"), F.lit(None).cast("double").alias("default_rate"),
                     F.lit(None).cast("long").alias("total_active_contracts"))
    p = portfolio.select(F.lit(None).cast(score.schema["customer_id"].dataType).alias("customer_id"),
                         F.lit(None).cast("boolean").alias("alert_30d"), "mes", "total_exposure", "default_rate",
                         "total_active_contracts")
    u = s.unionByName(p)
    rate = F.when(F.col("total_active_contracts") > min_contracts, F.col("default_rate"))
    return u.agg(
        F.countDistinct("customer_id").alias("total_clientes"),
        rnd(F.max_by("total_exposure", "mes") / F.lit(1e9), 2).alias("carteira_bi"),
        rnd(dec_avg(rate, 2), 1).alias("inadimplencia_pct"),
        F.count(F.when(F.col("alert_30d"), 1)).alias("alertas_30d"))


@model
def monthly_line(portfolio: DataFrame, min_contracts: int = MIN_MONTH_CONTRACTS) -> DataFrame:
    out = portfolio.where(F.col("total_active_contracts") > min_contracts).select(
        F.date_format("mes", "yyyy-MM").alias("mes_str"), F.col("default_rate").alias("default_pct"),
        "is_peak_month", F.when(F.col("is_peak_month"), PERIODS[True]).otherwise(PERIODS[False]).alias("cor"))
    return out.orderBy("mes_str")


@model
def product_bars(performance: DataFrame) -> DataFrame:
    out = performance.where(F.col("product_type").isNotNull()).groupBy("product_type").agg(
        rnd(dec_avg("default_rate_pct", 2), 2).alias("default_pct"),
        F.count(F.lit(1)).alias("total_contratos"))
    return out.orderBy(F.col("default_pct").desc(), "product_type")


@model
def alert_count(score: DataFrame) -> DataFrame:
    return score.where(F.col("alert_30d")).agg(F.count(F.lit(1)).alias("total"))


@model
def tier_distribution(score: DataFrame) -> DataFrame:
    g = score.groupBy("risk_tier").agg(F.count(F.lit(1)).alias("n"))
    out = g.select("risk_tier", F.col("n").alias("clientes"), _share().alias("pct"))
    return out.orderBy(F.col("clientes").desc(), "risk_tier")


@model
def channel_risk_dashboard(acquisition: DataFrame) -> DataFrame:
    out = acquisition.select("acquisition_channel", rnd("default_rate_pct", 2).alias("default_pct"),
                              rnd("avg_ltv", 0).alias("ltv_medio"), "total_customers")
    return out.orderBy(F.col("default_pct").desc(), "acquisition_channel")


@model
def top_alerts(score: DataFrame, k: int = 20) -> DataFrame:
    return (score.where(F.col("alert_30d")).orderBy(F.col("credit_score").asc(), F.col("customer_id").asc()).limit(k)
            .select("customer_id", rnd("credit_score", 0).alias("score"), "risk_tier",
                    rnd("app_engagement_score", 1).alias("engagement")))


@model
def segment_counts(segments: DataFrame) -> DataFrame:
    out = segments.groupBy("segment").agg(F.count(F.lit(1)).alias("clientes"))
    return out.orderBy(F.col("clientes").desc(), "segment")


@model
def ltv_by_segment(ltv: DataFrame) -> DataFrame:
    out = ltv.groupBy("ltv_segment").agg(rnd(dec_avg("realized_ltv", 2), 0).alias("ltv_medio"),
                                          F.count(F.lit(1)).alias("clientes"))
    return out.orderBy(F.col("ltv_medio").desc(), "ltv_segment")


@model
def channel_quality(acquisition: DataFrame) -> DataFrame:
    out = acquisition.select("acquisition_channel", "total_customers",
                              rnd("approval_rate_pct", 1).alias("aprovacao_pct"),
                              rnd("default_rate_pct", 2).alias("default_pct"), rnd("avg_ltv", 0).alias("avg_ltv"))
    return out.orderBy("default_pct", "acquisition_channel")


@model
def score_histogram(score: DataFrame, bins: int = 50, lo: float = 0.0, hi: float = 1000.0) -> DataFrame:
    """Counts per (tier, equal-width score bin).  Scores are clamped to [0, 1000] by the mart, so
    the bin edges are fixed and no pass over the data is needed to find them."""
    b = F.least(F.width_bucket(F.col("credit_score"), F.lit(lo), F.lit(hi), F.lit(bins)), F.lit(bins))
    width = (hi - lo) / bins
    g = score.where(F.col("credit_score").isNotNull()).groupBy("risk_tier", b.alias("bin")).agg(
        F.count(F.lit(1)).alias("clientes"))
    return g.select("risk_tier", F.col("bin").cast("int").alias("bin"),
                    (F.lit(lo) + (F.col("bin") - 1) * F.lit(width)).alias("bin_start"),
                    (F.lit(lo) + F.col("bin") * F.lit(width)).alias("bin_end"), "clientes")


# ---- preset questions ----------------------------------------------------------------------
@model
def top_at_risk(score: DataFrame, k: int = 10) -> DataFrame:
    return (score.where(F.col("alert_30d")).orderBy(F.col("credit_score").asc(), F.col("customer_id").asc()).limit(k)
            .select("customer_id", "credit_score", "risk_tier", "overall_default_rate", "app_engagement_score",
                    "avg_days_late"))


@model
def channel_by_ltv(acquisition: DataFrame) -> DataFrame:
    out = acquisition.select("acquisition_channel", rnd("avg_ltv", 0).alias("ltv_medio"),
                              rnd("default_rate_pct", 2).alias("inadimplencia_pct"), "total_customers")
    return out.orderBy(F.col("ltv_medio").desc(), "acquisition_channel")


@model
def best_collection_window(collection: DataFrame) -> DataFrame:
    out = collection.where(F.col("is_best_window")).select(
        "channel_used", "trigger_bucket", rnd("recovery_rate_pct", 2).alias("recuperacao_pct"),
        rnd("avg_resolution_days", 1).alias("dias_medio"))
    return out.orderBy(F.col("recuperacao_pct").desc(), "channel_used", "trigger_bucket")
