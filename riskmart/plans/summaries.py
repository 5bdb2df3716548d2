"""Run summaries: the pipeline quality report (J6) and the dataset report.

Both are unions of one-row aggregates — each input table is scanned once, and nothing but
the final handful of rows ever leaves the executors.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskmart.functions import model, dec_avg, int_avg, rnd, safe_div, to_units


def _count_when(cond) -> F.Column:
    return F.sum(F.when(cond, 1).otherwise(0)).cast("long")


@model
def quality_report(stg_customers: DataFrame, stg_payments: DataFrame, stg_contracts: DataFrame) -> DataFrame:
    """``(source, n, defaults, zero_income, avg_days_late, default_pct)``, one row per table."""
    null_l, null_d = F.lit(None).cast("long"), F.lit(None).cast("double")
    cust = stg_customers.agg(
        F.lit("customers").alias("source"), F.count(F.lit(1)).alias("n"), null_l.alias("defaults"),
        _count_when(F.col("income_declared") == 0).alias("zero_income"), null_d.alias("avg_days_late"))
    pay = stg_payments.agg(
        F.lit("payments").alias("source"), F.count(F.lit(1)).alias("n"),
        _count_when(F.col("is_defaulted")).alias("defaults"), null_l.alias("zero_income"),
        rnd(int_avg("days_late"), 1).alias("avg_days_late"))
    con = stg_contracts.agg(
        F.lit("contracts").alias("source"), F.count(F.lit(1)).alias("n"),
        _count_when(F.col("is_defaulted")).alias("defaults"), null_l.alias("zero_income"),
        null_d.alias("avg_days_late"))
    out = cust.unionByName(pay).unionByName(con)
    return out.withColumn(
        "default_pct",
        F.when(F.col("n") > 0, rnd(safe_div("defaults", "n") * F.lit(100.0), 1))
         .otherwise(F.when(F.col("defaults").isNotNull(), F.lit(0.0))))


def _metric(df: DataFrame, name: str, num=None, text=None) -> DataFrame:
    return df.agg(F.lit(name).alias("metric"),
                  (num if num is not None else F.lit(None)).cast("double").alias("value_num"),
                  (text if text is not None else F.lit(None)).cast("string").alias("value_text"))


@model
def dataset_report(sources: dict[str, DataFrame]) -> DataFrame:
    """Row counts and headline statistics of the six source tables: ``(metric, value_num, value_text)``.

    Numbers are rounded to 4 decimals.
    """
    pay, cont, cust = sources["payments"], sources["contracts"], sources["customers"]
    parts = [_metric(sources[t], t, F.count(F.lit(1))) for t in
             ["customers", "contracts", "payments", "app_events", "proposals", "collections"]]
    is_def = F.col("status") == "defaulted"
    parts.append(_metric(pay, "default_geral", rnd(safe_div(_count_when(is_def), F.count(F.lit(1))) * 100.0, 4)))
    janfev = pay.where(F.month(F.col("due_date").cast("date")).isin(1, 2))
    parts.append(_metric(janfev, "default_janfev", rnd(safe_div(_count_when(is_def), F.count(F.lit(1))) * 100.0, 4)))
    parts.append(_metric(cont, "avg_ticket", rnd(dec_avg("principal_amount", 2), 4)))
    # mean of principal * term / 12 * (1 + rate): cents x term x (1 + rate in 1e-4 units) is an
    # exact integer per row; summed as decimal(38,0) so the total cannot overflow
    value = (to_units("principal_amount", 2) * F.col("installments_total").cast("long")
             * (F.lit(10000) + to_units("interest_rate", 4))).cast("decimal(38,0)")
    parts.append(_metric(cont, "ltv", rnd(safe_div(F.sum(value).cast("double") / F.lit(1e6),
                                                   F.count(value) * F.lit(12.0)), 4)))
    # tiny tables below: one row per channel / product (domain-bounded)
    top = cust.groupBy("acquisition_channel").count()
    parts.append(_metric(top, "top_channel",
                         text=F.min_by("acquisition_channel", F.struct(-F.col("count"), F.col("acquisition_channel")))))
    prod = cont.groupBy("product_type").agg(
        (safe_div(_count_when(is_def), F.count(F.lit(1))) * 100.0).alias("rate"))
    parts.append(_metric(prod, "best_product", text=F.min_by("product_type", F.struct("rate", "product_type"))))
    worst = prod.withColumn("_k", F.row_number().over(Window.orderBy(F.col("rate").desc(), "product_type")))
    parts.append(_metric(worst.where(F.col("_k") == 1), "worst_product", text=F.first("product_type")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
