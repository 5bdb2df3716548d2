"""Hand-written fixtures for the model rules that are easy to get wrong (SURVEY 'traps')."""

import datetime as dt
import itertools

from pyspark.sql import functions as F

from riskmart.plans import intermediate, marts, staging

D = dt.date


def test_rfm_rule_order_over_all_codes(spark):
    codes = ["".join(map(str, c)) for c in itertools.product(range(1, 5), repeat=3)]
    df = spark.createDataFrame([(c,) for c in codes], "code string")
    got = {r["seg"]: r["n"] for r in
           df.select(marts.rfm_segment(F.col("code")).alias("seg")).groupBy("seg").agg(F.count("*").alias("n")).collect()}
    assert got == {"champion": 4, "loyal": 16, "at_risk": 18, "lost": 16, "promising": 10}
    one = {r["code"]: r["seg"] for r in df.select("code", marts.rfm_segment(F.col("code")).alias("seg")).collect()}
    # '3%3%' / '3%4%' win before the at_risk IN list; '4%4%' is absent from the loyal rule
    assert one["313"] == "loyal" and one["314"] == "loyal" and one["312"] == "at_risk"
    assert one["442"] == "promising" and one["414"] == "promising" and one["444"] == "champion"


def _events(spark, rows):
    raw = spark.createDataFrame(rows, "event_id int, customer_id int, event_date timestamp_ntz, event_type string, "
                                      "channel string, session_duration_seconds int")
    return staging.stg_app_events(raw)


def test_behavior_lag_skips_gaps_and_exact_ratios_are_stable(spark):
    rows, eid = [], 0
    for month, n in [(1, 10), (3, 11), (4, 22), (5, 11), (6, 5)]:
        for i in range(n):
            eid += 1
            rows.append((eid, 1, dt.datetime(2024, month, 1 + i % 20, 10), "view_offer", "web", 100))
    for i in range(30):  # many logins + one null session in another customer's month: score capped at 100
        eid += 1
        rows.append((eid, 2, dt.datetime(2024, 1, 1 + i % 28, 9), "login", "web", None if i == 0 else 900))
    eid += 1
    rows.append((eid, 99, dt.datetime(2024, 1, 5, 9), "login", "web", 60))  # orphan customer
    customers = spark.createDataFrame([(1, "starter", "organic"), (2, "vip", "partner")],
                                      "customer_id int, customer_segment string, acquisition_channel string")
    got = {(r["customer_id"], r["event_month"].month): r for r in
           intermediate.int_customer_digital_behavior(customers, _events(spark, rows)).collect()}
    assert got[(1, 1)]["trend_30d"] == "new"
    assert got[(1, 3)]["prev_month_events"] == 10 and got[(1, 3)]["trend_30d"] == "stable"   # 11 = 1.1 x 10
    assert got[(1, 4)]["trend_30d"] == "growing"
    assert got[(1, 5)]["trend_30d"] == "stable"                                             # 11 = 0.5 x 22
    assert got[(1, 6)]["trend_30d"] == "declining"
    assert got[(2, 1)]["app_engagement_score"] == 100.0
    assert got[(1, 3)]["days_since_last_login"] == 31 - 11                                 # month end - last day
    assert got[(99, 1)]["customer_segment"] is None                                        # orphan kept


def test_portfolio_exposure_fanout_and_first_delta(spark):
    contracts = spark.createDataFrame(
        [(1, 1000.0, "personal_loan"), (2, 500.0, "vehicle_financing")],
        "contract_id int, principal_amount double, product_type string")
    pays = spark.createDataFrame(
        [(1, D(2024, 1, 1), 2024, 1, False, "on_time", 10.0), (1, D(2024, 1, 1), 2024, 1, True, "90+_days", 10.0),
         (2, D(2024, 1, 1), 2024, 1, False, "on_time", 5.0), (2, D(2024, 2, 1), 2024, 2, False, "on_time", 5.0)],
        "contract_id int, due_month date, due_year int, due_month_num int, is_defaulted boolean, "
        "lateness_bucket string, amount_due double")
    got = {r["mes"].month: r for r in marts.fct_portfolio_health(pays, contracts).collect()}
    jan, feb = got[1], got[2]
    assert jan["total_exposure"] == 2500.0           # contract 1 counted once per payment row
    assert jan["total_active_contracts"] == 2 and jan["npl_ratio"] == 50.0
    assert jan["pct_personal_loan"] == 50.0 and jan["default_rate"] == 33.33
    assert jan["default_rate_mom_delta"] is None and feb["default_rate_mom_delta"] == -33.33
    assert jan["is_peak_month"] and feb["is_peak_month"]


def test_collection_buckets_and_tied_best_window(spark):
    rows = []
    cid = 0
    for days, outcome in [(7, "paid"), (8, "paid"), (30, "no_contact"), (31, "paid"), (90, "legal_action"),
                          (91, "paid"), (0, "paid")]:
        cid += 1
        rows.append((cid, 1, 1, D(2024, 1, 1), days, "sms", outcome, 10.0 if outcome == "paid" else None,
                     5 if outcome == "paid" else None))
    raw = spark.createDataFrame(rows, "collection_id int, contract_id int, customer_id int, trigger_date date, "
                                      "days_overdue_at_trigger int, channel_used string, outcome string, "
                                      "recovery_amount double, resolution_days int")
    got = {r["trigger_bucket"]: r for r in marts.fct_collection_efficiency(staging.stg_collections(raw)).collect()}
    assert {b: got[b]["total_actions"] for b in got} == {"early": 1, "mid": 2, "late": 2, "bad": 2}
    # early and bad both recover 100 %: the tie goes to the first bucket name ('bad')
    assert got["early"]["best_trigger_bucket"] == "bad" and got["bad"]["is_best_window"]
    assert got["mid"]["avg_resolution_days"] == 5.0 and got["mid"]["recovery_rate_pct"] == 50.0


def test_credit_score_tier_boundaries_alerts_and_defaults(spark):
    # every customer: same income (percentile 0), age 18-25 (75 points), 2 products (75 points),
    # so the score is 150 + payment component + digital component
    cases = {  # id: (overall_default_rate, engagement or None for 'no events', expected raw sum)
        1: (1.0, 19.6, 199), 2: (1.0, 20.0, 200), 3: (1.0, 99.6, 399), 4: (1.0, 100.0, 400),
        5: (0.5025, 100.0, 599), 6: (0.5, 100.0, 600), 7: (0.0025, 100.0, 799), 8: (0.0, 100.0, 800),
        9: (1.0, 29.0, 223), 10: (1.0, 30.0, 225), 11: (1.0, None, 150),
    }
    prof = spark.createDataFrame(
        [(i, "starter", "organic", "18-25", 2, True, 1, odr, 0.0, 0.0, 10.0, 5.0) for i, (odr, _, _) in cases.items()]
        + [(12, "starter", "organic", "unknown", 2, True, 1, 0.0, 0.0, 0.0, 10.0, 5.0)],
        "customer_id int, customer_segment string, acquisition_channel string, age_group string, "
        "products_count int, is_multi_product boolean, total_contracts long, overall_default_rate double, "
        "avg_days_late double, best_payment_streak double, total_debt double, total_paid double")
    beh = spark.createDataFrame(
        [(i, D(2024, 1, 1), eng - 10 if eng else 0.0, 3, "stable") for i, (_, eng, _) in cases.items() if eng]
        + [(i, D(2024, 2, 1), eng, 5, "growing") for i, (_, eng, _) in cases.items() if eng],  # latest month wins
        "customer_id int, event_month date, app_engagement_score double, days_since_last_login int, trend_30d string")
    cust = spark.createDataFrame([(i, 1000.0) for i in range(1, 13)], "customer_id int, income_declared double")
    got = {r["customer_id"]: r for r in marts.fct_credit_score(prof, beh, cust).collect()}
    tier = {199: "very_high", 200: "high", 399: "high", 400: "medium", 599: "medium", 600: "low", 799: "low",
            800: "very_low", 223: "high", 225: "high", 150: "very_high"}
    for i, (_, eng, total) in cases.items():
        r = got[i]
        assert r["credit_score"] == total, i
        assert r["risk_tier"] == tier[total], i
        assert r["alert_30d"] == (total < 400 and (eng or 0.0) < 30), i
    assert got[9]["alert_30d"] and not got[10]["alert_30d"]
    assert (got[11]["app_engagement_score"], got[11]["days_since_last_login"], got[11]["trend_30d"]) == (0.0, 30, "stable")
    assert got[1]["trend_30d"] == "growing" and got[1]["days_since_last_login"] == 5
    assert got[12]["component_profile"] == 50.0 and got[1]["component_profile"] == 75.0
    assert got[1]["income_pct"] == 0.0
