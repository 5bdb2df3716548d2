"""Unit tests on hand-written rows: every null branch and boundary of the staging views."""

import datetime as dt

from riskmart.plans import staging

D = dt.date


def _rows(df, key):
    return {r[key]: r for r in df.collect()}


def test_payments_lateness_buckets_and_flags(spark):
    rows = [(i, 1, 1, D(2024, 1, 31), None, 10.0, None, late, "pix", "paid_on_time")
            for i, late in enumerate([-5, 0, 1, 30, 31, 60, 61, 90, 91, None])]
    raw = spark.createDataFrame(rows, "payment_id int, contract_id int, customer_id int, due_date date, "
                                      "payment_date date, amount_due double, amount_paid double, days_late int, "
                                      "payment_method string, status string")
    got = _rows(staging.stg_payments(raw), "payment_id")
    buckets = [got[i]["lateness_bucket"] for i in range(10)]
    assert buckets == ["on_time", "on_time", "1-30_days", "1-30_days", "31-60_days", "31-60_days",
                       "61-90_days", "61-90_days", "90+_days", "90+_days"]  # null days_late -> ELSE
    assert [got[i]["is_late"] for i in range(10)] == [False, False] + [True] * 7 + [False]
    assert got[0]["due_month"] == D(2024, 1, 1) and got[0]["due_year"] == 2024 and got[0]["due_month_num"] == 1


def test_customers_age_income_products(spark):
    raw = spark.createDataFrame(
        [(1, D(2000, 12, 31), 0.0, 1), (2, D(2000, 1, 1), 100.0, 2), (3, D(1990, 6, 1), None, None)],
        "customer_id int, birth_date date, income_declared double, products_count int")
    for c, t in [("name", "string"), ("cpf_hash", "string"), ("age_group", "string"),
                 ("acquisition_channel", "string"), ("state", "string"), ("city", "string"),
                 ("signup_date", "date"), ("customer_segment", "string"), ("is_active", "boolean")]:
        raw = raw.withColumn(c, __import__("pyspark.sql.functions", fromlist=["lit"]).lit(None).cast(t))
    got = _rows(staging.stg_customers(raw, D(2024, 6, 30)), "customer_id")
    assert got[1]["age"] == 24  # year boundaries, not completed years
    assert (got[1]["has_zero_income"], got[2]["has_zero_income"], got[3]["has_zero_income"]) == (True, False, False)
    assert (got[1]["is_multi_product"], got[2]["is_multi_product"], got[3]["is_multi_product"]) == (False, True, False)


def test_contracts_completion_and_flags(spark):
    raw = spark.createDataFrame(
        [(1, 1, "personal_loan", D(2024, 1, 1), D(2024, 7, 1), 1000.0, 0.02, 0, 0, "active", None),
         (2, 1, "credit_card", D(2024, 1, 1), D(2024, 7, 1), 1000.0, 0.02, 3, 1, "settled", "vehicle"),
         (3, 1, "credit_card", D(2024, 1, 1), D(2024, 7, 1), 1000.0, 0.02, 7, 2, "defaulted", "none")],
        "contract_id int, customer_id int, product_type string, contract_date date, maturity_date date, "
        "principal_amount double, interest_rate double, installments_total int, installments_paid int, "
        "status string, collateral string")
    got = _rows(staging.stg_contracts(raw, D(2024, 6, 30)), "contract_id")
    assert got[1]["completion_rate"] is None  # 0 installments -> null rate
    assert got[2]["completion_rate"] == 0.3333 and got[3]["completion_rate"] == 0.2857
    assert got[1]["days_to_maturity"] == 1
    assert [got[i]["has_collateral"] for i in (1, 2, 3)] == [False, True, False]  # null collateral -> false
    assert (got[2]["is_settled"], got[3]["is_defaulted"], got[1]["is_active_contract"]) == (True, True, True)


def test_proposals_bureau_bands_and_ratio(spark):
    scores = [None, 299, 300, 499, 500, 699, 700, 849, 850]
    rows = [(i, 1, D(2024, 3, 5), "personal_loan", 1000.0, 850.0, 0.02, "approved", None, s)
            for i, s in enumerate(scores)]
    rows.append((100, 1, D(2024, 3, 5), "personal_loan", 0.0, 0.0, 0.02, "approved", None, 500))
    rows.append((101, 1, D(2024, 3, 5), "personal_loan", 1000.0, None, 0.02, "rejected", "score", 500))
    raw = spark.createDataFrame(rows, "proposal_id int, customer_id int, proposal_date date, product_type string, "
                                      "requested_amount double, approved_amount double, "
                                      "interest_rate_offered double, decision string, rejection_reason string, "
                                      "bureau_score int")
    got = _rows(staging.stg_proposals(raw), "proposal_id")
    assert [got[i]["bureau_score_band"] for i in range(9)] == [
        "unknown", "very_low", "low", "low", "medium", "medium", "high", "high", "very_high"]
    assert got[0]["is_missing_bureau"] and not got[1]["is_missing_bureau"]
    assert got[1]["approval_ratio"] == 0.85
    assert got[100]["approval_ratio"] is None and got[101]["approval_ratio"] is None
    assert got[1]["proposal_month"] == D(2024, 3, 1)


def test_collections_buckets_and_outcome(spark):
    rows = [(i, 1, 1, D(2024, 2, 10), d, "sms", o, None, None)
            for i, (d, o) in enumerate([(0, "paid"), (1, "renegotiated"), (3, None), (4, "no_contact"),
                                        (30, "paid"), (31, "paid"), (90, "paid"), (91, "paid"), (None, "paid")])]
    raw = spark.createDataFrame(rows, "collection_id int, contract_id int, customer_id int, trigger_date date, "
                                      "days_overdue_at_trigger int, channel_used string, outcome string, "
                                      "recovery_amount double, resolution_days int")
    got = _rows(staging.stg_collections(raw), "collection_id")
    assert [got[i]["overdue_bucket"] for i in range(9)] == [
        "late_90plus", "early_1_3d", "early_1_3d", "early_4_30d", "early_4_30d", "mid_31_90d", "mid_31_90d",
        "late_90plus", "late_90plus"]
    assert got[2]["is_missing_outcome"] and not got[2]["is_recovered"]
    assert got[1]["is_recovered"] and not got[3]["is_recovered"]


def test_app_events_calendar_and_flags(spark):
    rows = [(1, 1, dt.datetime(2024, 6, 2, 0, 0), "view_offer", "web", 10),      # Sunday, hour 0
            (2, 1, dt.datetime(2024, 6, 1, 23, 5), "reject_offer", "web", 10),   # Saturday, hour 23
            (3, 1, dt.datetime(2024, 6, 3, 12, 0), "make_payment", "web", 10),
            (4, 1, dt.datetime(2024, 6, 3, 12, 0), "login", "web", 10)]
    raw = spark.createDataFrame(rows, "event_id int, customer_id int, event_date timestamp_ntz, event_type string, "
                                      "channel string, session_duration_seconds int")
    got = _rows(staging.stg_app_events(raw), "event_id")
    assert (got[1]["day_of_week"], got[2]["day_of_week"]) == (0, 6)
    assert (got[1]["event_hour"], got[2]["event_hour"]) == (0, 23)
    assert got[1]["is_offer_event"] and got[2]["is_offer_event"] and not got[3]["is_offer_event"]
    assert got[3]["is_payment_event"] and got[4]["is_login_event"]
    assert got[1]["event_month"] == dt.date(2024, 6, 1)
