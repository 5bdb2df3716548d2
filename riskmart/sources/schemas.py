"""Native input contract: the six bronze credit tables and their value domains."""

from __future__ import annotations

from pyspark.sql import types as T

# ---------------------------------------------------------------------------------------
# Fixed values — value domains that the data tests and the models must equal exactly.
# ---------------------------------------------------------------------------------------
AGE_GROUPS = ["18-25", "26-35", "36-45", "46-60", "60+"]
ACQUISITION_CHANNELS = ["organic", "paid_search", "social_media", "partner", "referral"]
CUSTOMER_SEGMENTS = ["starter", "regular", "premium", "vip"]
PRODUCT_TYPES = ["personal_loan", "vehicle_financing", "credit_card", "payroll_loan"]
CONTRACT_STATUSES = ["active", "settled", "defaulted", "renegotiated"]
COLLATERALS = ["none", "vehicle", "property"]
PAYMENT_METHODS = ["pix", "boleto", "debit", "auto_debit"]
PAYMENT_STATUSES = ["paid_on_time", "paid_late", "pending", "defaulted"]
LATENESS_BUCKETS = ["on_time", "1-30_days", "31-60_days", "61-90_days", "90+_days"]
EVENT_TYPES = ["login", "view_contract", "make_payment", "check_balance", "simulate_loan",
               "contact_support", "view_offer", "accept_offer", "reject_offer"]
EVENT_CHANNELS = ["app_ios", "app_android", "web"]
DECISIONS = ["approved", "rejected", "pending", "cancelled"]
BUREAU_BANDS = ["unknown", "very_low", "low", "medium", "high", "very_high"]
COLLECTION_CHANNELS = ["sms", "email", "whatsapp", "phone", "letter"]
OVERDUE_BUCKETS = ["early_1_3d", "early_4_30d", "mid_31_90d", "late_90plus"]
TRENDS = ["new", "growing", "stable", "declining"]
RISK_TIERS = ["very_low", "low", "medium", "high", "very_high"]
LTV_SEGMENTS = ["low", "medium", "high", "champion"]
TRIGGER_BUCKETS = ["early", "mid", "late", "bad"]
RFM_SEGMENTS = ["champion", "loyal", "at_risk", "lost", "promising"]
# ---------------------------------------------------------------------------------------

SOURCE_TABLES = ["customers", "contracts", "payments", "app_events", "proposals", "collections"]

# Ids are opaque keys: strings natively, integers in the driver-table fixtures.  Models never
# look inside them, so the readers keep whatever key type the files carry.
_S, _D, _I, _F, _B = T.StringType(), T.DateType(), T.IntegerType(), T.DoubleType(), T.BooleanType()

NATIVE_COLUMNS: dict[str, list[tuple[str, T.DataType | None]]] = {
    "customers": [("customer_id", None), ("name", _S), ("cpf_hash", _S), ("birth_date", _D),
                  ("age_group", _S), ("acquisition_channel", _S), ("state", _S), ("city", _S),
                  ("income_declared", _F), ("signup_date", _D), ("customer_segment", _S),
                  ("is_active", _B), ("products_count", _I)],
    "contracts": [("contract_id", None), ("customer_id", None), ("product_type", _S),
                  ("contract_date", _D), ("maturity_date", _D), ("principal_amount", _F),
                  ("interest_rate", _F), ("installments_total", _I), ("installments_paid", _I),
                  ("status", _S), ("collateral", _S)],
    "payments": [("payment_id", None), ("contract_id", None), ("customer_id", None),
                 ("due_date", _D), ("payment_date", _D), ("amount_due", _F), ("amount_paid", _F),
                 ("days_late", _I), ("payment_method", _S), ("status", _S)],
    "app_events": [("event_id", None), ("customer_id", None), ("event_date", None),
                   ("event_type", _S), ("channel", _S), ("session_duration_seconds", _I)],
    "proposals": [("proposal_id", None), ("customer_id", None), ("proposal_date", _D),
                  ("product_type", _S), ("requested_amount", _F), ("approved_amount", _F),
                  ("interest_rate_offered", _F), ("decision", _S), ("rejection_reason", _S),
                  ("bureau_score", _I)],
    "collections": [("collection_id", None), ("contract_id", None), ("customer_id", None),
                    ("trigger_date", _D), ("days_overdue_at_trigger", _I), ("channel_used", _S),
                    ("outcome", _S), ("recovery_amount", _F), ("resolution_days", _I)],
}


# Types of a file that staging turns into the declared one without loss of meaning.
ACCEPTED: dict[type, tuple[type, ...]] = {
    T.StringType: (T.StringType,),
    T.BooleanType: (T.BooleanType,),
    T.DateType: (T.DateType, T.TimestampType, T.TimestampNTZType, T.StringType),
    T.IntegerType: (T.IntegralType, T.DoubleType),  # whole numbers beside nulls are often written as doubles
    T.DoubleType: (T.NumericType,),
}


def wrong_types(table: str, schema: T.StructType) -> list[str]:
    """The columns of a file that are missing or have a type that does not fit the contract."""
    found = {f.name: f.dataType for f in schema.fields}
    wrong = []
    for name, declared in NATIVE_COLUMNS[table]:
        if name not in found:
            wrong.append(f"{name} is missing")
        elif declared is not None and not isinstance(found[name], ACCEPTED[type(declared)]):
            wrong.append(f"{name} is {found[name].simpleString()}, not {declared.simpleString()}")
    return wrong


def column_names(table: str) -> list[str]:
    return [c for c, _ in NATIVE_COLUMNS[table]]
