"""The driver's TPC-H-like tables mapped onto the six native credit tables.

Each function is a plain projection/filter/join over the driver tables, so it scales with
them: every mapped table grows linearly with ``orders`` / ``lineitem`` / ``events``.

Fixture parameters that go with this family (the mapped data ends in late 2001, events are in
2024):
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed values of the fixture family (run dates and ML windows that fit the mapped data).
AS_OF = dt.date(2001, 12, 31)
ML_CUTOFF = dt.date(2000, 12, 31)
ML_LABEL_END = dt.date(2001, 3, 31)
ML_RECENT_START = dt.date(2000, 10, 1)
ML_EVENT_START = dt.date(2024, 3, 1)
ML_EVENT_END = dt.date(2024, 5, 31)
# Report parameters: the reference's "since 2023-01-01" covers the last two calendar years of
# its data; the mapped data ends in 2001.  Its "more than 1000 contracts in the month" is ~0.8 %
# of its contracts; the mapped sf0.01 data has ~700 contracts per month.
REPORT_SINCE = dt.date(2000, 1, 1)
MIN_MONTH_CONTRACTS = 500

#: Lineitem (or, if there are more, orders) rows of one task where payments meet their contract: the tasks grow in number
#: with the table, not in size.
TASK_ROWS = 500_000

DRIVER_TABLES = ["region", "nation", "customer", "orders", "lineitem", "events"]


def pick(index: Column, values: list) -> Column:
    """``values[index]`` for a 0-based integer index column."""
    return F.element_at(F.array(*[F.lit(v) for v in values]), (index + 1).cast("int"))


def read_driver_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    base = sf_dir.rstrip("/")
    return {t: spark.read.parquet(f"{base}/{t}.parquet") for t in DRIVER_TABLES}


def _product_type(priority: Column) -> Column:
    return (F.when(priority == "1-URGENT", "personal_loan")
            .when(priority == "2-HIGH", "vehicle_financing")
            .when(priority == "3-MEDIUM", "credit_card")
            .otherwise("payroll_loan"))


def customers(t: dict[str, DataFrame]) -> DataFrame:
    c = t["customer"]
    geo = (t["nation"].join(t["region"], F.col("n_regionkey") == F.col("r_regionkey"))
           .select("n_nationkey", "n_name", "r_name"))
    k = F.col("c_custkey")
    return (c.join(geo, c["c_nationkey"] == geo["n_nationkey"])
            .select(
                k.alias("customer_id"),
                F.col("c_name").alias("name"),
                F.concat(F.lit("h"), k.cast("string")).alias("cpf_hash"),
                pick(k % 5, [dt.date(2000, 6, 15), dt.date(1993, 2, 28), dt.date(1983, 11, 1),
                             dt.date(1970, 7, 31), dt.date(1950, 1, 1)]).alias("birth_date"),
                pick(k % 5, ["18-25", "26-35", "36-45", "46-60", "60+"]).alias("age_group"),
                F.when(F.col("c_mktsegment") == "AUTOMOBILE", "paid_search")
                 .when(F.col("c_mktsegment") == "BUILDING", "organic")
                 .when(F.col("c_mktsegment") == "FURNITURE", "social_media")
                 .when(F.col("c_mktsegment") == "HOUSEHOLD", "partner")
                 .otherwise("referral").alias("acquisition_channel"),
                F.col("r_name").alias("state"),
                F.col("n_name").alias("city"),
                F.greatest(F.col("c_acctbal"), F.lit(0.0)).alias("income_declared"),
                F.date_add(F.lit(dt.date(1995, 1, 1)), (k % 2000).cast("int")).alias("signup_date"),
                pick(F.col("c_nationkey") % 4, ["starter", "regular", "premium", "vip"])
                 .alias("customer_segment"),
                (k % 20 != 0).alias("is_active"),
                (1 + k % 4).cast("int").alias("products_count"),
            ))


def _contract_cols(o: DataFrame) -> DataFrame:
    k = F.col("o_orderkey")
    term = 6 + k % 55
    paid = (k * 7) % (7 + k % 55)
    # one customer in 25 has no contract: its orders are the neighbour's
    cust = F.col("o_custkey") - F.when(F.col("o_custkey") % 25 == 7, 1).otherwise(0)
    status = (F.when((cust % 10 == 3) & (k % 10 < 9), "defaulted")
              .when((cust % 10 != 3) & (k % 20 == 0), "defaulted")
              .when(paid == term, "settled")
              .when(k % 20 == 1, "renegotiated")
              .otherwise("active"))
    cdate = F.col("o_orderdate").cast("date")
    return o.select(
        k.alias("contract_id"),
        cust.alias("customer_id"),
        _product_type(F.col("o_orderpriority")).alias("product_type"),
        cdate.alias("contract_date"),
        F.date_add(cdate, (30 * term).cast("int")).alias("maturity_date"),
        F.col("o_totalprice").alias("principal_amount"),
        ((15 + k % 105).cast("double") / F.lit(1000.0)).alias("interest_rate"),
        term.cast("int").alias("installments_total"),
        paid.cast("int").alias("installments_paid"),
        status.alias("status"),
        F.when(F.col("o_orderpriority") == "2-HIGH", "vehicle")
         .when(k % 9 == 0, "property").otherwise("none").alias("collateral"),
    )


def contracts(t: dict[str, DataFrame]) -> DataFrame:
    return _contract_cols(t["orders"])


def _payment_base(t: dict[str, DataFrame]) -> DataFrame:
    """lineitem joined to its contract; keeps the raw columns the derived tables need."""
    con = contracts(t).select("contract_id", "customer_id", F.col("status").alias("contract_status"))
    # the counts read the files' footers; the models by contract keep this partitioning
    tasks = -(-max(t["lineitem"].count(), t["orders"].count()) // TASK_ROWS)
    li = t["lineitem"]
    if tasks > 1:
        # a task's contracts are few and narrow: they are hashed, and the wide payments are not sorted
        li, con = li.repartition(tasks, "l_orderkey"), con.repartition(tasks, "contract_id").hint("shuffle_hash")
    rf, disc, pk = F.col("l_returnflag"), F.col("l_discount"), F.col("l_partkey")
    status = (F.when((rf == "R") & (disc >= 0.075), "defaulted")
              .when((rf == "A") & (disc >= 0.065), "paid_late")
              .when((rf == "N") & (disc >= 0.085), "pending")
              .otherwise("paid_on_time"))
    days_late = (F.when(status == "defaulted", 31 + pk % 149)
                 .when(status == "paid_late", 1 + pk % 29)
                 .when(status == "pending", 0)
                 .otherwise(-(pk % 6))).cast("int")
    is_paid = status.isin("paid_on_time", "paid_late")
    due = F.col("l_shipdate").cast("date")
    return (li.join(con, li["l_orderkey"] == con["contract_id"])
            .select(
                F.concat_ws("-", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string"),
                            pk.cast("string"), F.col("l_suppkey").cast("string"),
                            F.col("l_quantity").cast("int").cast("string")).alias("payment_id"),
                "contract_id", "customer_id", "contract_status",
                due.alias("due_date"),
                F.when(is_paid, F.date_add(due, days_late)).alias("payment_date"),
                F.col("l_extendedprice").alias("amount_due"),
                F.when(is_paid, F.col("l_extendedprice")).alias("amount_paid"),
                days_late.alias("days_late"),
                pick(F.col("l_suppkey") % 4, ["pix", "boleto", "debit", "auto_debit"]).alias("payment_method"),
                status.alias("status"),
                (pk + 3 * F.col("l_linenumber") + F.col("l_suppkey")).alias("_q"),
            ))


def payments(t: dict[str, DataFrame], base: DataFrame | None = None) -> DataFrame:
    """``base`` may be the ready ``_payment_base`` table."""
    return (_payment_base(t) if base is None else base).drop("contract_status", "_q")


def collections(t: dict[str, DataFrame], base: DataFrame | None = None) -> DataFrame:
    """``base`` may be the ready ``_payment_base`` table."""
    base = (_payment_base(t) if base is None else base).where(F.col("contract_status") == "defaulted")
    q = F.col("_q")
    d = (1 + (3 * q) % F.when(q % 4 == 0, 7).when(q % 4 == 1, 30).otherwise(179)).cast("int")
    base = base.withColumn("_d", d)
    d = F.col("_d")
    threshold = F.when(d <= 7, 120).when(d <= 30, 90).otherwise(36)
    outcome = (F.when(q % 12 == 0, F.lit(None).cast("string"))
               .when(q % 180 < threshold, F.when(q % 3 == 0, "renegotiated").otherwise("paid"))
               .when(q % 3 == 0, "legal_action")
               .otherwise("no_contact"))
    base = base.withColumn("_outcome", outcome)
    recovered = F.col("_outcome").isin("paid", "renegotiated")
    return base.select(
        F.col("payment_id").alias("collection_id"),
        "contract_id", "customer_id",
        F.date_add(F.col("due_date"), d).alias("trigger_date"),
        d.alias("days_overdue_at_trigger"),
        pick(q % 5, ["sms", "email", "whatsapp", "phone", "letter"]).alias("channel_used"),
        F.col("_outcome").alias("outcome"),
        F.when(recovered, F.floor(F.col("amount_due") * 40).cast("double") / F.lit(100.0))
         .alias("recovery_amount"),
        F.when(recovered, (1 + q % 119).cast("int")).alias("resolution_days"),
    )


def app_events(t: dict[str, DataFrame]) -> DataFrame:
    e = t["events"]
    eid = F.col("event_id")
    et = F.col("event_type")
    even = eid % 2 == 0
    return e.select(
        eid.alias("event_id"),
        F.when(eid % 50 == 0, -1 - eid).otherwise(F.col("user_id") * 10 + eid % 3).alias("customer_id"),
        (F.col("ts") + F.make_ym_interval(F.lit(0), (eid % 6).cast("int"))).alias("event_date"),
        F.when(et == "view", "login")
         .when(et == "purchase", "make_payment")
         .when(et == "click", F.when(even, "view_offer").otherwise("accept_offer"))
         .when(et == "signup", F.when(even, "check_balance").otherwise("view_contract"))
         .otherwise("contact_support").alias("event_type"),
        pick(eid % 3, ["app_ios", "app_android", "web"]).alias("channel"),
        (10 + eid % 1790).cast("int").alias("session_duration_seconds"),
    )


def proposals(t: dict[str, DataFrame]) -> DataFrame:
    o = t["orders"]
    k = F.col("o_orderkey")
    bucket = k % 20
    decision = (F.when(bucket < 11, "approved").when(bucket < 17, "rejected")
                .when(bucket < 19, "pending").otherwise("cancelled"))
    return o.select(
        k.alias("proposal_id"),
        F.col("o_custkey").alias("customer_id"),
        F.date_sub(F.col("o_orderdate").cast("date"), 10).alias("proposal_date"),
        _product_type(F.col("o_orderpriority")).alias("product_type"),
        F.col("o_totalprice").alias("requested_amount"),
        F.when(decision == "approved", F.floor(F.col("o_totalprice") * 85).cast("double") / F.lit(100.0))
         .alias("approved_amount"),
        ((18 + k % 103).cast("double") / F.lit(1000.0)).alias("interest_rate_offered"),
        decision.alias("decision"),
        F.when(decision == "rejected",
               pick(k % 5, ["score", "income", "documentation", "bureau", "capacity"]))
         .alias("rejection_reason"),
        F.when(k % 19 == 0, F.lit(None).cast("int"))
         .otherwise((250 + (k * 13) % 650).cast("int")).alias("bureau_score"),
    )


BUILDERS = {
    "customers": customers,
    "contracts": contracts,
    "payments": payments,
    "app_events": app_events,
    "proposals": proposals,
    "collections": collections,
}


def fixture_sources(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The six native tables, mapped lazily from the driver tables in ``sf_dir``."""
    t = read_driver_tables(spark, sf_dir)
    base = _payment_base(t)
    return {name: build(t, base) if build in (payments, collections) else build(t) for name, build in BUILDERS.items()}


#: The driver table that gives each staging model its rows (collections are some of the payments).
ROWS_FROM = {"stg_customers": "customer", "stg_contracts": "orders", "stg_payments": "lineitem",
             "stg_app_events": "events", "stg_proposals": "orders", "stg_collections": "lineitem"}


def fixture_rows(spark: SparkSession, sf_dir: str) -> dict[str, int]:
    """About how many rows each staging model has at most, from the footers of the driver tables."""
    t = read_driver_tables(spark, sf_dir)
    counts = {name: t[name].count() for name in dict.fromkeys(ROWS_FROM.values())}
    return {model: counts[name] for model, name in ROWS_FROM.items()}
