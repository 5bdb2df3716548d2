"""Declarative data-quality checks (J1–J5) as Spark aggregations.

Failure counts follow the usual semantics of these four tests:

* ``not_null``        — rows where the column is null;
* ``unique``          — distinct non-null keys that occur more than once;
* ``accepted_values`` — distinct non-null values outside the accepted list;
* ``relationships``   — non-null child keys without a parent row.

A model's ``not_null`` and ``accepted_values`` tests are metrics that are observed while its rows pass by (``watch``): of
the write of a table, or, for a view, of the pass that looks for repeated keys.  They cost no scan of their own.

``unique`` counts 64-bit hashes of the keys, so the shuffle carries 8 bytes a row whatever the key is.  Equal keys have
equal hashes: without a repeated hash the test passes.  Otherwise the keys with repeated hashes, and only these, are
counted themselves.  A model that is known to have many rows has its hashes dealt over tasks of bounded size (``KEY_ROWS``),
however few shuffle partitions the session has.  ``relationships`` counts the child's keys first and joins the distinct ones.

Observed are plain row counts, which say for certain whether there are offending rows (a stage that is run again after a
lost executor can count rows twice); only a column that has some is read again, for their exact number or their values.
The result is a DataFrame ``(layer, model, column_name, test, failures)`` with one row per test.
"""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from riskmart.sources import schemas as S


@dataclass(frozen=True)
class ModelTests:
    layer: str
    not_null: tuple[str, ...] = ()
    unique: tuple[str, ...] = ()
    accepted_values: dict[str, tuple[str, ...]] = field(default_factory=dict)
    relationships: dict[str, tuple[str, str]] = field(default_factory=dict)  # col -> (parent model, field)


def _t(values) -> tuple[str, ...]:
    return tuple(values)


# The test catalogue (120 checks: staging 60, intermediate 23, marts 37).
CATALOGUE: dict[str, ModelTests] = {
    "stg_customers": ModelTests(
        "staging",
        not_null=("customer_id", "age_group", "acquisition_channel", "customer_segment", "products_count",
                  "is_active", "_loaded_at"),
        unique=("customer_id",),
        accepted_values={"age_group": _t(S.AGE_GROUPS), "acquisition_channel": _t(S.ACQUISITION_CHANNELS),
                         "customer_segment": _t(S.CUSTOMER_SEGMENTS)}),
    "stg_contracts": ModelTests(
        "staging",
        not_null=("contract_id", "customer_id", "product_type", "status", "principal_amount", "completion_rate"),
        unique=("contract_id",),
        accepted_values={"product_type": _t(S.PRODUCT_TYPES), "status": _t(S.CONTRACT_STATUSES),
                         "collateral": _t(S.COLLATERALS)},
        relationships={"customer_id": ("stg_customers", "customer_id")}),
    "stg_payments": ModelTests(
        "staging",
        not_null=("payment_id", "contract_id", "customer_id", "payment_method", "status", "lateness_bucket",
                  "amount_due"),
        unique=("payment_id",),
        accepted_values={"payment_method": _t(S.PAYMENT_METHODS), "status": _t(S.PAYMENT_STATUSES),
                         "lateness_bucket": _t(S.LATENESS_BUCKETS)}),
    "stg_app_events": ModelTests(
        "staging",
        not_null=("event_id", "customer_id", "event_type", "channel", "session_duration_seconds"),
        unique=("event_id",),
        accepted_values={"event_type": _t(S.EVENT_TYPES), "channel": _t(S.EVENT_CHANNELS)}),
    "stg_proposals": ModelTests(
        "staging",
        not_null=("proposal_id", "customer_id", "decision", "product_type", "requested_amount",
                  "bureau_score_band"),
        unique=("proposal_id",),
        accepted_values={"decision": _t(S.DECISIONS), "product_type": _t(S.PRODUCT_TYPES),
                         "bureau_score_band": _t(S.BUREAU_BANDS)}),
    "stg_collections": ModelTests(
        "staging",
        not_null=("collection_id", "contract_id", "customer_id", "channel_used", "overdue_bucket",
                  "days_overdue_at_trigger"),
        unique=("collection_id",),
        accepted_values={"channel_used": _t(S.COLLECTION_CHANNELS), "overdue_bucket": _t(S.OVERDUE_BUCKETS)}),
    "int_customer_credit_profile": ModelTests(
        "intermediate",
        not_null=("customer_id", "customer_segment", "acquisition_channel", "total_contracts"),
        unique=("customer_id",),
        accepted_values={"customer_segment": _t(S.CUSTOMER_SEGMENTS)}),
    "int_customer_digital_behavior": ModelTests(
        "intermediate",
        not_null=("customer_id", "event_month", "logins_count", "app_engagement_score", "trend_30d"),
        accepted_values={"trend_30d": _t(S.TRENDS)}),
    "int_payment_performance": ModelTests(
        "intermediate",
        not_null=("due_month", "product_type", "total_payments", "default_rate_pct", "recovery_rate_pct"),
        accepted_values={"product_type": _t(S.PRODUCT_TYPES)}),
    "int_acquisition_quality": ModelTests(
        "intermediate",
        not_null=("acquisition_channel", "total_customers", "default_rate_pct", "avg_ticket"),
        unique=("acquisition_channel",)),
    "fct_credit_score": ModelTests(
        "marts",
        not_null=("customer_id", "credit_score", "risk_tier", "alert_30d", "app_engagement_score",
                  "component_payment", "_loaded_at"),
        unique=("customer_id",),
        accepted_values={"risk_tier": _t(S.RISK_TIERS)}),
    "fct_customer_ltv": ModelTests(
        "marts",
        not_null=("customer_id", "ltv_segment", "realized_ltv", "projected_ltv_12m", "acquisition_channel"),
        unique=("customer_id",),
        accepted_values={"ltv_segment": _t(S.LTV_SEGMENTS)}),
    "fct_portfolio_health": ModelTests(
        "marts",
        not_null=("mes", "total_active_contracts", "total_exposure", "default_rate", "npl_ratio", "is_peak_month"),
        unique=("mes",)),
    "fct_collection_efficiency": ModelTests(
        "marts",
        not_null=("channel_used", "trigger_bucket", "total_actions", "recovery_rate_pct", "best_trigger_bucket"),
        accepted_values={"trigger_bucket": _t(S.TRIGGER_BUCKETS)}),
    "fct_risk_segments": ModelTests(
        "marts",
        not_null=("customer_id", "segment", "rfm_score", "r_score", "f_score", "m_score"),
        unique=("customer_id",),
        accepted_values={"segment": _t(S.RFM_SEGMENTS)}),
}

#: Hashed keys of one task: the tasks grow in number with the model, not in size.
KEY_ROWS = 2_000_000

RESULT_COLUMNS = ["layer", "model", "column_name", "test", "failures"]


class QualityGateError(RuntimeError):
    """Raised when a layer's checks fail; carries the failing rows."""

    def __init__(self, layer: str, failures: list[tuple]):
        self.layer = layer
        self.failures = failures
        lines = ", ".join(f"{m}.{c} {t}={n}" for m, c, t, n in failures)
        super().__init__(f"data tests failed in layer '{layer}': {lines}")


def count_checks(catalogue: dict[str, ModelTests] = CATALOGUE) -> int:
    return sum(len(t.not_null) + len(t.unique) + len(t.accepted_values) + len(t.relationships)
               for t in catalogue.values())


def _offending(col: str, values: tuple[str, ...]) -> Column:
    return F.col(col).isNotNull() & ~F.col(col).isin(list(values))


def _dealt(hashes: DataFrame, rows: int | None) -> DataFrame:
    """``hashes`` in tasks of at most ``KEY_ROWS`` rows on average, if the session's shuffles would make larger ones."""
    tasks = -(-(rows or 0) // KEY_ROWS)
    if tasks <= int(hashes.sparkSession.conf.get("spark.sql.shuffle.partitions")):
        return hashes
    return hashes.repartition(tasks, "_hash")


def repeated_keys(df: DataFrame, col: str, hash_of: Callable[[Column], Column] = F.xxhash64,
                  rows: int | None = None) -> int:
    """Number of distinct non-null values of ``col`` that occur more than once; ``df`` has about ``rows`` rows, if known."""
    keys = df.select(F.col(col).alias("_key"), hash_of(F.col(col)).alias("_hash")).where("_key IS NOT NULL")
    hashes = _dealt(keys.select("_hash"), rows)
    twice = hashes.groupBy("_hash").agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").select("_hash")
    # most often none; a few are enough to know that the keys themselves must be counted
    if not twice.take(1):
        return 0
    return keys.join(twice, "_hash", "left_semi").groupBy("_key").agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").count()


def orphans(child: DataFrame, col: str, parent: DataFrame, key: str) -> int:
    """Rows of ``child`` whose non-null ``col`` has no row in ``parent``."""
    keys = child.where(F.col(col).isNotNull()).groupBy(F.col(col).alias("_key")).agg(F.count(F.lit(1)).alias("_n"))
    lost = keys.join(parent.select(F.col(key).alias("_parent")), F.col("_key") == F.col("_parent"), "left_anti")
    return lost.agg(F.sum("_n")).first()[0] or 0


class Watch:
    """The tests of one model, counted while ``frame`` is computed by an action."""

    def __init__(self, model: str, df: DataFrame, tests: ModelTests):
        self.model, self.tests, self._counts = model, tests, None
        counts = [F.count_if(F.col(c).isNull()).alias(f"nn{i}") for i, c in enumerate(tests.not_null)]
        counts += [F.count_if(_offending(c, v)).alias(f"av{i}") for i, (c, v) in enumerate(tests.accepted_values.items())]
        self._observation = Observation() if counts else None
        self.frame = df.observe(self._observation, *counts) if counts else df

    def results(self, stored: DataFrame, parents: dict[str, DataFrame], passed: bool = True,
                rows: int | None = None) -> list[tuple]:
        """(layer, model, column_name, test, failures) of all tests.

        ``stored`` holds the rows that the action on ``frame`` saw.  ``passed``: that action is over; otherwise the pass
        for repeated keys is it (``stored`` is ``frame`` then).  ``rows``: about how many rows the model has, if known.
        """
        t = self.tests
        unique = {c: repeated_keys(self.frame if not passed and i == 0 else stored, c, rows=rows)
                  for i, c in enumerate(t.unique)}
        if not passed and not unique:
            self.frame.agg(F.count(F.lit(1))).first()
        counts = self._observation.get if self._observation else {}
        found = [(c, "not_null", counts[f"nn{i}"] and stored.where(F.col(c).isNull()).count())
                 for i, c in enumerate(t.not_null)]
        for i, (c, values) in enumerate(t.accepted_values.items()):
            n = counts[f"av{i}"] and stored.where(_offending(c, values)).select(c).distinct().count()
            found.append((c, "accepted_values", n))
        found += [(c, "unique", n) for c, n in unique.items()]
        for c, (parent, key) in t.relationships.items():
            if parent not in parents:
                raise KeyError(f"relationships test on {self.model}.{c} needs model '{parent}'")
            found.append((c, "relationships", orphans(stored, c, parents[parent], key)))
        return [(t.layer, self.model, c, test, int(n)) for c, test, n in found]


def watch(model: str, df: DataFrame, catalogue: dict[str, ModelTests] = CATALOGUE) -> Watch:
    return Watch(model, df, catalogue[model])


def _collected(spark: SparkSession, jobs: list[Callable[[], list[tuple]]], parallelism: int) -> DataFrame:
    """The results of the models' tests, whose small jobs are submitted together."""
    with ThreadPoolExecutor(max_workers=max(1, parallelism)) as pool:
        rows = [row for found in pool.map(lambda job: job(), jobs) for row in found]
    return spark.createDataFrame(rows, "layer string, model string, column_name string, test string, failures long")


def check_watched(watches: dict[str, Watch], stored: dict[str, DataFrame], parents: dict[str, DataFrame] | None = None,
                  parallelism: int = 6) -> DataFrame:
    """The tests of tables that were written through their ``Watch``; ``stored`` are the written tables."""
    if not watches:
        raise ValueError("no model to check")
    frames = {**(parents or {}), **stored}
    jobs = [lambda n=n, w=w: w.results(stored[n], frames) for n, w in watches.items()]
    return _collected(next(iter(stored.values())).sparkSession, jobs, parallelism)


def run_checks(models: dict[str, DataFrame], catalogue: dict[str, ModelTests] = CATALOGUE,
               parents: dict[str, DataFrame] | None = None, parallelism: int = 6,
               rows: dict[str, int] | None = None) -> DataFrame:
    """All tests of the models present in ``models`` as one DataFrame; each model is read once, for its keys.
    ``rows``: about how many rows a model has, where that is known."""
    frames = {**(parents or {}), **models}
    present = [m for m in catalogue if m in models]
    if not present:
        raise ValueError("no model to check")
    for m in present:
        for parent, _ in catalogue[m].relationships.values():
            if parent not in frames:
                raise KeyError(f"relationships test needs model '{parent}'")

    def job(m: str) -> list[tuple]:
        tested = catalogue[m]
        columns = dict.fromkeys([*tested.not_null, *tested.unique, *tested.accepted_values, *tested.relationships])
        df = models[m].select(*columns)
        return Watch(m, df, tested).results(df, frames, passed=False, rows=(rows or {}).get(m))

    return _collected(models[present[0]].sparkSession, [lambda m=m: job(m) for m in present], parallelism)


def gate(results: DataFrame, layer: str) -> None:
    """Raise ``QualityGateError`` if any check of the layer failed (reads only failing rows)."""
    bad = (results.where(F.col("failures") > 0)
                  .select("model", "column_name", "test", "failures").collect())
    if bad:
        raise QualityGateError(layer, [tuple(r) for r in bad])
