"""Named queries over the driver tables: one entry per model / test / report / ML step.

Every query reads the driver tables of ``sf_dir`` through the fixture mapping, so its work
grows with those tables.  ``Layers`` builds each model lazily and only once per call.
"""

from __future__ import annotations

import threading
from collections.abc import Callable
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from riskmart.functions import register_sql_functions
from riskmart.operators import quality
from riskmart.pipeline import with_audit
from riskmart.plans import features, intermediate, marts, reports, staging, summaries
from riskmart.sources import fixtures


class Layers:
    """Lazily built models for one (session, data folder) pair."""

    def __init__(self, spark: SparkSession, sf_dir: str, as_of=fixtures.AS_OF):
        self.spark = spark
        register_sql_functions(spark)
        self.sf_dir = sf_dir
        self.as_of = as_of

    @cached_property
    def sources(self) -> dict[str, DataFrame]:
        return fixtures.fixture_sources(self.spark, self.sf_dir)

    @cached_property
    def stg(self) -> dict[str, DataFrame]:
        return staging.build_staging(self.sources, self.as_of)

    @cached_property
    def int(self) -> dict[str, DataFrame]:
        return intermediate.build_intermediate(self.stg, self.as_of)

    @cached_property
    def mart(self) -> "_LazyMarts":
        return _LazyMarts(self)

    @cached_property
    def default_models(self):
        """Trained future-default candidates (best first) and their test split, trained once."""
        from riskmart.learn import train

        return train.train_default_models(_default_features(self), features.DEFAULT_NUMERIC, features.CATEGORICAL)

    @cached_property
    def alert_model(self):
        """The alert_30d forest and its test split, trained once."""
        from riskmart.learn import train

        return train.train_alert_model(_alert_features(self), features.ALERT_NUMERIC, features.CATEGORICAL)


_CACHE: dict[tuple, Layers] = {}
_CACHE_LOCK = threading.Lock()
#: Folders whose built models are remembered.
CACHED_FOLDERS = 2


def _files(spark: SparkSession, sf_dir: str) -> tuple:
    """Name, size and time of the files in a folder: changed files are not served from the cache."""
    path = spark._jvm.org.apache.hadoop.fs.Path(sf_dir)
    found = path.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(path)
    return tuple(sorted((f.getPath().getName(), f.getLen(), f.getModificationTime()) for f in found))


def layers(spark: SparkSession, sf_dir: str) -> Layers:
    """The lazily built models of ``sf_dir`` for this session, shared by the queries of a process
    (marts that need ranking passes are built once); the last folders only."""
    key = (spark._jsparkSession.sessionUUID(), sf_dir.rstrip("/"), _files(spark, sf_dir))
    with _CACHE_LOCK:
        found = _CACHE.pop(key, None) or Layers(spark, sf_dir)
        _CACHE[key] = found
        while len(_CACHE) > CACHED_FOLDERS:
            _CACHE.pop(next(iter(_CACHE)))
        return found


class _LazyMarts:
    """Marts built on first access: ranking passes checkpoint eagerly, so build only what is used."""

    def __init__(self, layers: Layers):
        self._l = layers
        self._built: dict[str, DataFrame] = {}
        self._lock = threading.RLock()

    def __getitem__(self, name: str) -> DataFrame:
        with self._lock:
            return self._get(name)

    def _get(self, name: str) -> DataFrame:
        if name not in self._built:
            stg, inter, as_of = self._l.stg, self._l.int, self._l.as_of
            builders = {
                "fct_credit_score": lambda: marts.fct_credit_score(
                    inter["int_customer_credit_profile"], inter["int_customer_digital_behavior"],
                    stg["stg_customers"]),
                "fct_customer_ltv": lambda: marts.fct_customer_ltv(
                    inter["int_customer_credit_profile"], inter["int_acquisition_quality"]),
                "fct_portfolio_health": lambda: marts.fct_portfolio_health(stg["stg_payments"], stg["stg_contracts"]),
                "fct_collection_efficiency": lambda: marts.fct_collection_efficiency(stg["stg_collections"]),
                "fct_risk_segments": lambda: marts.fct_risk_segments(stg["stg_payments"], stg["stg_customers"], as_of),
            }
            self._built[name] = builders[name]()
        return self._built[name]


def _layer(layer: str, name: str) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf_dir: getattr(layers(spark, sf_dir), layer)[name]


STAGING = ["stg_customers", "stg_contracts", "stg_payments", "stg_app_events", "stg_proposals",
           "stg_collections"]
INTERMEDIATE = ["int_customer_credit_profile", "int_customer_digital_behavior", "int_payment_performance",
                "int_acquisition_quality"]
MARTS = ["fct_credit_score", "fct_customer_ltv", "fct_portfolio_health", "fct_collection_efficiency",
         "fct_risk_segments"]


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    q: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
    for name in STAGING:
        q[name] = _layer("stg", name)
    for name in INTERMEDIATE:
        q[name] = _layer("int", name)
    for name in MARTS:
        q[name] = _layer("mart", name)
    q["dq_results"] = dq_results
    q["quality_report"] = lambda spark, sf_dir: _quality_report(layers(spark, sf_dir))
    q["dataset_report"] = lambda spark, sf_dir: summaries.dataset_report(layers(spark, sf_dir).sources)
    q["ml_default_features"] = lambda spark, sf_dir: _default_features(layers(spark, sf_dir))
    q["ml_alert_features"] = lambda spark, sf_dir: _alert_features(layers(spark, sf_dir))
    q.update(_ml_queries())
    for name, fn in _report_queries().items():
        q[name] = (lambda f: lambda spark, sf_dir: f(layers(spark, sf_dir)))(fn)
    return q


def _report_queries() -> dict[str, Callable[[Layers], DataFrame]]:
    since, min_c = fixtures.REPORT_SINCE, fixtures.MIN_MONTH_CONTRACTS
    m = lambda l, n: l.mart[n]
    return {
        "portfolio_kpis": lambda l: reports.portfolio_kpis(l.stg["stg_contracts"]),
        "default_rate": lambda l: reports.default_rate(m(l, "fct_portfolio_health"), since),
        "active_customers": lambda l: reports.active_customers(l.stg["stg_customers"]),
        "ltv_summary": lambda l: reports.ltv_summary(m(l, "fct_customer_ltv")),
        "monthly_default": lambda l: reports.monthly_default(m(l, "fct_portfolio_health"), since),
        "product_risk": lambda l: reports.product_risk(l.int["int_payment_performance"]),
        "exposure_monthly": lambda l: reports.exposure_monthly(m(l, "fct_portfolio_health"), since),
        "score_dist_detail": lambda l: reports.score_dist_detail(m(l, "fct_credit_score")),
        "score_buckets": lambda l: reports.score_buckets(m(l, "fct_credit_score")),
        "optimal_collection": lambda l: reports.optimal_collection(m(l, "fct_collection_efficiency")),
        "score_distribution": lambda l: reports.score_distribution(m(l, "fct_credit_score")),
        "risk_tier_summary": lambda l: reports.risk_tier_summary(m(l, "fct_credit_score")),
        "channel_risk": lambda l: reports.channel_risk(l.int["int_acquisition_quality"]),
        "alerts_detail": lambda l: reports.alerts_detail(m(l, "fct_credit_score")),
        "vintage_analysis": lambda l: reports.vintage_analysis(l.stg["stg_contracts"]),
        "collection_eff": lambda l: reports.collection_eff(m(l, "fct_collection_efficiency")),
        "rfm_overview": lambda l: reports.rfm_overview(m(l, "fct_risk_segments")),
        "ltv_by_segment_channel": lambda l: reports.ltv_by_segment_channel(m(l, "fct_customer_ltv")),
        "ltv_segment_summary": lambda l: reports.ltv_segment_summary(m(l, "fct_customer_ltv")),
        "digital_by_segment": lambda l: reports.digital_by_segment(
            m(l, "fct_risk_segments"), l.int["int_customer_digital_behavior"]),
        "header_kpis": lambda l: reports.header_kpis(m(l, "fct_credit_score"), m(l, "fct_portfolio_health"), min_c),
        "monthly_line": lambda l: reports.monthly_line(m(l, "fct_portfolio_health"), min_c),
        "product_bars": lambda l: reports.product_bars(l.int["int_payment_performance"]),
        "alert_count": lambda l: reports.alert_count(m(l, "fct_credit_score")),
        "tier_distribution": lambda l: reports.tier_distribution(m(l, "fct_credit_score")),
        "channel_risk_dashboard": lambda l: reports.channel_risk_dashboard(l.int["int_acquisition_quality"]),
        "top_alerts": lambda l: reports.top_alerts(m(l, "fct_credit_score")),
        "segment_counts": lambda l: reports.segment_counts(m(l, "fct_risk_segments")),
        "ltv_by_segment": lambda l: reports.ltv_by_segment(m(l, "fct_customer_ltv")),
        "channel_quality": lambda l: reports.channel_quality(l.int["int_acquisition_quality"]),
        "score_histogram": lambda l: reports.score_histogram(m(l, "fct_credit_score")),
        "top_at_risk": lambda l: reports.top_at_risk(m(l, "fct_credit_score")),
        "channel_by_ltv": lambda l: reports.channel_by_ltv(l.int["int_acquisition_quality"]),
        "best_collection_window": lambda l: reports.best_collection_window(m(l, "fct_collection_efficiency")),
    }


def _ml_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    """Training/scoring steps.  Trained models have no SQL oracle (rows-only check)."""
    from riskmart.learn import metrics, train

    num, cat = features.DEFAULT_NUMERIC, features.CATEGORICAL
    anum = features.ALERT_NUMERIC

    def split(spark, sf_dir):
        f = _default_features(layers(spark, sf_dir))
        return train.stratified_split(f, "target").select("customer_id", "target", "split")

    def class_weights(spark, sf_dir):
        f = train.stratified_split(_default_features(layers(spark, sf_dir)), "target").where("split = 'train'")
        weights = train.balanced_weights(f, "target")
        return spark.createDataFrame([(k, float(v)) for k, v in sorted(weights.items())], "target int, weight double")

    def feature_metrics(spark, sf_dir):
        return metrics.feature_metrics(_default_features(layers(spark, sf_dir)), num, "target")

    def scaler(spark, sf_dir):
        f = train.stratified_split(_default_features(layers(spark, sf_dir)), "target").where("split = 'train'")
        return metrics.scaler_statistics(f, num)

    def model_metrics(spark, sf_dir):
        results, _ = layers(spark, sf_dir).default_models
        return train.metrics_frame(spark, results)

    def linear_attr(spark, sf_dir):
        results, test = layers(spark, sf_dir).default_models
        lr = next(r for r in results if r.name == "LogisticRegression")
        return train.linear_attribution(lr, test, num, cat)

    def alert_metrics(spark, sf_dir):
        trained, _ = layers(spark, sf_dir).alert_model
        return train.metrics_frame(spark, [trained])

    def importance(spark, sf_dir):
        trained, _ = layers(spark, sf_dir).alert_model
        return train.importance_frame(spark, train.forest_importances(trained, anum, cat))

    def batch_scores(spark, sf_dir):
        l = layers(spark, sf_dir)
        trained, _ = l.alert_model
        return train.score(trained.model, _alert_features(l))

    return {"ml_split": split, "ml_class_weights": class_weights, "ml_feature_metrics": feature_metrics,
            "ml_scaler_statistics": scaler, "model_metrics": model_metrics, "ml_linear_attribution": linear_attr,
            "ml_alert_metrics": alert_metrics, "feature_importance": importance, "ml_batch_scores": batch_scores}


def _default_features(l: Layers) -> DataFrame:
    return features.default_features(l.stg, fixtures.ML_CUTOFF, fixtures.ML_LABEL_END, fixtures.ML_RECENT_START,
                                     fixtures.ML_EVENT_START, fixtures.ML_EVENT_END)


def _alert_features(l: Layers) -> DataFrame:
    return features.alert_features(l.mart["fct_credit_score"], l.stg["stg_customers"])


def _quality_report(l: Layers) -> DataFrame:
    return summaries.quality_report(l.stg["stg_customers"], l.stg["stg_payments"], l.stg["stg_contracts"])


def dq_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All 120 data tests over every model (audit columns added as the writer would)."""
    l = layers(spark, sf_dir)
    models = {n: with_audit(df) for n, df in l.stg.items()}
    models.update({n: with_audit(df) for n, df in l.int.items()})
    models.update({n: with_audit(l.mart[n]) for n in MARTS})
    return quality.run_checks(models, rows=fixtures.fixture_rows(spark, sf_dir))
