"""ML: exact stratified split, balanced weights, training bounds, persistence round trip."""

import random
import tempfile

import pytest
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from driver_data import SF001, SF01
from riskmart.functions import dec_sum, register_sql_functions, wide_sum
from riskmart.learn import jobs, train
from riskmart.plans import features
from riskmart.registry import Layers, _alert_features, _default_features
from riskmart.sources import fixtures


def test_split_is_exact_per_class_and_disjoint(spark):
    feats = _default_features(Layers(spark, SF01))
    split = train.stratified_split(feats, "target")
    counts = {(r["target"], r["split"]): r["count"] for r in split.groupBy("target", "split").count().collect()}
    for cls in (0, 1):
        n = counts[(cls, "train")] + counts[(cls, "test")]
        assert counts[(cls, "test")] == -(-n * 2 // 10)  # ceil(0.2 n)
    assert split.count() == feats.count() == split.select("customer_id").distinct().count()
    again = train.stratified_split(feats, "target")
    assert split.join(again, ["customer_id", "split"]).count() == feats.count()  # deterministic


def test_balanced_weights_sum_to_n(spark):
    df = spark.createDataFrame([(i, 1 if i % 5 == 0 else 0) for i in range(100)], "customer_id int, y int")
    w = train.balanced_weights(df, "y")
    total = df.select(F.sum(F.when(F.col("y") == 1, w[1]).otherwise(w[0]))).first()[0]
    assert abs(total - 100) < 1e-9 and abs(w[1] - 2.5) < 1e-12


@pytest.fixture(scope="module")
def alert(spark):
    feats = _alert_features(Layers(spark, SF01))
    trained, _ = train.train_alert_model(feats, features.ALERT_NUMERIC, features.CATEGORICAL)
    return feats, trained


def test_alert_model_trains_scores_and_round_trips(spark, alert):
    feats, trained = alert
    for v in trained.metrics.values():
        assert 0.0 <= v <= 1.0
    names = train.feature_names(trained.model, features.ALERT_NUMERIC, features.CATEGORICAL)
    imp = train.forest_importances(trained, features.ALERT_NUMERIC, features.CATEGORICAL)
    assert len(imp) == len(names) and abs(sum(v for _, v in imp) - 1.0) < 1e-6
    path = tempfile.mkdtemp(prefix="riskmart-model-") + "/m"
    train.save_model(trained.model, path)
    s1 = train.score(trained.model, feats).orderBy("customer_id").collect()
    s2 = train.score(train.load_model(path), feats).orderBy("customer_id").collect()
    assert s1 == s2 and len(s1) == feats.count()
    assert all(0.0 <= r["probability_default"] <= 1.0 for r in s1)


def test_unseen_category_encodes_as_zeros(spark, alert):
    feats, trained = alert
    odd = feats.limit(1).withColumn("acquisition_channel", F.lit("never_seen"))
    vec = trained.model.transform(odd).select("acquisition_channel__ohe").first()[0]
    assert vec.numNonzeros() == 0


def test_run_records_append(spark):
    d = tempfile.mkdtemp(prefix="riskmart-runs-")
    rid = train.log_run(spark, f"{d}/ml_runs", "rf", {"n_estimators": 100}, {"auc_roc": 0.9}, {"stage": "staging"})
    v1 = train.register_version(spark, f"{d}/ml_model_versions", "credit_default", "/m/1", rid)
    v2 = train.register_version(spark, f"{d}/ml_model_versions", "credit_default", "/m/2", rid)
    assert (v1, v2) == (1, 2)
    runs = spark.read.parquet(f"{d}/ml_runs").collect()
    assert runs[0]["params"]["n_estimators"] == "100" and runs[0]["metrics"]["auc_roc"] == 0.9


def test_alert_job_writes_artefacts_and_records(spark):
    from riskmart.learn import jobs

    out = tempfile.mkdtemp(prefix="riskmart-job-")
    feats = _alert_features(Layers(spark, SF01))
    res = jobs.alert_job(spark, feats, out)
    assert res.version == 1
    imp = spark.read.option("header", True).csv(f"{out}/feature_importances")
    names = train.feature_names(res.best.model, features.ALERT_NUMERIC, features.CATEGORICAL)
    assert sorted(r["feature"] for r in imp.collect()) == sorted(names)
    metrics = jobs.read_metrics(spark, f"{out}/alert_metrics").first()
    assert metrics["model_name"] == "RandomForest" and 0.0 <= metrics["auc_roc"] <= 1.0
    loaded = train.load_model(res.model_path)
    assert train.score(loaded, feats).count() == feats.count()
    runs = spark.read.parquet(f"{out}/ml_runs").collect()
    assert len(runs) == 1 and runs[0]["tags"]["target"] == "alert_30d"


def test_auc_is_exact_on_many_scores(spark):
    rng = random.Random(1)
    rows = [(float(rng.random() < 0.3), rng.random()) for _ in range(5000)]
    ranks = {s: i + 1 for i, s in enumerate(sorted(s for _, s in rows))}
    pos = [s for y, s in rows if y == 1]
    exact = (sum(ranks[s] for s in pos) - len(pos) * (len(pos) + 1) / 2) / (len(pos) * (len(rows) - len(pos)))
    df = spark.createDataFrame([(y, float(s > 0.5), Vectors.dense([1 - s, s])) for y, s in rows],
                               ["label", "prediction", "probability"])
    assert abs(train.evaluate(df)["auc_roc"] - exact) < 1e-12


def test_class_report_by_hand(spark):
    df = spark.createDataFrame([(0.0, 0.0)] * 6 + [(0.0, 1.0)] * 2 + [(1.0, 1.0)] * 3 + [(1.0, 0.0)], ["label", "prediction"])
    got = {r["class"]: tuple(r)[1:] for r in train.class_report(df).collect()}
    assert got["no_default"] == pytest.approx((6 / 7, 0.75, 0.8, 8))
    assert got["default"] == pytest.approx((0.6, 0.75, 2 / 3, 4))
    assert got["macro avg"][3] == got["weighted avg"][3] == 12
    assert got["weighted avg"][0] == pytest.approx((8 * 6 / 7 + 4 * 0.6) / 12)


def test_off_grid_money_is_an_error_and_wide_sums_hold(spark):
    register_sql_functions(spark)
    off = spark.createDataFrame([(0.014,)] * 3, "x double")
    with pytest.raises(Exception, match="more decimals"):
        off.agg(dec_sum("x")).collect()
    cents = spark.createDataFrame([(9 * 10 ** 18,)] * 4, "u long")
    assert cents.agg(wide_sum("u")).first()[0] == 3.6e17


def test_default_job_with_forced_guard_writes_all_records(spark, tmp_path):
    feats = _default_features(Layers(spark, SF001))
    out = f"file://{tmp_path}/job"
    got = jobs.default_job(spark, feats, out, cutoff=fixtures.ML_CUTOFF, label_end=fixtures.ML_LABEL_END, guard_auc=0.0)
    metrics = jobs.read_metrics(spark, f"{out}/model_metrics").first().asDict()
    assert metrics["leakage_corrected"] is True and metrics["cutoff_date"] == "2000-12-31"
    assert metrics["target_window"] == "2001-01-01 to 2001-03-31"
    assert metrics["train_samples"] + metrics["test_samples"] == feats.count()
    assert len(metrics["top_features"]) == 10
    assert {"no_default", "default", "macro avg", "weighted avg"} == {
        r["class"] for r in spark.read.json(f"{out}/class_report").collect()}
    runs = spark.read.parquet(f"{out}/ml_runs").first()
    assert int(runs["params"]["candidates"]) == 4  # both candidates and, the guard being 0, both reduced ones
    assert got.version == 1
    assert jobs.train.register_version(spark, f"{out}/ml_model_versions", "credit_default", "p", "r") == 2
    prep = train.load_model(f"{out}/models/credit_default_preprocessing")
    assert train.FEATURES in prep.transform(feats).columns


def test_top_features_of_a_winning_forest(spark, alert):
    feats, trained = alert
    test = train.with_weights(feats.withColumn("label", F.lit(0.0)), "alert_30d", {0: 1.0, 1: 1.0})
    top = train.top_features(trained, test, features.ALERT_NUMERIC, features.CATEGORICAL).collect()
    assert abs(sum(r["importance"] for r in top) - 1.0) < 1e-6
