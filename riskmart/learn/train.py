"""Training, evaluation and scoring with ``pyspark.ml``.

Everything heavy runs on executors: the split and weights are column expressions, fitting is
``Pipeline.fit``, metrics are one aggregate (confusion counts) plus the distributed ROC of
``BinaryClassificationEvaluator``.  Only bounded results reach the driver: two class counts,
one mean/std per feature, the confusion counts and the fitted coefficients.
"""

from __future__ import annotations

import datetime as dt
import hashlib
import json
import math
import uuid
from dataclasses import dataclass, field

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import OneHotEncoder, StandardScaler, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskmart.operators.selection import select_places
from riskmart.session import checkpoint_table
from riskmart.snapshots import claim_number, path_exists

SEED = 42
LABEL, WEIGHT, FEATURES = "label", "class_weight", "features"


# ---- L8 split, L10 weights -------------------------------------------------------------------
def stratified_split(df: DataFrame, label_col: str, key: str = "customer_id", test_fraction: float = 0.2,
                     seed: int = SEED) -> DataFrame:
    """Adds ``split`` ('train'/'test'): within each class, the rows with the highest seeded hash
    of ``key`` — ceil(test_fraction * class size) of them — form the test set.

    Exact per-class proportions without sorting or collecting a class: the last training row of each class is found by
    selection, and every row is compared with it.  The hash is md5 of "key:seed", which other engines have as well.
    """
    h = F.md5(F.concat(F.col(key).cast("string"), F.lit(f":{seed}")))
    base = df.withColumn("_lbl", F.col(label_col).cast("int"))
    # only (label, hash, key) is written for the passes of the selection
    hashed = checkpoint_table(base.select("_lbl", h.alias("_h"), F.col(key).cast("string").alias("_k")), "riskmart-split")
    sizes = {r["_lbl"]: r["n"] for r in hashed.groupBy("_lbl").agg(F.count(F.lit(1)).alias("n")).collect()}
    in_train = F.lit(False)
    for label, n in sizes.items():
        cut = n - math.ceil(n * test_fraction)
        own = hashed.where(F.col("_lbl").eqNullSafe(F.lit(label).cast("int")))
        for row in select_places(own, [cut], "_h", "_k").values():  # none, if the class has no training row
            in_train = in_train | (F.col("_lbl").eqNullSafe(F.lit(label).cast("int")) & (
                (F.col("_h") < row["_h"]) | ((F.col("_h") == row["_h"]) & (F.col(key).cast("string") <= row["_k"]))))
    return base.withColumn("_h", h).withColumn("split", F.when(in_train, "train").otherwise("test")).drop("_lbl", "_h")


def balanced_weights(train: DataFrame, label_col: str) -> dict[int, float]:
    """``n / (k * n_c)`` per class (k classes) — a k-row aggregate."""
    counts = {int(r[0]): int(r[1]) for r in train.groupBy(F.col(label_col).cast("int")).count().collect()}
    n, k = sum(counts.values()), len(counts)
    return {c: n / (k * nc) for c, nc in counts.items()}


def with_weights(df: DataFrame, label_col: str, weights: dict[int, float]) -> DataFrame:
    w = F.lit(None).cast("double")
    for c, v in weights.items():
        w = F.when(F.col(label_col).cast("int") == c, F.lit(v)).otherwise(w)
    return df.withColumn(WEIGHT, w).withColumn(LABEL, F.col(label_col).cast("double"))


# ---- L9 preprocessing ------------------------------------------------------------------------
def preprocessing_stages(numeric: list[str], categorical: list[str]) -> list:
    """Standardised numerics + one-hot categoricals (unseen category -> all zeros)."""
    idx = [StringIndexer(inputCols=list(categorical), outputCols=[f"{c}__idx" for c in categorical],
                         handleInvalid="keep", stringOrderType="alphabetAsc")]  # one pass for all columns
    # 'keep' adds one slot for unseen values as the last index; dropLast drops exactly that slot
    ohe = OneHotEncoder(inputCols=[f"{c}__idx" for c in categorical],
                        outputCols=[f"{c}__ohe" for c in categorical], dropLast=True)
    num = VectorAssembler(inputCols=numeric, outputCol="num__vec", handleInvalid="keep")
    scale = StandardScaler(inputCol="num__vec", outputCol="num__scaled", withMean=True, withStd=True)
    feats = VectorAssembler(inputCols=["num__scaled"] + [f"{c}__ohe" for c in categorical], outputCol=FEATURES)
    return idx + [ohe, num, scale, feats]


def feature_names(model: PipelineModel, numeric: list[str], categorical: list[str]) -> list[str]:
    indexer = next(s for s in model.stages if hasattr(s, "labelsArray"))
    labels = dict(zip(indexer.getInputCols(), (list(a) for a in indexer.labelsArray)))
    return list(numeric) + [f"{c}_{v}" for c in categorical for v in labels[c]]


def fit_with_prep(prep: PipelineModel, train_prepped: DataFrame, classifier) -> PipelineModel:
    """Fit ``classifier`` on already-transformed rows and return prep + classifier as one model."""
    return PipelineModel(stages=list(prep.stages) + [without_summary(classifier.fit(train_prepped))])


def without_summary(model):
    """A fitted classifier (also as the last stage of a pipeline) without its training summary, which holds the session.

    In Spark 4.1 a session that has an ``Observation`` (the data tests use them) cannot be serialised, and with it no
    model that still has its summary.
    """
    last = model.stages[-1] if isinstance(model, PipelineModel) else model
    if getattr(last, "hasSummary", False):
        last._java_obj.setSummary(SparkSession.active()._jvm.scala.Option.empty())
    return model


# ---- L11/L12 models ------------------------------------------------------------------------
def logistic(n_train: int, max_iter: int = 500, tol: float = 1e-4) -> LogisticRegression:
    # L2 with C = 1 on a weighted sum of losses == regParam 1/sum(w) on Spark's weighted mean;
    # tol 1e-4 as in the reference's solver (Spark's default 1e-6 runs hundreds more jobs)
    return LogisticRegression(featuresCol=FEATURES, labelCol=LABEL, weightCol=WEIGHT, maxIter=max_iter, tol=tol,
                              regParam=1.0 / max(n_train, 1), elasticNetParam=0.0, standardization=False)


def forest(num_trees: int, max_depth: int, seed: int = SEED, max_bins: int = 256) -> RandomForestClassifier:
    """``max_bins`` is the number of split candidates of a numeric feature; Spark also takes its thresholds from a
    sample of about max(max_bins ** 2, 10 000) rows."""
    return RandomForestClassifier(featuresCol=FEATURES, labelCol=LABEL, weightCol=WEIGHT, numTrees=num_trees,
                                  maxDepth=max_depth, seed=seed, maxBins=max_bins)


# ---- L14 metrics ---------------------------------------------------------------------------
def evaluate(pred: DataFrame) -> dict[str, float]:
    """accuracy, precision / recall / F1 of the positive class, exact ROC AUC of P(class 1)."""
    # the model is applied once: the counts and the passes of the curve read these three columns
    pred = pred.select(LABEL, "prediction", "probability").persist()
    y, p = F.col(LABEL), F.col("prediction")
    c = pred.agg(F.count_if((y == 1) & (p == 1)).alias("tp"), F.count_if((y == 0) & (p == 1)).alias("fp"),
                 F.count_if((y == 1) & (p == 0)).alias("fn"), F.count_if((y == 0) & (p == 0)).alias("tn")).first()
    tp, fp, fn, tn = (int(c[k] or 0) for k in ("tp", "fp", "fn", "tn"))
    precision = tp / (tp + fp) if tp + fp else 0.0
    recall = tp / (tp + fn) if tp + fn else 0.0
    f1 = 2 * precision * recall / (precision + recall) if precision + recall else 0.0
    n = tp + fp + fn + tn
    # numBins=0: every distinct score is a point of the curve
    auc = BinaryClassificationEvaluator(rawPredictionCol="probability", labelCol=LABEL,
                                        metricName="areaUnderROC", numBins=0).evaluate(pred)
    pred.unpersist()
    return {"accuracy": (tp + tn) / n if n else 0.0, "precision": precision, "recall": recall, "f1_score": f1,
            "auc_roc": auc}


#: Names of the classes in the report.
CLASS_NAMES = {0: "no_default", 1: "default"}


def class_report(pred: DataFrame) -> DataFrame:
    """Per class and averaged (macro: plain, weighted: by support): precision, recall, F1, support."""
    cells = pred.groupBy(F.col(LABEL).cast("int").alias("y"), F.col("prediction").cast("int").alias("p")).count()
    n = {(r["y"], r["p"]): int(r["count"]) for r in cells.collect()}  # classes squared
    rows = []
    for k, name in CLASS_NAMES.items():
        hit, said = n.get((k, k), 0), sum(v for (_, p), v in n.items() if p == k)
        support = sum(v for (y, _), v in n.items() if y == k)
        precision, recall = (hit / x if x else 0.0 for x in (said, support))
        f1 = 2 * precision * recall / (precision + recall) if precision + recall else 0.0
        rows.append((name, precision, recall, f1, support))
    total = sum(r[4] for r in rows)
    for name, weights in (("macro avg", [1] * len(rows)), ("weighted avg", [r[4] for r in rows])):
        mean = [sum(w * r[i] for w, r in zip(weights, rows)) / (sum(weights) or 1) for i in (1, 2, 3)]
        rows.append((name, *mean, total))
    return pred.sparkSession.createDataFrame(
        rows, "class string, precision double, recall double, f1_score double, support long")


@dataclass
class Trained:
    name: str
    model: PipelineModel
    metrics: dict[str, float]
    params: dict[str, object] = field(default_factory=dict)


def _noisy(train: DataFrame, numeric: list[str], scale: float = 0.05, seed: int = SEED) -> DataFrame:
    """Numerics plus Gaussian noise of ``scale`` x their training std."""
    stds = train.agg(*[F.stddev(c).alias(c) for c in numeric]).first()
    out = train
    for i, c in enumerate(numeric):
        out = out.withColumn(c, F.col(c).cast("double") + F.randn(seed + i) * F.lit(float(stds[c] or 0.0) * scale))
    return out


def train_default_models(features: DataFrame, numeric: list[str], categorical: list[str],
                         label_col: str = "target", guard_auc: float = 0.90) -> tuple[list[Trained], DataFrame]:
    """L8–L15 for the future-default label: logistic + forest 100x6, the overfit guard, best by F1.

    Returns the trained candidates (best first) and the test split (with label/weight columns),
    which is kept in memory for the caller to unpersist.
    """
    # the features are evaluated once: the split and everything after it read this table
    split = stratified_split(checkpoint_table(features, "riskmart-features"), label_col)
    train = split.where(F.col("split") == "train")
    test = split.where(F.col("split") == "test")
    weights = balanced_weights(train, label_col)
    # both sides are read by every fit and evaluation: keep them (memory, spilling to disk)
    train = with_weights(train, label_col, weights).persist()
    test = with_weights(test, label_col, weights).persist()
    n_train = train.count()
    # the preprocessing is fitted once and shared by both candidates
    prep = Pipeline(stages=preprocessing_stages(numeric, categorical)).fit(train)
    # kept are the columns that the classifiers read, not the vectors on the way to them
    train_prepped = prep.transform(train).select(FEATURES, LABEL, WEIGHT).persist()
    candidates = {
        "LogisticRegression": (logistic(n_train), {"max_iter": 500, "class_weight": "balanced"}),
        "RandomForest": (forest(100, 6), {"n_estimators": 100, "max_depth": 6, "class_weight": "balanced"}),
    }
    results: list[Trained] = []
    for name, (clf, params) in candidates.items():
        model = fit_with_prep(prep, train_prepped, clf)
        results.append(Trained(name, model, evaluate(model.transform(test)), params))
    for r in list(results):
        if r.metrics["auc_roc"] > guard_auc:
            # noise goes on the raw numerics, so this candidate fits its own preprocessing
            model = without_summary(Pipeline(stages=preprocessing_stages(numeric, categorical) + [forest(50, 4)]).fit(
                _noisy(train, numeric)))
            results.append(Trained(r.name + "_reduced", model, evaluate(model.transform(test)),
                                   {"n_estimators": 50, "max_depth": 4, "noise": 0.05}))
    results.sort(key=lambda t: t.metrics["f1_score"], reverse=True)
    train_prepped.unpersist()
    train.unpersist()
    return results, test


def train_alert_model(features: DataFrame, numeric: list[str], categorical: list[str],
                      label_col: str = "alert_30d") -> tuple[Trained, DataFrame]:
    """Forest 100x8 on the score-mart features, label ``alert_30d`` (the second training job)."""
    split = stratified_split(checkpoint_table(features, "riskmart-features"), label_col)
    train = split.where(F.col("split") == "train")
    test = split.where(F.col("split") == "test")
    weights = balanced_weights(train, label_col)
    train = with_weights(train, label_col, weights).persist()
    test = with_weights(test, label_col, weights).persist()
    model = without_summary(Pipeline(stages=preprocessing_stages(numeric, categorical) + [forest(100, 8)]).fit(train))
    params = {"n_estimators": 100, "max_depth": 8, "class_weight": "balanced", "random_state": SEED}
    out = Trained("RandomForest", model, evaluate(model.transform(test)), params)
    train.unpersist()
    return out, test


# ---- L16 / L17 explanations ------------------------------------------------------------------
def linear_attribution(trained: Trained, test: DataFrame, numeric: list[str], categorical: list[str]) -> DataFrame:
    """Mean |coef_i * (x_i - mean_i)| over the whole test set, per transformed feature."""
    lr = trained.model.stages[-1]
    coef = lr.coefficients.toArray().tolist()
    names = feature_names(trained.model, numeric, categorical)
    x = trained.model.transform(test).select(vector_to_array(FEATURES).alias("x"))
    means = x.agg(*[F.avg(F.col("x")[i]).alias(f"m{i}") for i in range(len(coef))]).first()
    attr = x.agg(*[F.avg(F.abs(F.lit(coef[i]) * (F.col("x")[i] - F.lit(float(means[f"m{i}"] or 0.0)))))
                   .alias(f"a{i}") for i in range(len(coef))])
    stack = F.array(*[F.struct(F.lit(names[i]).alias("feature"), F.col(f"a{i}").alias("importance"))
                      for i in range(len(coef))])
    return attr.select(F.explode(stack).alias("r")).select("r.*")


def forest_importances(trained: Trained, numeric: list[str], categorical: list[str]) -> list[tuple[str, float]]:
    rf = trained.model.stages[-1]
    names = feature_names(trained.model, numeric, categorical)
    return sorted(zip(names, rf.featureImportances.toArray().tolist()), key=lambda t: -t[1])


def top_features(trained: Trained, test: DataFrame, numeric: list[str], categorical: list[str]) -> DataFrame:
    """(feature, importance) of a trained candidate: the linear attribution, or a forest's own importances."""
    if hasattr(trained.model.stages[-1], "coefficients"):
        return linear_attribution(trained, test, numeric, categorical)
    pairs = forest_importances(trained, numeric, categorical)
    return importance_frame(test.sparkSession, pairs).select("feature", "importance")


def importance_frame(spark: SparkSession, pairs: list[tuple[str, float]]) -> DataFrame:
    """(feature, importance, ranking) with ``rank() over (order by importance desc)`` (K9)."""
    df = spark.createDataFrame([(f, float(v)) for f, v in pairs], "feature string, importance double")
    return df.withColumn("ranking", F.rank().over(Window.orderBy(F.col("importance").desc())))


# ---- L18 scoring, B4–B7 records -------------------------------------------------------------
def score(model: PipelineModel, df: DataFrame, key: str = "customer_id") -> DataFrame:
    """Batch scoring: predicted class and P(class 1) per row."""
    return model.transform(df).select(
        key, F.col("prediction").cast("int").alias("predicted_class"),
        vector_to_array("probability")[1].alias("probability_default"))


def metrics_frame(spark: SparkSession, results: list[Trained]) -> DataFrame:
    rows = [(r.name, k, float(v)) for r in results for k, v in r.metrics.items()]
    return spark.createDataFrame(rows, "model string, metric string, value double")


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def write_metrics_json(spark: SparkSession, best: Trained, extra: dict, path: str) -> None:
    """Metrics file of the chosen model (B4), one JSON record."""
    payload = {"model_name": best.name, **{k: round(v, 4) for k, v in best.metrics.items()}, **extra}
    spark.createDataFrame([(json.dumps(payload),)], "value string").coalesce(1).write.mode("overwrite").text(path)


RUN_SCHEMA = T.StructType([
    T.StructField("run_id", T.StringType()), T.StructField("ts", T.TimestampType()),
    T.StructField("run_name", T.StringType()),
    T.StructField("params", T.MapType(T.StringType(), T.StringType())),
    T.StructField("metrics", T.MapType(T.StringType(), T.DoubleType())),
    T.StructField("tags", T.MapType(T.StringType(), T.StringType())),
])


def log_run(spark: SparkSession, runs_path: str, run_name: str, params: dict, metrics: dict,
            tags: dict | None = None) -> str:
    """Append one run record (B6) to the ``ml_runs`` Parquet table; returns the run id."""
    run_id = uuid.uuid4().hex
    row = (run_id, dt.datetime.now(dt.timezone.utc).replace(tzinfo=None), run_name,
           {k: str(v) for k, v in params.items()}, {k: float(v) for k, v in metrics.items()},
           {k: str(v) for k, v in (tags or {}).items()})
    spark.createDataFrame([row], RUN_SCHEMA).write.mode("append").parquet(runs_path)
    return run_id


def register_version(spark: SparkSession, versions_path: str, name: str, model_path: str, run_id: str) -> int:
    """Append ``(name, version, path, run_id)`` to ``ml_model_versions``.

    The number is the next one above all recorded and claimed ones of ``name``; it is claimed by creating a file
    exclusively, so that concurrent jobs get different numbers.
    """
    prev = 0
    if path_exists(spark, versions_path):  # a table that cannot be read is an error, not a first version
        prev = (spark.read.parquet(versions_path).where(F.col("name") == name)
                .agg(F.max("version")).first()[0]) or 0
    folder = hashlib.sha256(name.encode()).hexdigest()[:16]
    version = claim_number(spark, f"{versions_path.rstrip('/')}_claims/{folder}", int(prev))
    spark.createDataFrame([(name, version, model_path, run_id)],
                          "name string, version int, model_path string, run_id string") \
        .write.mode("append").parquet(versions_path)
    return version
