"""Training keeps what it reads again: predictions are made once, and only the classifiers' columns are held."""

import random

from pyspark.ml.linalg import Vectors, VectorUDT
from pyspark.sql import functions as F

from riskmart.learn import train


def test_evaluation_applies_the_model_once(spark):
    rng = random.Random(1)
    rows = [(float(i % 3 == 0), rng.random()) for i in range(200)]
    df = spark.createDataFrame(rows, "label double, p double").repartition(3)
    applied = spark.sparkContext.accumulator(0)

    def probability(p):
        applied.add(1)
        return Vectors.dense(1 - p, p)

    pred = df.withColumn("probability", F.udf(probability, VectorUDT())("p")).withColumn(
        "prediction", F.when(F.col("p") > 0.5, 1.0).otherwise(0.0))
    got = train.evaluate(pred)
    assert applied.value == len(rows)
    yes = [p for y, p in rows if y]
    no = [p for y, p in rows if not y]
    assert abs(got["auc_roc"] - sum(a > b for a in yes for b in no) / len(yes) / len(no)) < 1e-12
    assert got["accuracy"] == sum((p > 0.5) == bool(y) for y, p in rows) / len(rows)


def test_only_the_columns_of_the_classifiers_are_kept(spark, monkeypatch):
    rows = [(i, i % 2, float(i % 7), "ab"[i % 2 ^ (i % 5 == 0)]) for i in range(60)]
    df = spark.createDataFrame(rows, "customer_id long, target int, x double, c string")
    fitted = []

    def fit(prep, rows, classifier, make=train.fit_with_prep):
        fitted.append(rows.columns)
        return make(prep, rows, classifier)

    monkeypatch.setattr(train, "fit_with_prep", fit)
    monkeypatch.setattr(train, "forest", lambda trees, depth, make=train.forest: make(3, 2))
    results, test = train.train_default_models(df, ["x"], ["c"], guard_auc=1.0)
    assert fitted == [[train.FEATURES, train.LABEL, train.WEIGHT]] * 2
    assert {r.name for r in results} == {"LogisticRegression", "RandomForest"}
    test.unpersist()
