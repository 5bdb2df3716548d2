"""Rank-sum AUC, confusion counts and scaler statistics against plain Python; version numbers of concurrent jobs."""

import random
import statistics
import tempfile
from concurrent.futures import ThreadPoolExecutor

import pytest

from riskmart.learn import metrics, train


def test_feature_metrics_equal_all_pairs(spark):
    r = random.Random(2)
    rows = [(i, r.random() < 0.3, float(r.randrange(5)) if i % 2 else 3.0, None if i % 7 == 0 else r.random() - 0.5, 1.0)
            for i in range(300)]
    df = spark.createDataFrame([(i, int(y), a, b, c) for i, y, a, b, c in rows],
                               "id long, y int, a double, b double, c double").repartition(5)
    got = {m["feature"]: m for m in metrics.feature_metrics(df, ["b", "a", "c"], "y").collect()}
    for n, name in enumerate("abc"):
        value = lambda row: -9.0 if row[2 + n] is None else row[2 + n]  # noqa: E731, B023
        pos, neg = ([value(x) for x in rows if x[1] == y] for y in (True, False))
        auc = sum((p > q) + (p == q) / 2 for p in pos for q in neg) / (len(pos) * len(neg))
        m = got[name]
        assert m["auc"] == pytest.approx(auc, abs=1e-15) and (m["positives"], m["negatives"]) == (len(pos), len(neg))
        tp, fp = sum(p > 0 for p in pos), sum(q > 0 for q in neg)
        assert (m["tp"], m["fp"], m["fn"], m["tn"]) == (tp, fp, len(pos) - tp, len(neg) - fp)
        assert m["f1_score"] == pytest.approx(2 * tp / (2 * tp + fp + len(pos) - tp))
    assert got["c"]["auc"] == 0.5
    one = metrics.feature_metrics(df.where("y = 1"), ["a"], "y").first()
    assert one["auc"] is None and one["recall"] > 0
    assert metrics.feature_metrics(df.where("false"), ["a"], "y").count() == 0


def test_scaler_statistics(spark):
    values = [(float(i * i % 17), float(i) / 8) for i in range(200)]
    got = {m["feature"]: m for m in metrics.scaler_statistics(spark.createDataFrame(values, "p double, q double"),
                                                             ["p", "q"]).collect()}
    for n, f in enumerate("pq"):
        own = [v[n] for v in values]
        assert got[f]["mean"] == round(statistics.fmean(own), 6) and got[f]["std"] == round(statistics.stdev(own), 6)


def test_concurrent_jobs_get_different_versions(spark):
    path = tempfile.mkdtemp(prefix="riskmart-versions-") + "/ml_model_versions"
    with ThreadPoolExecutor(4) as pool:
        got = list(pool.map(lambda i: train.register_version(spark, path, "m", f"/m/{i}", str(i)), range(4)))
    assert sorted(got) == [1, 2, 3, 4]
    assert sorted(r["version"] for r in spark.read.parquet(path).collect()) == [1, 2, 3, 4]
    assert train.register_version(spark, path, "other", "/o", "x") == 1
