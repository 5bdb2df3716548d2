"""Metrics as relational queries: exact AUC by rank sums, confusion counts, and the scaler's statistics.

The AUC of a score is the Mann-Whitney statistic: over all positive rows the negative rows with a smaller score, ties as
half, divided by the number of pairs.  Rows are first counted per distinct value (partial aggregation takes care of hot
values); the distinct values are range-sorted, and the negatives below each come from sums inside a range plus a table
with one row per range.  All features go through one pass; the sums are whole numbers, so the result is exact.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskmart.operators.ranking import range_sorted


def _share(a: Column, b: Column) -> Column:
    return F.coalesce(a.cast("double") / F.nullif(b, F.lit(0)).cast("double"), F.lit(0.0))


def feature_metrics(df: DataFrame, features: Sequence[str], label_col: str, threshold: float = 0.0) -> DataFrame:
    """For each feature used as a score: positives, negatives, auc (null without both classes), and the confusion counts,
    precision, recall and F1 of the prediction ``feature > threshold``.  A null value counts as the smallest score."""
    pairs = F.explode(F.array(*[F.struct(F.lit(f).alias("feature"), F.col(f).cast("double").alias("value"))
                                for f in features]))
    rows = df.select((F.col(label_col) == 1).cast("int").alias("y"), pairs.alias("p")).select("y", "p.feature", "p.value")
    counts = rows.groupBy("feature", "value").agg(F.sum("y").alias("pos"), F.sum(1 - F.col("y")).alias("neg"))
    ranked = range_sorted(counts, [F.col("feature").asc(), F.col("value").asc_nulls_first()])
    before = Window.partitionBy("_pid").orderBy("_lrn").rowsBetween(Window.unboundedPreceding, -1)
    ranked = ranked.withColumn("inside", F.coalesce(F.sum("neg").over(before), F.lit(0)))
    # one row per range
    ranges = ranked.groupBy("_pid").agg(F.sum("neg").alias("all"))
    earlier = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    ranges = ranges.select("_pid", F.coalesce(F.sum("all").over(earlier), F.lit(0)).alias("off"))
    wide = "decimal(38,0)"
    below = ranked.join(ranges, "_pid").withColumn("below", F.col("off") + F.col("inside"))
    said = F.coalesce(F.col("value") > threshold, F.lit(False))
    total = below.groupBy("feature").agg(
        F.sum("pos").alias("positives"), F.sum("neg").alias("negatives"), F.min("below").alias("base"),
        F.sum(F.col("pos").cast("decimal(18,0)") * (2 * F.col("below") + F.col("neg")).cast("decimal(20,0)")).alias("twice"),
        F.sum(F.when(said, F.col("pos")).otherwise(0)).alias("tp"),
        F.sum(F.when(said, F.col("neg")).otherwise(0)).alias("fp"))
    # ``below`` runs on through the features: those before a feature are taken off
    pairs2 = 2 * F.col("positives").cast("decimal(18,0)") * F.col("negatives").cast("decimal(18,0)")
    own = F.col("twice").cast(wide) - 2 * F.col("positives").cast("decimal(18,0)") * F.col("base").cast("decimal(18,0)")
    total = total.withColumn("auc", F.when(pairs2 > 0, own.cast("double") / pairs2.cast("double")))
    total = total.withColumns({"fn": F.col("positives") - F.col("tp"), "tn": F.col("negatives") - F.col("fp")})
    precision, recall = _share(F.col("tp"), F.col("tp") + F.col("fp")), _share(F.col("tp"), F.col("positives"))
    f1 = _share(2 * F.col("tp"), 2 * F.col("tp") + F.col("fp") + F.col("fn"))
    return total.select("feature", "positives", "negatives", "auc", "tp", "fp", "fn", "tn",
                        precision.alias("precision"), recall.alias("recall"), f1.alias("f1_score"))


def scaler_statistics(train: DataFrame, features: Sequence[str], digits: int = 6) -> DataFrame:
    """feature, mean, std (of a sample) of the training rows, in one pass over vectors: what the scaler subtracts and
    divides by.  Rounded, because sums of doubles depend on their order."""
    vectors = VectorAssembler(inputCols=list(features), outputCol="v", handleInvalid="keep").transform(
        train.select(*[F.col(f).cast("double").alias(f) for f in features]))
    stats = vectors.select(Summarizer.metrics("mean", "std").summary(F.col("v")).alias("s"))
    arrays = stats.select(vector_to_array("s.mean").alias("mean"), vector_to_array("s.std").alias("std"))
    names = F.array(*[F.lit(f) for f in features])
    rows = arrays.select(F.explode(F.arrays_zip(names.alias("feature"), "mean", "std")).alias("r"))
    return rows.select(F.col("r.feature").alias("feature"), F.round("r.mean", digits).alias("mean"),
                       F.round("r.std", digits).alias("std"))
