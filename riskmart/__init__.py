"""riskmart — a Spark-native consumer credit-risk analytics pipeline.

Layers (each a set of pure ``DataFrame -> DataFrame`` functions):

* ``riskmart.sources``   — native input schemas, Parquet readers, source checks and the
  mapping of the driver's TPC-H-like test tables onto the six credit tables.
* ``riskmart.plans``     — staging views, intermediate tables, marts, report queries and
  ML feature tables.
* ``riskmart.operators`` — distributed global ranking (``ntile`` / ``percent_rank`` without a
  single-partition window) and the declarative data-quality runner.
* ``riskmart.functions`` — column-expression helpers (rounding, safe ratios, exact sums).
* ``riskmart.learn``     — ``pyspark.ml`` training, evaluation and batch scoring.
* ``riskmart.pipeline``  — the layered, quality-gated batch run and its writers.
"""

__version__ = "0.1.0"
