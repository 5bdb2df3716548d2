"""Session construction and the checkpoint directory.

Library code never invents storage on a cluster: the checkpoint directory is read from the
session (``spark.checkpoint.dir`` / ``SparkContext.setCheckpointDir``).  Only a local-mode
session that has none (tests, the bench, the driver smoke check) gets a fresh scratch folder.
"""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str = "local[8]", shuffle_partitions: int = 8,
                  app_name: str = "riskmart", extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.master(master).appName(app_name)
    conf = dict(DEFAULT_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    from riskmart.functions import register_sql_functions

    register_sql_functions(spark)
    return spark


def _current_checkpoint_dir(spark: SparkSession) -> str | None:
    opt = spark.sparkContext._jsc.sc().getCheckpointDir()
    if opt.isDefined():
        return opt.get()
    conf_dir = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    return conf_dir or None


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the session's checkpoint directory.

    On a cluster it must be configured (a shared folder named by ``spark.checkpoint.dir``).
    A local-mode session without one gets its own scratch folder.
    """
    current = _current_checkpoint_dir(spark)
    if current:
        # make sure the context actually uses it (the conf alone is enough from Spark 4.0)
        if not spark.sparkContext._jsc.sc().getCheckpointDir().isDefined():
            spark.sparkContext.setCheckpointDir(current)
        return current
    # local and local[n] run everything in one process; local-cluster[...] does not
    if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
        raise RuntimeError(
            "spark.checkpoint.dir is not set; configure a shared checkpoint folder for the cluster")
    path = tempfile.mkdtemp(prefix="riskmart-ckpt-")
    spark.sparkContext.setCheckpointDir(path)
    return path


def checkpoint_table(df: DataFrame, prefix: str = "riskmart") -> DataFrame:
    """Write ``df`` as a Parquet table in the session's checkpoint folder and read it back.

    Cuts the lineage in one job (an eager ``checkpoint()`` computes the plan twice): later reads
    see fixed data even if an executor is lost and upstream stages would be recomputed.
    """
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/{prefix}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
