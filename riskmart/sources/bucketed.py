"""Source tables laid out by customer, so that per-customer models read them without a shuffle.

``write_bucketed`` writes every table that has a ``customer_id`` into hash buckets of it, sorted inside; ``read_bucketed``
gives the tables back as sources of ``pipeline.run`` and ``build_staging``.  Staging views are projections, so the
buckets reach the models: the credit profile, the acquisition model, the risk segments and the features aggregate and join
payments, contracts and customers by ``customer_id`` where they lie.  The layout pays when it is written once, at
ingestion, and read by many models and runs.

A bucket is read by one task, so a table is laid out this way only if no bucket holds more than ``SKEW`` times the mean;
a table with a hot customer keeps the plain layout, where the models' partial aggregation spreads that customer's rows
over all tasks.  This is measured from all rows, by one count per bucket, before the table is written.  An empty table and
one without the column are plain, too.  Rows without a customer are kept; they share a bucket.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskmart.sources.readers import WrongSourceError
from riskmart.sources.schemas import column_names, wrong_types

KEY = "customer_id"
#: Most rows of a bucket, in means of the table's buckets.
SKEW = 4


def largest_share(df: DataFrame, buckets: int) -> float:
    """Rows of the largest bucket over the mean; 0 for an empty table."""
    sizes = df.groupBy(F.pmod(F.hash(KEY), F.lit(buckets)).alias("bucket")).agg(F.count(F.lit(1)).alias("n"))
    most, total = sizes.agg(F.max("n"), F.sum("n")).first()  # from one row per bucket
    return most * buckets / total if total else 0.0


def _table_name(path: str) -> str:
    return "riskmart_" + hashlib.sha256(path.encode()).hexdigest()[:24]


def write_bucketed(spark: SparkSession, sources: dict[str, DataFrame], root: str, buckets: int) -> dict[str, int]:
    """Write ``sources`` below the new folder ``root``; the number of buckets of each table, 0 for a plain one."""
    root, layout = root.rstrip("/"), {}
    for name, df in sources.items():
        path = f"{root}/{name}"
        share = largest_share(df, buckets) if KEY in df.columns else 0.0
        layout[name] = buckets if 0 < share <= SKEW else 0
        if layout[name]:
            table = _table_name(path)
            spark.sql(f"DROP TABLE IF EXISTS {table}")
            # one exchange by the buckets' own hash: one file per bucket
            df.repartition(buckets, KEY).write.bucketBy(buckets, KEY).sortBy(KEY).option("path", path).saveAsTable(table)
            spark.sql(f"DROP TABLE {table}")  # an external table: the files stay
        else:
            df.write.parquet(path)
    rows = [(name, n) for name, n in layout.items()]
    spark.createDataFrame(rows, "table_name string, buckets int").coalesce(1).write.parquet(f"{root}/layout")
    return layout


def read_bucketed(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    """The tables that ``write_bucketed`` left below ``root``, in this or another session."""
    root, out = root.rstrip("/"), {}
    for row in spark.read.parquet(f"{root}/layout").collect():  # one row per source table
        name, path = row["table_name"], f"{root}/{row['table_name']}"
        plain = spark.read.parquet(path)
        wrong = wrong_types(name, plain.schema)
        if wrong:
            raise WrongSourceError(f"source table {path} does not fit the contract: {wrong}")
        if row["buckets"]:
            table = _table_name(path)
            columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in plain.schema)
            where = path.replace("\\", "\\\\").replace("'", "\\'")
            spark.sql(f"DROP TABLE IF EXISTS {table}")
            spark.sql(f"CREATE TABLE {table} ({columns}) USING parquet CLUSTERED BY ({KEY}) SORTED BY ({KEY}) "
                      f"INTO {row['buckets']} BUCKETS LOCATION '{where}'")
            plain = spark.table(table)
        out[name] = plain.select(*column_names(name))
    return out
