"""Readers for the native bronze tables and the source presence / size check."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from riskmart.sources.schemas import SOURCE_TABLES, column_names, wrong_types


class MissingSourceError(RuntimeError):
    pass


class WrongSourceError(RuntimeError):
    pass


def source_path(src_dir: str, table: str) -> str:
    return f"{src_dir.rstrip('/')}/{table}.parquet"


def read_sources(spark: SparkSession, src_dir: str, tables=SOURCE_TABLES) -> dict[str, DataFrame]:
    """Lazily scan each native table (only the contract columns; staging casts the types).

    Column pruning and filters of downstream models reach these scans through Catalyst.  A file
    that does not fit the declared types is refused here rather than cast to nulls later.
    """
    frames = {t: spark.read.parquet(source_path(src_dir, t)) for t in tables}
    wrong = {t: bad for t, df in frames.items() if (bad := wrong_types(t, df.schema))}
    if wrong:
        raise WrongSourceError(f"source tables under {src_dir} do not fit the contract: {wrong}")
    return {t: df.select(*column_names(t)) for t, df in frames.items()}


def validate_sources(spark: SparkSession, src_dir: str, tables=SOURCE_TABLES) -> DataFrame:
    """One row per source table: table, path, bytes.  Raises listing every missing table.

    Only file-system metadata is read (Hadoop FileSystem API), no data and no Spark job.
    """
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    rows, missing = [], []
    for t in tables:
        path = jvm.org.apache.hadoop.fs.Path(source_path(src_dir, t))
        fs = path.getFileSystem(conf)
        if not fs.exists(path):
            missing.append(t)
            continue
        rows.append((t, path.toString(), int(fs.getContentSummary(path).getLength())))
    if missing:
        raise MissingSourceError(f"source tables missing under {src_dir}: {missing}")
    return spark.createDataFrame(rows, "table_name string, file_path string, file_size long")
