"""Helpers shared by the training-data operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from riskmart.session import checkpoint_table

#: The six characters that separate words.
BLANKS = " \t\n\x0b\x0c\r"
BLANK_RUN = r"[\x20\x09-\x0D]+"
#: Words of 64 bits of a bitmap of ids.
BITMAP = 1 << 18


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_of(col: str = "text") -> Column:
    """The text, a null as the empty string."""
    return F.coalesce(F.col(col), F.lit(""))


def words(text: Column) -> Column:
    """Array of maximal runs of non-blank characters; empty for a text without any."""
    bare = F.btrim(text, F.lit(BLANKS))
    return F.when(bare == "", F.array().cast("array<string>")).otherwise(F.split(bare, BLANK_RUN))


def id_text(col: str = "doc_id") -> Column:
    """An id as text, for the way through pandas, where whole numbers beside nulls would become floats."""
    return F.col(col).cast("string").alias(col)


def id_back(df: DataFrame, like: DataFrame, col: str = "doc_id") -> DataFrame:
    """``df`` with ``col`` in the type that it has in ``like``."""
    return df.withColumn(col, F.col(col).cast(like.schema[col].dataType))


def range_prefix(df: DataFrame, order: list[str], value: str | None = None, before: str = "_before",
                 row: str | None = None) -> DataFrame:
    """Globally range-sort ``df`` and add ``before``: the sum of ``value`` (rows, if None) in all earlier rows; and
    ``row``, if named: a number of each row that is stored with it.

    The sorted rows are written to the shared checkpoint folder, so that the partition borders stay fixed; then each
    partition's total is summed over the partitions before it (a table with one row per partition), and the running
    total is taken inside each partition.  No task sees more than one range.
    """
    amount = F.lit(1).cast("long") if value is None else F.col(value)
    fixed = checkpoint_table(
        df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_gid", F.monotonically_increasing_id()),
        "range")
    fixed = fixed.withColumn("_pid", F.shiftright("_gid", 33))
    totals = fixed.groupBy("_pid").agg(F.sum(amount).alias("_total"))
    base = totals.select(
        F.col("_pid"),
        F.coalesce(F.sum("_total").over(Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)),
                   F.lit(0)).alias("_base"))
    inside = F.coalesce(F.sum(amount).over(
        Window.partitionBy("_pid").orderBy("_gid").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return (fixed.withColumn("_inside", inside).join(base, "_pid")
            .withColumn(before, (F.col("_base") + F.col("_inside")).cast("long"))
            .withColumnRenamed("_gid", row or "_gid").drop("_pid", "_gid", "_base", "_inside"))


def _place(key: Column, size: int) -> tuple[Column, Column]:
    """(word, bit) of an id in a bitmap of ``size`` words."""
    h = F.xxhash64(key.cast("string"))
    return F.pmod(h, F.lit(size)).cast("int"), F.shiftrightunsigned(h, 58).cast("int")


def bitmap(ids: DataFrame, size: int = BITMAP) -> DataFrame:
    """One row, ``_bits``: ``size`` words of 64 bits, with a bit for the hash of each id."""
    word, bit = _place(F.col("_id"), size)
    found = ids.select(word.alias("at"), bit.alias("bit")).groupBy("at").agg(
        F.bit_or(F.expr("shiftleft(1L, bit)")).alias("bits"))
    every = ids.sparkSession.range(size).select(F.col("id").cast("int").alias("at")).join(found, "at", "left")
    return every.agg(F.sort_array(F.collect_list(F.struct(
        "at", F.coalesce("bits", F.lit(0).cast("long")).alias("bits"))))["bits"].alias("_bits"))


def in_bitmap(key: Column, size: int = BITMAP) -> Column:
    """Whether ``_bits`` has the bit of an id."""
    word, bit = _place(key, size)
    return F.get("_bits", word).bitwiseAND(F.call_function("shiftleft", F.lit(1).cast("long"), bit)) != 0
