"""Distributed global ranking: ``row_number``, ``ntile`` and ``percent_rank`` over a total order.

``Window.orderBy(...)`` without ``partitionBy`` moves every row into one task.  Here instead:

* ``dist_row_number`` range-sorts the rows (AQE sizes the ranges), writes them to the checkpoint folder, so that the
  sampled bounds are fixed, and gives each partition its offset from a table with one row per partition.
* ``percent_rank`` is taken inside the ranges.  A value that many rows share is spread by a second key; a table with one
  row per range tells where the value that a range begins with started.
* ``ntile`` needs only the last row of each tile, which selection finds without a sort; then every row finds its tile by
  comparing itself with the k - 1 last rows.

Values order as in Spark: NaN is larger than any number, nulls come last in either direction.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskmart.operators.selection import select_places
from riskmart.session import checkpoint_table, ensure_checkpoint_dir

_LOCAL_BITS = (1 << 33) - 1  # monotonically_increasing_id = (partition << 33) + local index


def range_sorted(df: DataFrame, order: Sequence[Column]) -> DataFrame:
    """The globally sorted rows as a table, with ``_pid`` (range) and ``_lrn`` (place in it, from 0)."""
    ensure_checkpoint_dir(df.sparkSession)
    gid = F.monotonically_increasing_id()
    s = df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_gid", gid)
    s = s.withColumns({"_pid": F.shiftright("_gid", 33), "_lrn": F.col("_gid").bitwiseAND(F.lit(_LOCAL_BITS))})
    return checkpoint_table(s.drop("_gid"), "riskmart-rank")


def _offsets(ranked: DataFrame, size: Column) -> DataFrame:
    """One row per range: ``_pid``, ``_off`` (total size of the ranges before it), ``_n`` (total size)."""
    s = ranked.groupBy("_pid").agg(F.sum(size).alias("_cnt"))
    before = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    return s.select("_pid", F.coalesce(F.sum("_cnt").over(before), F.lit(0)).cast("long").alias("_off"),
                    F.sum("_cnt").over(Window.partitionBy()).cast("long").alias("_n"))


def dist_row_number(df: DataFrame, order: Sequence[Column]) -> DataFrame:
    """Adds ``_rn`` (1-based position in ``order``) and ``_n`` (row count).

    ``order`` must be a total order (end it with a unique key).
    """
    ranked = range_sorted(df, order)
    return (ranked.join(_offsets(ranked, F.lit(1)), "_pid")
            .withColumn("_rn", F.col("_off") + F.col("_lrn") + 1)
            .drop("_pid", "_lrn", "_off"))


def dist_percent_rank(df: DataFrame, value_col: str, out_col: str, ascending: bool = True,
                      id_col: str | None = None) -> DataFrame:
    """``percent_rank() OVER (ORDER BY value_col)`` with nulls last, as ``out_col`` (double).

    A value that many rows share is spread over ranges by ``id_col`` (default: a hash of the row).
    """
    v = F.col(value_col)
    by_value = v.asc_nulls_last() if ascending else v.desc_nulls_last()
    second = F.col(id_col) if id_col else F.xxhash64(*df.columns)
    ranked = range_sorted(df.withColumn("_second", second), [by_value, F.col("_second").asc()]).drop("_second")
    # place in its range, from 0, of the first row with this value
    ranked = ranked.withColumn("_start", F.rank().over(Window.partitionBy("_pid").orderBy(by_value)) - 1)
    ranges = ranked.groupBy("_pid").agg(
        F.count(F.lit(1)).alias("_cnt"), F.min_by(value_col, "_lrn").alias("_first"),
        F.max_by(value_col, "_lrn").alias("_last"), F.max("_start").alias("_last_start"))
    # one row per range from here on
    w = Window.orderBy("_pid")
    before = w.rowsBetween(Window.unboundedPreceding, -1)
    ranges = ranges.select(
        "_pid", "_first", "_last", "_last_start",
        F.coalesce(F.sum("_cnt").over(before), F.lit(0)).cast("long").alias("_off"),
        F.sum("_cnt").over(Window.partitionBy()).cast("long").alias("_n"),
        (F.lag(F.lit(1)).over(w).isNotNull() & F.col("_first").eqNullSafe(F.lag("_last").over(w))).alias("_goes_on"))
    # first row of the value that a range ends with; unknown where the range is only a part of it
    ends_with = (F.when(~F.col("_first").eqNullSafe(F.col("_last")), F.col("_off") + F.col("_last_start"))
                 .when(~F.col("_goes_on"), F.col("_off")))
    ranges = ranges.withColumn("_ends_with", ends_with)
    begins_with = F.when(F.col("_goes_on"), F.last("_ends_with", ignorenulls=True).over(before)).otherwise(F.col("_off"))
    ranges = ranges.select("_pid", "_off", "_n", begins_with.alias("_begins_with"))
    smaller = F.when(F.col("_start") == 0, F.col("_begins_with")).otherwise(F.col("_off") + F.col("_start"))
    rank = F.when(F.col("_n") > 1, smaller.cast("double") / (F.col("_n") - 1).cast("double")).otherwise(0.0)
    return ranked.join(ranges, "_pid").withColumn(out_col, rank).select(*df.columns, out_col)


def tile_ends(n: int, k: int) -> list[int]:
    """1-based number of the last row of each tile but the last: the first n % k tiles have one row more."""
    b, r = divmod(n, k)
    return [t * b + min(t, r) for t in range(1, k)]


def dist_ntile(df: DataFrame, k: int, value_col: str, id_col: str, ascending: bool = True) -> Column:
    """``ntile(k) OVER (ORDER BY value_col, id_col)``, nulls last, as an expression over the rows of ``df``.

    ``id_col`` must be unique.  The k - 1 last rows of the tiles are found by selection (no sort of the table); only they
    reach the driver.
    """
    v, i = F.col(value_col), F.col(id_col)
    ends = tile_ends(df.count(), k)
    last = select_places(df, ends, value_col, id_col, ascending)
    kinds = df.select(value_col, id_col).schema
    tile = F.lit(1)
    for e in ends:
        if e not in last:  # a table of fewer rows than tiles
            continue
        r = last[e]
        at, key = (F.lit(r[c]).cast(kinds[c].dataType) for c in (value_col, id_col))
        if r[value_col] is None:
            behind = v.isNull() & (i > key)
        else:
            beyond = (v > at) if ascending else (v < at)
            behind = v.isNull() | beyond | ((v == at) & (i > key))
        tile = tile + F.when(behind, 1).otherwise(0)
    return tile.cast("int")
