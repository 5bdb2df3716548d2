"""Sharding by Hilbert-curve order.

Several metadata dimensions are quantised to cells, a document's cells are one point, and the points are sorted by
their index on the Hilbert curve: neighbours on the curve are neighbours in every dimension, so a run of the order
covers a small box and a reader can skip files by the minima and maxima of any of the dimensions.  The order is cut
into runs of equal numbers of rows (at most one apart).

Dimensions: source and lang (rank of the value in code-point order, scaled to the cells) and size (4 cells per
doubling).  Equal points are ordered by the text's hash, so equal texts of one point lie together, then by doc_id.

Defined results: null source, lang: cell 0; null text: empty, size 16; repeated rows are rows of their own; an empty
table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskmart.llm.common import range_prefix, text_of
from riskmart.session import checkpoint_table

BITS = 8
SHARDS = 40


def hilbert_index(points: np.ndarray, bits: int) -> np.ndarray:
    """Index on the Hilbert curve of each row of ``points`` (n x dims, 0 <= value < 2**bits).

    From the highest bit down, the cell's corner is read as a Gray code, then the axes are reflected and exchanged so
    that the sub-cube has the orientation of the whole.
    """
    x = points.astype(np.int64).copy()
    dims = x.shape[1]
    for level in range(bits - 1, 0, -1):
        half = 1 << level
        low = half - 1
        for d in range(dims):
            upper = (x[:, d] & half) != 0
            swap = np.where(upper, 0, (x[:, 0] ^ x[:, d]) & low)
            x[:, 0] = np.where(upper, x[:, 0] ^ low, x[:, 0] ^ swap)
            x[:, d] ^= swap if d else 0
    for d in range(1, dims):
        x[:, d] ^= x[:, d - 1]
    flip = np.zeros(len(x), np.int64)
    for level in range(bits - 1, 0, -1):
        flip ^= np.where((x[:, dims - 1] >> level) & 1, (1 << level) - 1, 0)
    x ^= flip[:, None]
    index = np.zeros(len(x), np.int64)
    for level in range(bits - 1, -1, -1):
        for d in range(dims):
            index = (index << 1) | ((x[:, d] >> level) & 1)
    return index


def ranked(slim: DataFrame, name: str, bits: int) -> DataFrame:
    """Cell of each value of a column: its rank, scaled down where there are more values than cells."""
    values = slim.select(name).distinct()
    rank = F.dense_rank().over(Window.orderBy(name)) - 1
    n = F.count(F.lit(1)).over(Window.partitionBy())
    cell = F.when(n <= 2 ** bits, rank).otherwise(F.floor(rank * 2 ** bits / n))
    return values.select(F.col(name).alias("_value"), cell.cast("int").alias(f"{name}_cell"))


def shard(docs: DataFrame, shards: int = SHARDS, bits: int = BITS) -> DataFrame:
    """One row per document: doc_id, source, lang, size, text_crc32, curve (Hilbert index), shard, slot."""
    slim = checkpoint_table(docs.select(
        "doc_id", "source", "lang",
        (F.octet_length(text_of()) + 16).cast("long").alias("size"),
        F.crc32(text_of()).alias("text_crc32"), F.xxhash64(text_of()).alias("text_hash")), "shard")
    points = slim
    for name in ("source", "lang"):
        cells = ranked(slim, name, bits)
        points = points.join(cells, points[name].eqNullSafe(cells["_value"])).drop("_value")

    @F.pandas_udf("long")
    def curve(a: pd.Series, b: pd.Series, c: pd.Series) -> pd.Series:
        return pd.Series(hilbert_index(np.stack([a, b, c], axis=1), bits))

    size_cell = F.least(F.floor(F.log2("size") * 4), F.lit(2 ** bits - 1)).cast("int")
    points = points.withColumn("curve", curve("source_cell", "lang_cell", size_cell))
    ordered = range_prefix(points, ["curve", "text_hash", "doc_id"], None, "place")
    ordered = ordered.withColumn("n", slim.agg(F.count(F.lit(1))).scalar())
    return ordered.withColumn("shard", F.expr(f"cast(place * {shards} div n as int)")).withColumn(
        "slot", F.expr(f"place - (shard * n + {shards} - 1) div {shards}")).select(
        "doc_id", "source", "lang", "size", "text_crc32", "curve", "shard", "slot")


def write_shards(docs: DataFrame, path: str, shards: int = SHARDS, bits: int = BITS) -> None:
    """Write ``docs`` as one folder per shard, each shard's rows in slot order."""
    placed = shard(docs, shards, bits).select("doc_id", "text_crc32", "size", "shard", "slot")
    same = Window.partitionBy("doc_id", "text_crc32", "size").orderBy("shard", "slot")
    placed = placed.withColumn("nth", F.row_number().over(same))
    cols = docs.columns
    own = docs.select(F.struct(*cols).alias("row"), "doc_id", F.crc32(text_of()).alias("text_crc32"),
                      (F.octet_length(text_of()) + 16).cast("long").alias("size"))
    own = own.withColumn("nth", F.row_number().over(
        Window.partitionBy("doc_id", "text_crc32", "size").orderBy(F.lit(0))))
    on = [F.col(f"o.{c}").eqNullSafe(F.col(f"p.{c}")) for c in ("doc_id", "text_crc32", "size", "nth")]
    both = own.alias("o").join(placed.alias("p"), on).select("o.row", "p.shard", "p.slot")
    (both.repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot")
     .select("row.*", "shard", "slot").write.partitionBy("shard").parquet(path))
