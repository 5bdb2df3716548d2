"""Exact selection: the rows at given places of a total order, without sorting the table.

A place is bracketed by two keys out of a bottom-k sample (the ``SAMPLE`` rows with the smallest hash; samples of
partitions merge into the sample of the whole, so this is one top-k pass).  One aggregate counts the rows below and inside
every bracket.  While a bracket holds more than ``LIMIT`` rows, the next round samples inside it; each round leaves about
4 / sqrt(SAMPLE) of the rows, so 10^10 rows take four.  What is left is bounded and sorted in one array.

The sample decides only how fast this goes: counts are exact, and a place outside of its bracket (a matter of chance)
lies in the part below or above it, where the search goes on.

Rows are ordered by value (ascending or descending, null last, NaN larger than any number), then by id ascending.  Rows that
are equal in both are interchangeable.
"""

from __future__ import annotations

import math
from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T

SAMPLE = 20_000
LIMIT = 20_000


def order_key(df: DataFrame, value_col: str, id_col: str, ascending: bool = True) -> Column:
    """A struct that rises in the order: null flag, value (its negative, if descending, NaN first), id."""
    v, kind = F.col(value_col), df.schema[value_col].dataType
    null = F.when(v.isNull(), 1).otherwise(0)
    if ascending:
        return F.struct(null.alias("n"), v.alias("v"), F.col(id_col).alias("i"))
    if isinstance(kind, (T.FloatType, T.DoubleType)):
        ahead = F.when(F.isnan(v), 0).otherwise(1)
        return F.struct((null * 2 + ahead).alias("n"), (-v).alias("v"), F.col(id_col).alias("i"))
    if isinstance(kind, T.IntegralType):
        return F.struct(null.alias("n"), (-v.cast("decimal(20,0)")).alias("v"), F.col(id_col).alias("i"))
    if isinstance(kind, T.DecimalType):
        return F.struct(null.alias("n"), (-v).alias("v"), F.col(id_col).alias("i"))
    raise TypeError(f"descending order of {kind.simpleString()} values is not supported")


@dataclass
class Bracket:
    """Rows with low < key < high; ``below`` rows are at ``low`` or smaller, ``size`` rows are inside."""

    low: Row | None
    high: Row | None
    below: int
    size: int

    def holds(self, kind: T.StructType) -> Column:
        """Condition on the column ``_key``."""
        key, out = F.col("_key"), F.lit(True)
        if self.low is not None:
            out = key > literal(self.low, kind)
        if self.high is not None:
            out = out & (key < literal(self.high, kind))
        return out


def literal(key: Row, kind: T.StructType) -> Column:
    return F.struct(*[F.lit(x).cast(f.dataType).alias(f.name) for x, f in zip(key, kind)])


def _sampled(inside: DataFrame, sample: int) -> list[Row]:
    """Keys of the rows with the smallest hashes, in the order of the keys."""
    some = inside.select("_key", F.xxhash64("_key").alias("_h")).orderBy("_h").limit(sample)
    return some.agg(F.sort_array(F.collect_list("_key")).alias("keys")).first()["keys"]


def _around(bracket: Bracket, place: int, keys: list[Row]) -> tuple[Row | None, Row | None]:
    """The sample's keys four standard deviations below and above ``place``."""
    at = (place - bracket.below) / bracket.size * len(keys)
    d = 2 * math.sqrt(len(keys)) + 1  # the deviation is half the root at most
    low, high = math.floor(at - d), math.ceil(at + d)
    return keys[low] if low >= 0 else None, keys[high] if high < len(keys) else None


def select_places(df: DataFrame, places: Iterable[int], value_col: str, id_col: str, ascending: bool = True,
                  sample: int = SAMPLE, limit: int = LIMIT) -> dict[int, Row]:
    """The rows (value, id) at 1-based ``places``; places outside of the table are left out."""
    rows = df.select(order_key(df, value_col, id_col, ascending).alias("_key"))
    kind = rows.schema["_key"].dataType
    n = rows.count()
    whole = Bracket(None, None, 0, n)
    open_places = {p: whole for p in sorted(set(places)) if 1 <= p <= n}
    found: dict[int, Row] = {}
    while any(b.size > limit for b in open_places.values()):
        samples: dict[int, list[Row]] = {}
        cuts = {}
        for p, b in open_places.items():
            if b.size > limit:
                if id(b) not in samples:
                    samples[id(b)] = _sampled(rows.where(b.holds(kind)), sample)
                cuts[p] = _around(b, p, samples[id(b)])
        bounds = {k for low, high in cuts.values() for k in (low, high) if k is not None}
        counts = _count_at(rows, sorted(bounds, key=repr), kind)
        for p, (low, high) in cuts.items():
            b = open_places[p]
            hit = next((k for k in (low, high) if k is not None and counts[k][0] < p <= counts[k][1]), None)
            if hit is not None:
                found[p] = hit
                continue
            # neither key is at the place, so every round leaves the rows of a key behind
            known = [(k, *counts[k]) for k in (low, high) if k is not None]
            under = max(((upto, k) for k, _, upto in known if upto < p), default=None, key=lambda x: x[0])
            over = min(((below, k) for k, below, _ in known if below >= p), default=None, key=lambda x: x[0])
            below, end = under[0] if under else b.below, over[0] if over else b.below + b.size
            part = Bracket(under[1] if under else b.low, over[1] if over else b.high, below, end - below)
            # places with one bracket share the next sample
            open_places[p] = next((x for x in open_places.values() if x == part), part)
        open_places = {p: b for p, b in open_places.items() if p not in found}
    found |= _inside(rows, open_places, kind)
    back = Row(value_col, id_col)
    return {p: back(_value(key, ascending, df.schema[value_col].dataType), key["i"]) for p, key in found.items()}


def _count_at(rows: DataFrame, bounds: list[Row], kind: T.StructType) -> dict[Row, tuple[int, int]]:
    """For each key the number of rows below it, and up to it, in one pass."""
    aggs = []
    for i, key in enumerate(bounds):
        aggs += [F.count_if(F.col("_key") < literal(key, kind)).alias(f"b{i}"),
                 F.count_if(F.col("_key") <= literal(key, kind)).alias(f"e{i}")]
    got = rows.agg(*aggs).first() if aggs else {}
    return {key: (got[f"b{i}"], got[f"e{i}"]) for i, key in enumerate(bounds)}


def _inside(rows: DataFrame, places: dict[int, Bracket], kind: T.StructType) -> dict[int, Row]:
    """The keys at ``places``, whose brackets are small: each bracket's rows are sorted in one array, in one pass."""
    if not places:
        return {}
    brackets: list[Bracket] = []
    for b in places.values():
        if b not in brackets:
            brackets.append(b)
    some = F.lit(False)
    for b in brackets:
        some = some | b.holds(kind)
    arrays = [F.sort_array(F.collect_list(F.when(b.holds(kind), F.col("_key")))).alias(f"a{i}")
              for i, b in enumerate(brackets)]
    got = rows.where(some).agg(*arrays).select(*[
        F.col(f"a{brackets.index(b)}")[p - b.below - 1].alias(f"p{p}") for p, b in places.items()]).first()
    return {p: got[f"p{p}"] for p in places}


def _value(key: Row, ascending: bool, kind: T.DataType):
    v = key["v"]
    if v is None or ascending:
        return v
    if isinstance(kind, T.IntegralType):
        return -int(v)
    return -v
