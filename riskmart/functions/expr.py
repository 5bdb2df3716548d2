"""Column-expression helpers shared by every model.

All helpers return built-in Catalyst expressions (no UDFs) on primitive types, so they stay
inside whole-stage codegen.  Two rules make results exact and engine-independent:

* ``rnd`` rounds half away from zero on the binary value scaled by ``10**n``
  (``round(x * 10**n) / 10**n``) with plain double arithmetic.  Spark's own ``round`` on a
  double builds a BigDecimal per row from the decimal string, which is slow and flips some
  last-digit halves.
* Money and rates are summed as integer units (cents, basis points) in a ``long`` (sums of
  sums in a wide decimal) and divided once at the end; a value with more digits than its
  column's unit raises an error.  So sums do not depend on the order in which partitions are
  combined, and no slow wide-decimal buffer is used.
"""

from __future__ import annotations

import datetime as _dt
import functools
import threading

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


# The numeric helpers are session-scoped SQL functions: Catalyst inlines their bodies, so they
# run inside whole-stage codegen like any built-in expression, while building a plan costs one
# call per use instead of a dozen Column operations.  Their arguments are evaluated for every
# row (in a projection below any enclosing CASE), so arguments must never raise: divide with
# rm_safe_div, never with a bare ``/`` guarded only by an outer CASE.
_SQL_FUNCTIONS = [
    # nearest integer, ties away from zero (exact for |x| < 2**52; r - 0.5 is exact)
    ("rm_round_half_away", "x DOUBLE", "DOUBLE",
     "CASE WHEN x < 0 THEN -(CASE WHEN floor(-x + 0.5D) - 0.5D > -x THEN floor(-x + 0.5D) - 1 ELSE floor(-x + 0.5D) END)"
     " ELSE (CASE WHEN floor(x + 0.5D) - 0.5D > x THEN floor(x + 0.5D) - 1 ELSE floor(x + 0.5D) END) END"),
    # round(x, n), binary-scaled, never -0.0
    ("rm_rnd", "x DOUBLE, n INT", "DOUBLE", "rm_round_half_away(x * power(10, n)) / power(10, n) + 0.0D"),
    # a decimal-grid double as integer units of 10**-s
    # a value off the grid is an error: rounding it before a sum would lose its digits
    ("rm_units", "x DOUBLE, s INT", "BIGINT",
     "CASE WHEN abs(x * power(10, s) - rm_round_half_away(x * power(10, s)))"
     " > greatest(0.001D, abs(x) * power(10, s) * 1e-12D)"
     " THEN CAST(raise_error(concat('more decimals than the ', s, ' of its column: ', x)) AS BIGINT)"
     " ELSE CAST(rm_round_half_away(x * power(10, s)) AS BIGINT) END"),
    ("rm_from_units", "u BIGINT, s INT", "DOUBLE", "CAST(u AS DOUBLE) / power(10, s)"),
    ("rm_safe_div", "a DOUBLE, b DOUBLE", "DOUBLE", "a / nullif(b, 0.0D)"),
    ("rm_pct", "a DOUBLE, b DOUBLE, n INT", "DOUBLE", "rm_rnd(rm_safe_div(a, b) * 100.0D, n)"),
]
_REGISTERED: set[str] = set()
_LOCK = threading.Lock()


def register_sql_functions(spark: SparkSession) -> None:
    """Create the helper SQL functions in ``spark`` (idempotent, once per session)."""
    key = spark._jsparkSession.sessionUUID()
    if key in _REGISTERED:
        return
    with _LOCK:
        if key in _REGISTERED:
            return
        for name, params, ret, body in _SQL_FUNCTIONS:
            spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({params}) RETURNS {ret} RETURN {body}")
        _REGISTERED.add(key)


def model(fn):
    """Decorator for model functions: registers the helper SQL functions in the session of the
    first DataFrame argument (directly or inside a dict of DataFrames)."""

    @functools.wraps(fn)
    def wrapper(*args, **kwargs):
        for a in list(args) + list(kwargs.values()):
            frames = list(a.values()) if isinstance(a, dict) else [a]
            df = next((f for f in frames if isinstance(f, DataFrame)), None)
            if df is not None:
                register_sql_functions(df.sparkSession)
                break
        return fn(*args, **kwargs)

    return wrapper


def round_half_away(x) -> Column:
    """Nearest integer (as double), ties away from zero, exact for |x| < 2**52."""
    return F.call_function("rm_round_half_away", _c(x))


def rnd(x, n: int) -> Column:
    """round(x, n) on a double, half away from zero, binary-scaled (never returns -0.0)."""
    return F.call_function("rm_rnd", _c(x), F.lit(n))


def to_units(x, scale: int = 2) -> Column:
    """A decimal-grid double as integer units of 10**-scale (e.g. cents), as BIGINT."""
    return F.call_function("rm_units", _c(x), F.lit(scale))


def units_sum(x, scale: int = 2) -> Column:
    """Exact sum in integer units (BIGINT) — combine further with ``F.sum`` and ``from_units``."""
    return F.sum(to_units(x, scale))


def from_units(units, scale: int = 2) -> Column:
    return F.call_function("rm_from_units", _c(units), F.lit(scale))


def wide_sum(units, scale: int = 2) -> Column:
    """Sum of sums in integer units, as a double: widened first, so that it cannot overflow."""
    return F.sum(_c(units).cast("decimal(38,0)")).cast("double") / F.lit(float(10 ** scale))


def flag(cond: Column) -> Column:
    """``CASE WHEN cond THEN true ELSE false END`` (a null condition gives false)."""
    return F.coalesce(cond, F.lit(False))


def sum_flag(x) -> Column:
    """``sum(cast(bool as integer))`` as BIGINT."""
    return F.sum(_c(x).cast("int")).cast("long")


def dec_sum(x, scale: int = 2) -> Column:
    """Order-independent exact sum of a double whose values carry at most ``scale`` decimals."""
    return from_units(units_sum(x, scale), scale)


def dec_avg(x, scale: int = 2) -> Column:
    """Average computed as exact decimal sum / count (null when no non-null value)."""
    c = _c(x)
    return safe_div(dec_sum(c, scale), F.count(c))


def int_avg(x) -> Column:
    """Average of an integer column as exact sum / count."""
    c = _c(x)
    return safe_div(F.sum(c), F.count(c))


def safe_div(num, den) -> Column:
    """``num / nullif(den, 0)`` in double arithmetic."""
    return F.call_function("rm_safe_div", _c(num), _c(den))


def pct(num, den, n: int) -> Column:
    """``round(num / nullif(den, 0) * 100, n)``."""
    return F.call_function("rm_pct", _c(num), _c(den), F.lit(n))


def lit_date(d) -> Column:
    """A DATE literal from a ``date``, an ISO string or an existing column."""
    if d is None:
        return F.current_date()
    if isinstance(d, Column):
        return d
    if isinstance(d, _dt.datetime):
        d = d.date()
    if isinstance(d, str):
        d = _dt.date.fromisoformat(d)
    return F.lit(d)
