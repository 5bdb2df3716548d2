"""Independent DuckDB SQL for every registered query (the correctness oracle).

The SQL computes the specified results in its own way, over the driver tables through the same
fixture mapping.  It is kept separate from the Spark code on purpose: two implementations of
one specification, compared value by value.
"""

from riskmart.oracle.sql import compose, oracle_queries  # noqa: F401
