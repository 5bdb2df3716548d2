"""Model plans: staging views, intermediate tables, marts, reports, summaries and ML features.

Every model is a pure ``DataFrame(s) -> DataFrame`` function; ``riskmart.pipeline`` composes
and writes them.
"""
