"""Operators Spark lacks as one call: distributed global ranking and the data-quality runner."""
