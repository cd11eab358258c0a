"""agrolens — Spark-native analytics over purchase-subsidy records.

Every operator takes a DataFrame (plus column-name parameters) and returns a
DataFrame, lazily; Catalyst and AQE choose the physical plan.
"""

__all__ = ["session", "schema", "records"]
