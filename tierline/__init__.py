"""tierline: layered (bronze / silver / gold) table processing and data-quality
profiling expressed as Spark DataFrame plans.

Every public function takes DataFrames (plus plain parameters) and returns a
DataFrame built from built-in Spark expressions, so Catalyst can prune, push
down and fuse the work. Only plan-time facts (column names, a handful of
bounded statistics) ever reach the driver.
"""

__all__ = ["session", "sources", "functions", "operators", "plans", "streaming"]
