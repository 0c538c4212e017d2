"""plumbline: evidence reconciliation and point-in-time benchmarking on Spark.

Every public operator takes DataFrames and returns a DataFrame. Most run nothing
until the caller acts on the result; the README lists those that write stages,
count groups or read their configuration while the plan is built.
"""
