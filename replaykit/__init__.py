"""Daily-delivery slicing, raw loading, replay ledgers and reconciliation on Spark.

Everything here takes DataFrames and returns DataFrames.  Only the sinks in
``sources.tables`` and the jobs in ``plans`` run actions.
"""
