"""Layered (bronze, silver, gold) analytics over indicator and trade data, on Spark.

Transforms are plain ``DataFrame -> DataFrame`` functions built from Spark's own
expressions.  Only the ``sinks`` package runs jobs.
"""
