"""Spark-native market, trial and safety analytics.

Every operator is a function ``DataFrame (+ parameters) -> DataFrame`` (or
``Column -> Column``); nothing here runs a job unless its docstring says so.
"""
