"""Spark-native clean-up, reconciliation and reporting of tabular feeds.

Everything here is DataFrame in, DataFrame out: functions build Columns, operators
transform frames, plans compose them, and actions happen only in sinks and runs.
"""
