"""Batch analytics for hospital encounter records on Spark DataFrames.

Every operator takes DataFrames and returns DataFrames; nothing runs until an
action does. The exceptions are stated where they occur: the one-row integrity
report, fitted model parameters and the bounds an ordered running sum is split at.
"""
