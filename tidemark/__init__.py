"""Versioned sales warehouse on Spark DataFrames.

``operators`` are pure ``DataFrame -> DataFrame`` functions; ``sources`` read sheets and keep tables;
``plans`` put both together into uploads, refreshes, the mart and the full run.
"""
