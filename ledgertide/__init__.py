"""Spark-native analytics over lending-protocol ledger data.

The package is a set of DataFrame-to-DataFrame functions.  Nothing in it runs a
job unless its name says so (``upsert``, ``run_*``): callers compose frames and
Catalyst plans the whole thing.
"""
