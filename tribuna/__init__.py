"""Tribuna: a Spark-native lakehouse for paginated parliament data.

Pages of JSON become audited records, task plans, run manifests, health
summaries and Bronze / Silver / Gold tables.  Everything is a DataFrame
transformation; see README.md for the map of the package.
"""
