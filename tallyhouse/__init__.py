"""Retail sales lakehouse on PySpark: raw files to a star schema and named metrics.

Layers are plain functions from DataFrames to DataFrames; Catalyst picks the
physical plan. See README.md for the map of the package.
"""
