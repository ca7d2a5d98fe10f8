"""Retail analytics on Spark: JSON feeds -> clean daily tables -> star schema -> reports."""

__version__ = "0.1.0"
