"""Reconciliation of yearly land-use declarations as Spark DataFrame jobs."""
