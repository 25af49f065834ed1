"""Batch data-analysis jobs for PySpark: generate, prepare, analyse, report."""
