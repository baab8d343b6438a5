"""Operators for preparing large text corpora, each one a Spark job.

Nothing else in the library imports this subpackage.
"""
