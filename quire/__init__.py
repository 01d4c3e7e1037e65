"""Bibliographic metadata analytics on PySpark."""
