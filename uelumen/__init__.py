"""Subscriber event-sequence analytics on PySpark."""
