"""Clickstream analytics as plain DataFrame-to-DataFrame functions on PySpark."""
