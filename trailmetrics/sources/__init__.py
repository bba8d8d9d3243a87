"""Readers of the input tables, text lines and the Kafka stream."""
