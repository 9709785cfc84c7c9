"""Medallion analytics for repair-service data, written as plain Spark DataFrame code."""
