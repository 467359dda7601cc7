"""Retail point-of-sale analytics as plain Spark DataFrame functions."""
