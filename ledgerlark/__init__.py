"""Retail sales-line analytics written as Spark DataFrame plans."""
