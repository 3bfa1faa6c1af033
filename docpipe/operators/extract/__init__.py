"""Bytes to text: one small reader per format and the Spark job around them."""
