"""Trip analytics on Spark: layered tables, quality logs and aggregates as plain DataFrame functions."""
