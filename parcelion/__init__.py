"""Property-sale analytics expressed as Spark DataFrame functions."""
