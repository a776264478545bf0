"""Short-stay revenue analytics as plain Spark DataFrame functions."""
