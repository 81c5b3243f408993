"""Trip-record analytics as plain Spark DataFrame functions."""
