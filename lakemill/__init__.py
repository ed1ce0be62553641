"""lakemill: lakehouse data jobs written as plain Spark DataFrame functions."""
