"""Spark-first analytics over timed, nested annotations of long recordings."""
