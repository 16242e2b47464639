"""Spark-native analytics over contract, invoice and timesheet documents."""
