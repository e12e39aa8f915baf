"""Clickstream and virtual-tour analytics as composable Spark DataFrame operators."""
