"""Subscriber churn analytics as Spark DataFrame operators."""
