"""Spending analytics on PySpark: weekly and monthly features, forecasts, anomalies."""
