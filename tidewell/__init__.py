"""Wearable-sensor analytics as Spark DataFrame jobs: Bronze, Silver, Gold and the reports over them."""
