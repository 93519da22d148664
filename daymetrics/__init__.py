"""Daily metrics from wearable-device records, as Spark jobs."""
