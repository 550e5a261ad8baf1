"""Sinks: keyed JSON message streams (Kafka or envelope files) and Parquet archives."""
