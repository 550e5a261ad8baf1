"""Sources: JSON-lines files, topic envelopes (Kafka or files), static lookups, catalog."""
