"""SRC-6: the topic catalog (name, partitions, retention, key field)."""

from civicstream.operators.ops import topic_catalog  # noqa: F401
