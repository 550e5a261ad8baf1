"""civicstream: city-telemetry stream analytics expressed as Spark DataFrame jobs.

Every operator is a function from DataFrame(s) to a DataFrame. The same function runs
on a batch DataFrame and (where Spark allows) on a Structured Streaming DataFrame.
"""

__version__ = "0.1.0"
