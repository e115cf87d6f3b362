"""Spark-native revenue ingestion engine.

Every operator is a plain function from DataFrame(s) to DataFrame built on
native Spark expressions, so Catalyst can prune, push down and pipeline it.
"""

__version__ = "0.1.0"
