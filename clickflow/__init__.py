"""clickflow -- event-stream analytics as Spark DataFrame operators.

Every operator is a function from DataFrame(s) to DataFrame that runs on
Spark SQL (batch) and, where Spark allows, unchanged on Structured Streaming.
"""
__version__ = "0.1.0"
