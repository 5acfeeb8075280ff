"""Text and graph analytics on PySpark."""
