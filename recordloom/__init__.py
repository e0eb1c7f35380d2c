"""Star schemas from raw public-record feeds, as plain PySpark DataFrame jobs."""
