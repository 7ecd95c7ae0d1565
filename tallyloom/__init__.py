"""Marketing-data operators as plain PySpark DataFrame transforms."""
