"""Literature search and trend mining as PySpark DataFrame operators."""
