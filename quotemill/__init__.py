"""quotemill: market-data analytics as PySpark DataFrame operators."""
