"""Call-fraud analytics as PySpark DataFrame operators."""
