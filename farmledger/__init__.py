"""Farm-to-finance analytics expressed as Spark DataFrame operators."""
