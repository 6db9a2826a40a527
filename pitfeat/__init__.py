"""Point-in-time features, evaluation and stake simulation over two-sided match data, as Spark DataFrame operators."""
