"""tidemark: market-data features, signals and evaluation as Spark DataFrame jobs."""
