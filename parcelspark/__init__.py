"""Home-price feature tables, spatial enrichment and model-data steps as plain Spark plans."""
