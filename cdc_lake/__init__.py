"""Change feeds to trusted, aggregated tables, on Spark."""
