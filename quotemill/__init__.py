"""Daily equity prices on Spark: payloads to quotes, staging, star tables and streams."""
