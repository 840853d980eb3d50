"""Analytics for annotated, versioned corpora on Spark."""
