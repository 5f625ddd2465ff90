"""Analytics for namespaced vector collections, written as Spark jobs."""
