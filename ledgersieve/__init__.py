"""Statement consolidation and payment screening as native Spark DataFrame jobs."""
