"""Document-to-collection synchronisation jobs on Spark."""
