"""Find rare positives in large labelled transaction tables, on Spark."""
