"""Transaction monitoring on Spark: clean, profile, score, alert and report."""
