"""Transaction-risk analytics as DataFrame-to-DataFrame jobs on Spark."""
