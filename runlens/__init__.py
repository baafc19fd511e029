"""runlens: test-outcome and runtime-trace analytics as Spark DataFrame jobs."""
