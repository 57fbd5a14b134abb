"""Per-user recommendation mixes as Spark DataFrame operators and batch jobs."""
