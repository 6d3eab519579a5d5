"""Supply-chain analytics on Spark: landing, star schema, staging, marts, profiling."""
