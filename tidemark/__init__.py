"""Growth analytics on Spark: staging, SCD2 users, facts, quality checks and marts."""
