"""coinwharf: banking files to raw, curated and KPI tables with plain Spark jobs."""
