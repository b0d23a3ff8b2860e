"""DataFrame operators: latest record per key, upsert, share of total, absence."""
