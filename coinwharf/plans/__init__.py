"""The jobs: raw load, curated loads, KPI reports and the chain that runs them."""
