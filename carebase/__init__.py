"""Care-facility open data on Spark: ingest, refinement and curated queries."""
