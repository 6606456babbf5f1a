"""Query plans: staging, metrics, marts, serving queries, reports, ingestion."""
