"""End-to-end pipelines and the registered queries."""
