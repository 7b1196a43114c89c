"""Streaming twins of the KPI, attribution and account jobs: same definitions, fed by micro-batches."""
