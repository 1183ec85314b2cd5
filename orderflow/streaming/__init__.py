"""Structured Streaming jobs: ingest (A1, A4, A5, I1, I2), incremental
latest state and hourly KPIs (I3), windowed change counts (M3)."""
