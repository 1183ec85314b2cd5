"""The pipeline's models as DataFrame functions (ingest -> staging -> marts -> panels)."""
