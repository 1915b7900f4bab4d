"""Live variants of the KPI and scoring jobs on Structured Streaming."""
