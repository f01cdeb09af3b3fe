"""Structured Streaming jobs: windowed alert summaries, the per-record alert
stream and event-driven anomaly detection."""
