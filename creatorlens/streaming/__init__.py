"""Structured Streaming form of the engagement feature (A1 over arriving post files)."""

from creatorlens.streaming.engagement import engagement_stream, engagement_table, run_engagement_stream, upsert_batch  # noqa: F401
